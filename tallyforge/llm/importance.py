"""Importance resampling towards a target distribution: bucketed gains, Gumbel scores and an exact top share by weighted medians."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import LOWER, blocks, packed, pick, stored
from tallyforge.operators.ranks import numbered

#: Bytes of words: digits, small letters (after lower-casing) and all of UTF-8 beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

CRC_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_STEP = np.where(CRC_STEP & 1, (CRC_STEP >> 1) ^ np.uint32(0xEDB88320), CRC_STEP >> 1)


@dataclass(frozen=True)
class Settings:
    """Features are runs of 1 to `longest` words in `buckets` buckets; `percent` of the documents with `min_words` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, stepwise: int = 64) -> np.ndarray:
    """Unsigned crc32 of byte spans, one byte of all spans at a time; spans of over `stepwise` bytes go one by one."""
    length = ends - starts
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(-length, kind="stable")
    far = int(np.count_nonzero(length > stepwise))
    for i in order[:far]:
        out[i] = zlib.crc32(data[starts[i]:ends[i]])
    order = order[far:]
    at, left = starts[order], length[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    active = len(order)
    for step in range(int(left[0]) if len(left) else 0):
        active = int(np.searchsorted(-left[:active], -step, side="left"))  # spans with more than `step` bytes come first
        now = state[:active]
        state[:active] = CRC_STEP[(now ^ data[at[:active] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[order] = ~state
    return out


def features(data: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a block of texts, and the number of words of every row."""
    n, low = len(offsets) - 1, LOWER[data]
    if not len(low):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n, np.int64)
    inside = WORD[low]
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    finishes[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(row, minlength=n)
    if s.longest == 1 or not len(starts):
        return crc32_spans(low, starts, ends).astype(np.int64) % s.buckets, row, words
    # The same words with one space between them: a run of words is then one span.
    length = ends - starts
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    to = np.cumsum(length + 1)
    fresh = to - length - 1
    spaced = np.full(int(length.sum()) + len(starts), 32, np.uint8)
    spaced[np.repeat(fresh, length) + inner] = low[np.repeat(starts, length) + inner]
    buckets, rows = [], []
    for k in range(1, s.longest + 1):
        if len(starts) < k:
            break
        whole = row[:len(row) - k + 1] == row[k - 1:]
        buckets.append(crc32_spans(spaced, fresh[:len(row) - k + 1][whole], to[k - 1:][whole] - 1).astype(np.int64) % s.buckets)
        rows.append(row[k - 1:][whole])
    return np.concatenate(buckets), np.concatenate(rows), words


def bucket_counts(docs: DataFrame, text: str, s: Settings) -> np.ndarray:
    """Features of all rows per bucket: an array of `buckets` numbers, whatever the size of the table."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for whole in batches:
            for batch in blocks(whole, text):
                total += np.bincount(features(*packed(batch.column(text)), s)[0], minlength=s.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = pick(docs, text).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(s.buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(of_docs: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in the target and in the documents, per bucket, rounded down."""
    k = float(len(of_docs))
    above = (of_target + 1.0) * (float(of_docs.sum()) + k)
    return np.floor(1000 * np.log(above / ((of_docs + 1.0) * (float(of_target.sum()) + k)))).astype(np.int64)


def scored(docs: DataFrame, gain: np.ndarray, key: str, text: str, s: Settings) -> DataFrame:
    """Per document: id, n_features, n_words, weight and score."""
    bytes_of_gain = gain.tobytes()

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bytes_of_gain, np.int64)
        for whole in batches:
            for batch in blocks(whole, text):
                bucket, row, words = features(*packed(batch.column(text)), s)
                n = np.bincount(row, minlength=batch.num_rows)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, table[bucket])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(n), pa.array(words), pa.array(total // np.maximum(n, 1))],
                    names=["id", "n_features", "n_words", "weight"])

    rows = pick(docs, key, text)
    kind = rows.schema[key].dataType.simpleString()
    out = rows.mapInArrow(weighed, f"id {kind}, n_features long, n_words long, weight long")
    head = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    draw = F.floor(-1000 * F.log(-F.log((head.cast("double") + 0.5) / 4294967296.0)))
    return out.withColumn("score", F.col("weight") + draw)


def cutoff(keys: DataFrame, wanted: int) -> tuple[int, ...] | None:
    """The `wanted`-th row (from 1) of a table of whole numbers in the ascending order of its columns, None if there are fewer.

    Weighted median of medians: every task reports the median of its remaining rows on both sides of the last pivot and how many
    there are; the median of the medians weighted by these numbers has at least a quarter of the remaining rows on each side, so
    that each pass discards a quarter at least. A pass sends the driver three rows a task at most.
    """
    names = keys.columns
    low: tuple[int, ...] | None = None  # the wanted row is above `low` and below `high`
    high: tuple[int, ...] | None = None
    pivot: tuple[int, ...] | None = None
    skipped = 0  # rows up to `low`
    while True:
        def report(batches: Iterable[pa.RecordBatch], low=low, high=high, pivot=pivot) -> Iterator[pa.RecordBatch]:
            kept = [np.empty((0, len(names)), np.int64)]
            for batch in batches:
                rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                if low is not None:
                    rows = rows[above(rows, low)]
                if high is not None:
                    rows = rows[below(rows, high)]
                kept.append(rows)
            rows = np.concatenate(kept)
            same = np.zeros(len(rows), bool) if pivot is None else (rows == np.array(pivot)).all(axis=1)
            under = np.zeros(len(rows), bool) if pivot is None else below(rows, pivot)
            for side, part in (("same", same), ("under", under), ("over", ~same & ~under)):
                own = rows[part]
                if len(own):
                    mid = own[np.lexsort(own.T[::-1])[(len(own) - 1) // 2]]
                    yield pa.RecordBatch.from_arrays([pa.array([side]), pa.array([len(own)]), *[pa.array([int(v)]) for v in mid]],
                                                     names=["side", "n", *names])

        found = keys.mapInArrow(report, "side string, n long, " + ", ".join(f"{c} long" for c in names)).collect()
        count = {side: sum(r.n for r in found if r.side == side) for side in ("same", "under", "over")}
        if pivot is None:
            if count["over"] < max(wanted, 1):
                return None
            side = "over"
        elif wanted <= skipped + count["under"]:
            side, high = "under", pivot
        elif wanted <= skipped + count["under"] + count["same"]:
            return pivot
        else:
            side, low = "over", pivot
            skipped += count["under"] + count["same"]
        medians = sorted((tuple(r[c] for c in names), r.n) for r in found if r.side == side)
        half, seen = (count[side] + 1) // 2, 0
        for median, n in medians:
            seen += n
            if seen >= half:
                pivot = median
                break


def below(rows: np.ndarray, mark: tuple[int, ...]) -> np.ndarray:
    """Which rows come before `mark` in the order of their columns."""
    out, tied = np.zeros(len(rows), bool), np.ones(len(rows), bool)
    for i, value in enumerate(mark):
        out |= tied & (rows[:, i] < value)
        tied &= rows[:, i] == value
    return out


def above(rows: np.ndarray, mark: tuple[int, ...]) -> np.ndarray:
    """Which rows come after `mark` in the order of their columns."""
    return ~below(rows, mark) & ~(rows == np.array(mark)).all(axis=1)


def importance_resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
                        settings: Settings = Settings()) -> DataFrame:
    """One row per document: key, n_features, weight, score, rank (null for documents that are not drawn).

    A-Z are lower-cased and words are runs of digits, letters and everything beyond ASCII; features are runs of words, hashed into
    buckets by crc32. A bucket's gain compares its share in the target with that in the documents, a document's weight is the mean
    gain of its features, rounded down, and its score adds seeded Gumbel noise of its key. Of the documents with enough words the
    given share with the highest scores is drawn, ties by smaller key, then fewer features; null keys come last and share one draw of
    noise. Null and empty texts have no features and weight 0; an empty target gives every bucket its share of nothing, an empty
    table no rows. Repeated rows are drawn one by one. Other columns are left out, whatever they are called. The key is an integer.

    The texts are read twice, for the bucket counts and for the scores; scores are written once. The cut is found by passes over
    the written scores (see `cutoff`), and only the rows up to the cut are sorted.
    """
    s = settings
    gain = gains(bucket_counts(docs, text, s), bucket_counts(target, target_text, s))
    rows = stored(scored(docs, gain, key, text, s), "scores")
    able = rows.where(F.col("n_words") >= s.min_words)
    # High scores first, then small keys, null keys last; rows that agree in all of it are interchangeable.
    order = (-F.col("score"), F.col("id").isNull().cast("long"), F.coalesce(F.col("id").cast("long"), F.lit(0)),
             F.col("n_features"), F.col("weight"))
    wanted = able.count() * s.percent // 100
    keys = able.select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    mark = cutoff(keys, wanted) if wanted else None
    whole = rows.select("id", "n_features", "weight", "score", *[c.alias(f"k{i}") for i, c in enumerate(order)],
                        (F.col("n_words") >= s.min_words).alias("able"))
    if mark is None:
        ranked = whole.withColumn("rank", F.lit(None).cast("long"))
    else:
        upto = F.lit(True)  # up to the mark in the order of the columns, compared from the last one
        for i in reversed(range(len(mark))):
            upto = (F.col(f"k{i}") < mark[i]) | ((F.col(f"k{i}") == mark[i]) & upto)
        upto = upto & F.col("able")
        winners = numbered(whole.where(upto), [F.col(f"k{i}") for i in range(len(mark))], "place")
        # Rows equal to the mark may be more than are wanted; they differ in nothing.
        rank = F.when(F.col("place") < wanted, F.col("place") + 1)
        ranked = winners.withColumn("rank", rank).drop("place").unionByName(
            whole.where(~upto).withColumn("rank", F.lit(None).cast("long")))
    return ranked.select(F.col("id").alias(key), "n_features", "weight", "score", "rank")
