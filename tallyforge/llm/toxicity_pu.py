"""Toxicity scores by non-negative positive-unlabelled learning over hashed word beginnings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import LOWER, blocks, mix, packed, pick, stored

SHORTEST, LONGEST, BITS = 3, 8, 20
#: Bytes that words are made of.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and of the model; scoring has none."""

    positives: int = 4000
    unlabelled: int = 8000
    features: int = 1024
    support: int = 3
    purity: float = 0.2
    epochs: int = 60
    batch: int = 512
    rate: float = 0.02
    decay: float = 1e-5
    seed: int = 7


def prefix_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash bucket of the first SHORTEST to LONGEST bytes of every word, A-Z in lower case.

    Words are runs of letters, digits and bytes of other alphabets. Their beginnings hold the stem whatever the ending, and a
    whole short word is one of them.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = LOWER[data]
    inside = WORD[low]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    finishes[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    code = np.zeros(len(starts), np.uint64)
    rows, buckets = [], []
    for j in range(LONGEST):
        goes_on = starts + j < ends
        starts, ends, owner, code = starts[goes_on], ends[goes_on], owner[goes_on], code[goes_on]
        code = code | (low[starts + j].astype(np.uint64) << np.uint64(8 * j))
        if j + 1 >= SHORTEST:
            rows.append(owner)
            buckets.append((mix(code + np.uint64(j)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def presence(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Rows x features: which chosen buckets occur in the row; `place` maps a bucket to its feature or -1."""
    rows, buckets = prefix_buckets(data, offsets)
    feature = place[buckets]
    seen = np.zeros((len(offsets) - 1, width), bool)
    seen[rows[feature >= 0], feature[feature >= 0]] = True
    return seen


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, s: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier that minimises the non-negative risk by Adam on mini-batches.

    The risk is prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]) with the sigmoid loss l(z) = 1 / (1 + exp(z)):
    unlabelled text counts as negative, less the share of positives the prior puts in it. Where the corrected part turns negative
    its gradient is walked back.
    """
    rng = np.random.default_rng(s.seed)
    width = positive.shape[1]
    theta, first, second, step = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1), 0
    theta[-1] = np.log(prior / (1 - prior))
    rounds = max(1, len(unlabelled) // s.batch)
    for _ in range(s.epochs):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for p_rows, u_rows in zip(np.array_split(p_order, rounds), np.array_split(u_order, rounds), strict=True):
            if not len(p_rows):
                p_rows = p_order
            xp, xu = positive[p_rows].astype(np.float64), unlabelled[u_rows].astype(np.float64)
            fp, fu = xp @ theta[:-1] + theta[-1], xu @ theta[:-1] + theta[-1]
            up, uu = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            slope_p, slope_u = prior * up * (1 - up) / len(fp), uu * (1 - uu) / len(fu)
            if uu.mean() >= prior * up.mean():
                gp, gu = -2 * slope_p, slope_u
            else:
                gp, gu = slope_p, -slope_u
            slope = np.append(xp.T @ gp + xu.T @ gu, gp.sum() + gu.sum())
            slope[:-1] += s.decay * theta[:-1]
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            theta -= s.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def training_rows(docs: DataFrame, confirmed: DataFrame, held_out, s: Settings, key: str, text: str) -> DataFrame:
    """A bounded, seeded sample with distinct texts: confirmed toxic rows (positive) and rows of any kind (not positive)."""
    draw = F.xxhash64(F.lit(s.seed), F.col(key))
    open_docs = docs.where(~held_out)
    toxic = F.broadcast(confirmed.select(key).distinct().orderBy(draw, key).limit(s.positives))
    anyone = F.broadcast(open_docs.select(key).where(F.col(key).isNotNull()).distinct().orderBy(draw, key).limit(s.unlabelled))
    both = open_docs.join(toxic, key).withColumn("positive", F.lit(True)).unionByName(
        open_docs.join(anyone, key).withColumn("positive", F.lit(False)))
    # Copies of one text, and repeated keys, count once.
    return both.groupBy("positive", F.xxhash64(text).alias("draw")).agg(F.min(text).alias(text))


def score_toxicity(docs: DataFrame, confirmed: DataFrame, prior: float, held_out, key: str = "doc_id", text: str = "text",
                   settings: Settings = Settings(), keep: bool = False) -> DataFrame:
    """One row per document: key, score (0 to 1), predicted (1 if score >= 0.5).

    `confirmed` lists the keys of documents known to be toxic, `prior` the share of toxic text in the table, and `held_out` is a
    condition on the key: such rows never reach the training. A bounded sample is gathered on the driver as bits, never as text.
    With `keep` the columns of `docs` come back instead, for the documents that are not rejected.

    Null texts count as empty; both get the score of a text without any known word. Repeated rows get equal scores. With no
    positive or no unlabelled example every score is the prior. An empty table gives no rows.
    """
    s = settings
    held = held_out
    sample = training_rows(pick(docs, key, text), confirmed, held, s, key, text)
    sample = stored(sample, "toxicity-sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_all = sizes.get(True, 0), sizes.get(False, 0)
    place = np.full(1 << BITS, -1, np.int32)
    weights, bias = np.zeros(1), float(np.log(prior / (1 - prior)))
    if n_pos and n_all:
        chosen = choose_buckets(sample, text, n_pos, n_all, prior, s)
        place[chosen] = np.arange(len(chosen))
        if len(chosen):
            found = sample_bits(sample, text, place, len(chosen), s)
            weights, bias = fit_nnpu(found[True], found[False], prior, s)

    # By place, so that columns whose names differ in case only do not disturb each other.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]) if keep else pick(docs, key, text)
    body = f"c{docs.columns.index(text)}" if keep else text

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, body):
                seen = presence(*packed(batch.column(body)), place, len(weights))
                score = 1 / (1 + np.exp(-(seen @ weights + bias)))
                if keep:
                    yield batch.filter(pa.array(score < 0.5))
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                     names=[key, "score", "predicted"])

    if keep:
        return plain.mapInArrow(judged, plain.schema).toDF(*docs.columns)
    return plain.mapInArrow(judged, f"`{key}` {plain.schema[key].dataType.simpleString()}, score double, predicted int")


def choose_buckets(sample: DataFrame, text: str, n_pos: int, n_all: int, prior: float, s: Settings) -> np.ndarray:
    """The buckets whose document share among positives stands out most from that among all text.

    By the prior, prior * share among positives / share among all estimates how much of the text with a bucket is toxic; buckets
    below `purity` carry more noise than signal and are left out.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for whole in batches:
            for batch in blocks(whole, text):
                rows, buckets = prefix_buckets(*packed(batch.column(text)))
                pairs = np.unique(rows * (1 << BITS) + buckets)
                side = np.asarray(batch.column("positive").to_pylist(), np.int64)[pairs >> BITS]
                np.add.at(total, (side, pairs & ((1 << BITS) - 1)), 1)
        met = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[1, met]), pa.array(total[0, met])],
                                         names=["bucket", "in_pos", "in_all"])

    counts = sample.mapInArrow(counted, "bucket long, in_pos long, in_all long").groupBy("bucket").agg(
        F.sum("in_pos").alias("in_pos"), F.sum("in_all").alias("in_all"))
    excess = F.col("in_pos") / n_pos - F.col("in_all") / n_all
    contrast = excess / F.sqrt(F.col("in_all") / n_all + F.lit(1 / n_all))
    pure = F.col("in_pos") / n_pos * prior >= s.purity * F.col("in_all") / n_all
    best = counts.where((F.col("in_pos") >= s.support) & (excess > 0) & pure).orderBy(contrast.desc(), "bucket").limit(s.features)
    return np.array([r["bucket"] for r in best.select("bucket").collect()], np.int64)


def sample_bits(sample: DataFrame, text: str, place: np.ndarray, width: int, s: Settings) -> dict[bool, np.ndarray]:
    """The sample as packed presence bits, at most `positives + unlabelled` rows of width / 8 bytes."""

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, text):
                seen = np.packbits(presence(*packed(batch.column(text)), place, width), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("positive"), batch.column("draw"),
                                                  pa.array([row.tobytes() for row in seen], pa.binary())],
                                                 names=["positive", "draw", "seen"])

    rows = sample.mapInArrow(bits, "positive boolean, draw long, seen binary")
    out = {}
    for side, most in ((True, s.positives), (False, s.unlabelled)):
        got = rows.where(F.col("positive") == side).orderBy("draw").limit(most).collect()
        packed_bits = np.frombuffer(b"".join(bytes(r["seen"]) for r in got), np.uint8).reshape(len(got), -1)
        out[side] = np.unpackbits(packed_bits, axis=1)[:, :width].astype(bool)
    return out


def confirmed_toxic(labels: DataFrame, held_out, key: str = "doc_id", label: str = "toxic") -> tuple[DataFrame, float]:
    """Keys labelled toxic outside the held-out rows, and the share of toxic among the labelled ones, kept within (0, 1)."""
    known = pick(labels, key, label).where(~held_out & F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(key).agg(F.max(label).alias(label))
    counts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col(label) == 1).cast("long")), F.lit(0)).alias("toxic")).first()
    return known.where(F.col(label) == 1).select(key), (counts["toxic"] + 0.5) / (counts["n"] + 1)
