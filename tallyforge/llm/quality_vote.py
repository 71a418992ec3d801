"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import SpanHasher, blocks, packed, pick, word_spans

#: Kinds of bytes that terms are made of: letters of either case, digits, blanks, and groups of marks.
KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", ".", ",;:", "!?", "|",
         "#$%&*", "@/\\<>{}[]()=+_~^`\"'-"]
KIND = np.full(256, len(KINDS), np.uint8)
for _k, _chars in enumerate(KINDS):
    KIND[np.frombuffer(_chars.encode(), np.uint8)] = _k
#: The marks of other alphabets are letters for this purpose.
WIDE = len(KINDS) + 1
SHAPES = WIDE**3
TERMS = SHAPES + 4


@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled sample and of the latent space; every document is scored against the whole sample."""

    labelled: int = 4096
    dims: int = 32
    neighbours: int = 24
    sharpness: float = 8.0
    shrink: float = 0.5
    seed: int = 5


def term_counts(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> np.ndarray:
    """Rows x TERMS: runs of three kinds of bytes, and how often words repeat the word one, two or four places before."""
    rows = len(offsets) - 1
    out = np.zeros((rows, TERMS), np.float32)
    if len(data) >= 3:
        kind = KIND[data].astype(np.int32)
        code = kind[:-2] * (WIDE * WIDE) + kind[1:-1] * WIDE + kind[2:]
        row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
        whole = row[:-2] == row[2:]
        flat = np.bincount(row[:-2][whole].astype(np.int64) * SHAPES + code[whole], minlength=rows * SHAPES)
        out[:, :SHAPES] = flat.reshape(rows, SHAPES)
    starts, ends, owner = word_spans(data, offsets)
    if len(starts):
        word = hasher(data, starts, ends)
        fresh = np.ones(len(word), bool)
        for term, gap in enumerate((1, 2, 4)):
            same = np.zeros(len(word), bool)
            same[gap:] = (word[gap:] == word[:-gap]) & (owner[gap:] == owner[:-gap])
            fresh &= ~same
            out[:, SHAPES + term] = np.bincount(owner[same], minlength=rows)
        out[:, SHAPES + 3] = np.bincount(owner[fresh], minlength=rows)
    return out


def weighed(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of shape terms and of repetition terms, so that the length of a text does not count."""
    shapes, words = counts[:, :SHAPES], counts[:, SHAPES:]
    return np.sqrt(np.hstack([shapes / np.maximum(shapes.sum(axis=1, keepdims=True), 1),
                              words / np.maximum(words.sum(axis=1, keepdims=True), 1)]))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows without any length stay zero."""
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Voters:
    """The latent space and the labelled vectors in it: a few MB whatever the table, as the sample is bounded."""

    centre: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, terms: np.ndarray) -> np.ndarray:
        return unit((terms - self.centre) @ self.axes)

    def score(self, terms: np.ndarray, s: Settings) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(terms), self.prior)
        near = self.latent(terms) @ self.vectors.T
        k = min(s.neighbours, len(self.labels))
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 0) ** s.sharpness
        return (weight @ np.zeros(1) if not k else (weight * self.labels[top]).sum(axis=1) + s.shrink * self.prior) / (
            weight.sum(axis=1) + s.shrink)


def fit_voters(terms: np.ndarray, labels: np.ndarray, s: Settings) -> Voters:
    """Inverse document frequencies are folded into the axes, which are the leading singular directions of the centred sample."""
    if not len(labels):
        return Voters(np.zeros(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5)
    idf = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))) + 1
    centre = terms.mean(axis=0)
    spread = (terms - centre) * idf
    values, directions = np.linalg.eigh(spread.T @ spread)
    axes = (directions[:, ::-1][:, :s.dims] * idf[:, None]).astype(np.float32)
    return Voters(centre.astype(np.float32), axes, unit((terms - centre) @ axes).astype(np.float32), labels, float(labels.mean()))


def labelled_terms(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors and labels of a seeded sample of at most `labelled` distinct labelled texts, by a join with its keys."""
    draw = F.xxhash64(F.lit(s.seed), F.col(key))
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("mark"))
    drawn = F.broadcast(known.orderBy(draw, key).limit(s.labelled))
    sample = docs.join(drawn, key).groupBy(F.xxhash64(text).alias("draw")).agg(F.min(text).alias("body"), F.max("mark").alias("mark"))

    def shaped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for whole in batches:
            for batch in blocks(whole, "body"):
                terms = weighed(term_counts(*packed(batch.column("body")), hasher)).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("draw"), batch.column("mark").cast(pa.int32()), pa.array([t.tobytes() for t in terms], pa.binary())],
                    names=["draw", "mark", "terms"])

    got = sample.mapInArrow(shaped, "draw long, mark int, terms binary").orderBy("draw").limit(s.labelled).collect()
    terms = np.frombuffer(b"".join(bytes(r["terms"]) for r in got), np.float16).reshape(len(got), TERMS if got else 0)
    return terms.astype(np.float64), np.array([float(r["mark"] == 1) for r in got])


def vote_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                 threshold: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """One row per document: key, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= `threshold`).

    `labels` holds the rows that may be learned from. A text becomes a vector of its shape and repetition terms, projected to the
    latent space of a bounded labelled sample; the exact cosines to all labelled vectors are taken block by block, and the nearest
    vote with their labels, weighted by a power of the similarity and drawn a little towards the overall share.

    Null texts count as empty. A text without any term is compared like any other, at the place where nothing occurs. Repeated
    rows get equal scores. Without usable labels every score is 0.5. An empty table gives no rows.
    """
    rows = pick(docs, key, text)
    terms, marks = labelled_terms(rows, pick(labels, key, label), key, text, label, settings)
    voters = fit_voters(terms, marks, settings)

    def voted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for whole in batches:
            for block in blocks(whole, text, 2 << 20):
                for at in range(0, block.num_rows, 1000):
                    batch = block.slice(at, 1000)
                    score = voters.score(weighed(term_counts(*packed(batch.column(text)), hasher)), settings).astype(np.float64)
                    score = np.clip(score, 0, 1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                        names=[key, "score", "predicted"])

    return rows.mapInArrow(voted, f"`{key}` {rows.schema[key].dataType.simpleString()}, score double, predicted int")
