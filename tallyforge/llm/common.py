"""Column picking, written intermediates and numpy views of Arrow text shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import scratch_path

BLOCK_BYTES = 4 << 20
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each exact name; every other column is left out, whatever it is called."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def as_rows(df: DataFrame, *names: str) -> DataFrame:
    """The first columns of the exact names, and `row`, a struct of all columns by place.

    Names that differ in case only do not disturb each other; `.select("row.*").toDF(*df.columns)` gives the table back.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    first = [F.col(f"c{df.columns.index(n)}").alias(n) for n in dict.fromkeys(names)]
    return plain.select(*first, F.struct(*plain.columns).alias("row"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back: a cut in the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, folds: int):
    """crc32 of the key as text, modulo `folds`; a null key counts as fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def blocks(batch: pa.RecordBatch, text: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding at most `most` bytes of text each; a longer text stands alone."""
    ends = packed(batch.column(text))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its rows, starting at 0."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes other than space and 9 to 13; runs end where their row ends."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    inside = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class SpanHasher:
    """Polynomial hashes modulo 2**64 of byte spans, by prefix sums; powers are kept for the longest buffer seen."""

    def __init__(self) -> None:
        self.base = 0x9E3779B97F4A7C15
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            steps = np.full(len(data) + 1, self.base, np.uint64)
            back = np.full(len(data) + 1, pow(self.base, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
