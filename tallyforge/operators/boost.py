"""Second-order boosted regression trees grown from grouped histograms, many models side by side over one binned table."""

from __future__ import annotations

import json
import math
import zlib
from array import array
from base64 import b64decode, b64encode
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import scratch_path
from tallyforge.sources.writers import discard

#: Bins of a feature; a bin is one byte.
BINS = 64
#: Trees that tasks add to the written margins before these are written anew, so that neither plans nor tasks carry many trees.
KEPT = 16
#: Rows that a block holds at most; tables of blocks have one record a block, its rows packed in binary columns.
BLOCK_ROWS = 1 << 18
#: Tasks a core that go through the blocks of large tables, and rows of a task of smaller ones.
TASKS_PER_CORE = 3
DEALT_ROWS = 1 << 20
BLOCK = "part int, cells binary, starts binary, row binary, label binary, val binary"
#: Rows that make it worth to bin in one more task.
TASK_ROWS = 200_000
#: A node of so many points (rows, pooled by their bins) at most is grown to its leaves in one task.
SMALL_ROWS = 1 << 20
#: Bytes of drawn points that a job of several rounds sends.
SENT_BYTES = 1 << 27
#: Cells (node, feature, bin) that a task gathers before it passes them on.
CELLS = 1 << 18
#: Cells of the histograms that a node grown out in one task holds at once.
DENSE_CELLS = 1 << 19
FOUND = "model int, node int, feature int, cut int, gain double, left_sum double, left_n double, sum double, n double"


@dataclass(frozen=True)
class Plan:
    """What a model is grown by. `penalty` is the squared penalty of leaf values, `columns` the share of features of each tree.

    With validation rows growth stops once `patience` rounds have not lowered their error by the share `tolerance`.
    """

    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    subsample: float = 1.0
    columns: float = 1.0
    penalty: float = 0.0
    min_rows: float = 1.0
    patience: int = 10
    tolerance: float = 0.01
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were made; feature -1 marks a leaf, and the right child stands behind the left one."""

    feature: array = field(default_factory=lambda: [-1])
    cut: array = field(default_factory=lambda: [0])
    left: array = field(default_factory=lambda: [0])
    value: array = field(default_factory=lambda: [0.0])

    def __post_init__(self) -> None:
        # A search holds thousands of trees of thousands of nodes: 16 bytes a node, not a Python object for each number.
        for name, kind in zip(("feature", "cut", "left", "value"), "hhid"):
            values = getattr(self, name)
            if not isinstance(values, array):
                setattr(self, name, array(kind, np.asarray(values, kind).tobytes()))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.cut, self.left, self.value))

    def packed(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.value, self.left, self.feature, self.cut))

    @staticmethod
    def unpacked(data: bytes) -> "Tree":
        n = len(data) // 16
        value, left, feature, cut = (np.frombuffer(data, kind, n, at * n) for kind, at in (("d", 0), ("i", 8), ("h", 12), ("h", 14)))
        return Tree(feature, cut, left, value)

    def shrunk(self) -> bytes:
        """As `packed`, compressed, with values of leaves only: what predictions need."""
        feature, cut, left, value = self.arrays()
        return zlib.compress(b"".join(x.tobytes() for x in (np.where(feature < 0, value, 0.0), np.diff(left, prepend=np.int32(0)), feature, cut)), 1)

    @staticmethod
    def grown_back(data: bytes) -> "Tree":
        tree = Tree.unpacked(zlib.decompress(data))
        tree.left = array("i", np.cumsum(np.array(tree.left), dtype=np.int32).tobytes())
        return tree

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, at
        for value in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(value)
        return at, at + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of bins ends in."""
        at, (feature, cut, left, _) = np.zeros(len(bins), np.intp), self.arrays()
        inner = feature >= 0
        if not inner.any():
            return at
        # A leaf leads to itself, so all rows go on together until the last of them has arrived.
        cut, left = np.where(inner, cut, BINS * 4), np.where(inner, left, np.arange(len(feature)))
        feature = np.where(inner, feature, 0).astype(np.intp)
        flat, base = np.ascontiguousarray(bins).reshape(-1), np.arange(len(bins)) * bins.shape[1]
        while inner.take(at).any():
            at = left.take(at) + (flat.take(base + feature.take(at)) > cut.take(at))
        return at

    def graft(self, node: int, other: "Tree") -> None:
        """Puts another tree in the place of a leaf."""
        feature, cut, left, value = other.arrays()
        left = np.where(feature >= 0, left + len(self.feature) - 1, 0)
        for name, values in zip(("feature", "cut", "left", "value"), (feature, cut, left, value)):
            own = getattr(self, name)
            own[node] = values[0].item()
            own.frombytes(values[1:].astype(own.typecode).tobytes())

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value).take(self.nodes(bins))


def feature_edges(df: DataFrame, features: str, bins: int = BINS) -> list[list[float]]:
    """Per feature the upper edges of all bins but the last, from one quantile sketch of every feature in one pass."""
    array = vector_to_array(features)
    width = df.select(F.size(array).alias("n")).first()
    if width is None:
        raise ValueError("no rows to fit on")
    probs = [i / bins for i in range(1, bins)]
    found = df.select(array.alias("v")).agg(*[
        F.percentile_approx(F.when(~F.isnan(F.col("v")[i]), F.col("v")[i]), probs, 20 * bins).alias(f"e{i}") for i in range(width["n"])]).first()
    return [sorted(set(edges)) if edges else [] for edges in found]


def binned_array(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """One byte a value: the first bin whose upper edge is not below it; NaN goes to the last one."""
    out = np.empty(values.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(np.array(e), values[:, i], side="left")
    return out


def matrix(column: pa.Array, kind: type, rows: int) -> np.ndarray:
    """Rows x values of a binary column that holds the same number of values in each row."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + rows + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind).reshape(rows, -1) if rows else np.empty((0, 1), kind)


def packed_matrix(values: np.ndarray) -> pa.Array:
    width = values.shape[1] * values.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


@dataclass
class Block:
    """Rows sorted by their bins: the distinct bins (cells), where the rows of each start, and, when written, margins of the cells by model."""

    part: int
    cells: np.ndarray
    starts: np.ndarray
    row: np.ndarray
    label: np.ndarray
    val: np.ndarray
    margins: np.ndarray | None = None

    def packed(self) -> pa.RecordBatch:
        columns = {"cells": self.cells, "starts": self.starts, "row": self.row, "label": self.label, "val": self.val}
        columns |= {} if self.margins is None else {"margins": self.margins}
        return pa.RecordBatch.from_arrays([pa.array([self.part], pa.int32()), *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns.values())],
                                          names=["part", *columns])

    def drawn_sums(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of labels of the rows in use, by cell."""
        return np.add.reduceat(use.astype(np.float64), self.starts), np.add.reduceat(np.where(use, self.label, 0.0), self.starts)

    def by_row(self, of_cells: np.ndarray) -> np.ndarray:
        return np.repeat(of_cells, np.diff(np.append(self.starts, len(self.label))), axis=0)


def blocks_in(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            cells, starts, row, label, val, *margins = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in (
                ("cells", np.uint8), ("starts", np.int64), ("row", np.int64), ("label", np.float64), ("val", bool), ("margins", np.float64))
                if c in batch.schema.names)
            k = len(starts)
            yield Block(batch.column("part")[i].as_py(), cells.reshape(k, -1), starts, row, label, val, *(m.reshape(k, -1) for m in margins))


def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Row numbers, bins, labels and validation marks of the rows of each block."""
    for block in blocks_in(batches):
        yield block.row, block.by_row(block.cells), block.label, block.val


def dealt(spark: SparkSession, path: str, schema: str, parts: int) -> DataFrame:
    """Written blocks, the same number of them in each task whatever files a task would take together."""
    return spark.read.schema(schema).parquet(path).repartitionById(parts, F.col("part") % parts).persist(StorageLevel.MEMORY_AND_DISK)


def sweep(spark: SparkSession) -> None:
    """Shuffle files of past jobs stay until the driver happens to collect its garbage; jobs that send much ask for it."""
    spark._jvm.System.gc()


def bin_rows(train: DataFrame, val: DataFrame | None, features: str, label: str, edges: Sequence[Sequence[float]]) -> tuple[str, int]:
    """Blocks of the rows of both tables, sorted by bins, so that equal bins meet; written once and shared by all models. Path and number of tasks."""

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column("v").flatten(), np.float64).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([packed_matrix(binned_array(values, edges)), *(batch.column(c) for c in ("row", "label", "val"))],
                                                 names=["bins", "row", "label", "val"])

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            bins, row, label, val = (np.concatenate(c) for c in zip(*parts))
            fresh = np.ones(len(bins), bool)
            fresh[1:] = (bins[1:] != bins[:-1]).any(axis=1)
            starts = np.flatnonzero(fresh)
            return Block(part, bins[starts], starts, row, label, val).packed()

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                parts.append((matrix(batch.column("bins"), np.uint8, batch.num_rows), batch.column("row").to_numpy(), batch.column("label").to_numpy(),
                              batch.column("val").to_numpy(zero_copy_only=False)))
                if sum(len(p[1]) for p in parts) >= BLOCK_ROWS:
                    yield block()
                    parts = []
        if parts:
            yield block()

    both = [df.select(vector_to_array(features).alias("v"), F.col(label).cast("double").alias("label"), F.lit(held).alias("val"))
            for df, held in ((train, False), (val, True)) if df is not None]
    rows = reduce(DataFrame.union, both).where("label is not null")
    spark = train.sparkSession
    cores, count = spark.sparkContext.defaultParallelism, rows.count()
    tasks = max(1, count // TASK_ROWS)
    parts = max(1, min(tasks, cores * min(TASKS_PER_CORE, max(1, count // (cores * DEALT_ROWS)))))
    rows = rows.repartition(tasks).withColumn("row", F.monotonically_increasing_id())
    # As many ranges for each task that goes through them later. A crowd of equal bins is shared out by row.
    made = rows.mapInArrow(binned, "bins binary, row long, label double, val boolean").repartitionByRange(-(-tasks // parts) * parts, "bins", "row")
    made = made.sortWithinPartitions("bins", "row").withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, "binned")
    made.mapInArrow(gathered, BLOCK).write.parquet(path)
    return path, parts


def drawn(row: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Which rows take part: a hash of the row and the seed, so that a repeated task draws the same."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


@dataclass
class Growing:
    """One model while it grows: its finished trees, how many of them the written margins hold, and the open nodes of the current one.

    `small` lists nodes with few rows, and their depth, that are grown out at the end of the tree. `scores` has the validation error of the first trees, from none on; `mark` is the round that the next rounds are held against.
    """

    number: int
    plan: Plan
    trees: list[Tree] = field(default_factory=list)
    held: int = 0
    turn: int = 0
    tree: Tree = field(default_factory=Tree)
    open: list[int] = field(default_factory=list)
    small: list[tuple[int, int]] = field(default_factory=list)
    columns: list[int] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    mark: int = 0
    stopped: bool = False

    def for_tasks(self) -> "Growing":
        """A copy with the trees only that the written margins lack."""
        return replace(self, trees=self.trees[self.held:], held=0, turn=len(self.trees), scores=[])

    def margin(self, block: Block, start: float, place: int | None) -> np.ndarray:
        """Predictions for the cells of a block."""
        out = np.full(len(block.starts), start) if place is None else block.margins[:, place].copy()
        for tree in self.trees:
            out += tree.predict(block.cells)
        return out

    def draw(self, block: Block, turn: int) -> np.ndarray:
        """Which rows of a block the tree of a turn is grown by."""
        return ~block.val & drawn(block.row, self.plan.seed * 1009 + turn, self.plan.subsample) if self.plan.subsample < 1 else ~block.val

    def columns_of(self, turn: int, width: int) -> list[int]:
        """The features that the tree of a turn may split by."""
        rng = np.random.default_rng([self.plan.seed, turn])
        return sorted(rng.permutation(width)[:max(1, round(self.plan.columns * width))].tolist())

    def judge(self, score: float) -> None:
        """Takes the validation error of the trees so far and stops the model if it improves too little."""
        self.scores.append(score)
        if score < self.scores[self.mark] * (1 - self.plan.tolerance):
            self.mark = len(self.scores) - 1
        elif len(self.scores) - 1 - self.mark >= self.plan.patience:
            self.stopped = True

    @property
    def done(self) -> bool:
        return self.stopped or len(self.trees) >= self.plan.rounds


def histogram_cells(bins: np.ndarray, pull: np.ndarray, n: np.ndarray, slot: np.ndarray, nodes: int, columns: Sequence[int]
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and rows per (open node, column, bin) as two arrays of that shape."""
    sums, counts = np.zeros((nodes, len(columns), BINS)), np.zeros((nodes, len(columns), BINS))
    for i, c in enumerate(columns):
        key = slot * BINS + bins[:, c]
        sums[:, i] = np.bincount(key, weights=pull, minlength=nodes * BINS).reshape(nodes, BINS)
        counts[:, i] = np.bincount(key, weights=n, minlength=nodes * BINS).reshape(nodes, BINS)
    return sums, counts


def leaf_value(plan: Plan, sums, n):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n + plan.penalty != 0, plan.learning_rate * sums / (n + plan.penalty), 0.0)[()]


def worth(gain, sums):
    return gain > 1e-12 * np.maximum(1.0, sums**2)


def best_cuts(columns: np.ndarray, widths: Sequence[int], pull: np.ndarray, n: np.ndarray, slot: np.ndarray, nodes: int, penalty: float, min_rows: float,
              may: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per node the split that `best_splits` gives: column (-1: none), cut, gain, and sums and rows left and whole. `may` says which columns a node tries."""
    whole_sum, whole_n = np.bincount(slot, pull, nodes), np.bincount(slot, n, nodes)
    best, cut, gain, left_sum, left_n = np.full(nodes, -1), np.zeros(nodes, np.intp), np.zeros(nodes), np.zeros(nodes), np.zeros(nodes)
    least, every = max(min_rows, 1), np.arange(nodes)
    with np.errstate(divide="ignore", invalid="ignore"):
        base = whole_sum**2 / (whole_n + penalty)
        for i, width in enumerate(widths):
            if width < 2:
                continue
            key = slot * width + columns[i]
            sums = np.bincount(key, pull, nodes * width).reshape(nodes, width)[:, :-1].cumsum(axis=1)
            rows = np.bincount(key, n, nodes * width).reshape(nodes, width)[:, :-1].cumsum(axis=1)
            others = whole_n[:, None] - rows
            found = sums**2 / (rows + penalty) + (whole_sum[:, None] - sums)**2 / (others + penalty)
            found = np.where((rows >= least) & (others >= least), 0.5 * (found - base[:, None]), 0.0)
            at = found.argmax(axis=1)
            top = found[every, at]
            fresh = top > gain if may is None else (top > gain) & may[:, i]
            best[fresh], cut[fresh], gain[fresh] = i, at[fresh], top[fresh]
            left_sum[fresh], left_n[fresh] = sums[every, at][fresh], rows[every, at][fresh]
    return best, cut, gain, left_sum, left_n, whole_sum, whole_n


def by_feature(bins: np.ndarray) -> np.ndarray:
    """Bins of points, feature by feature, as `grown_out` takes them."""
    return np.ascontiguousarray(bins.T).astype(np.intp)


def grown_out(bins: np.ndarray, pull: np.ndarray, n: np.ndarray, tried: Sequence[int], depth: int, penalty: float, min_rows: float,
              value: Callable, good: Callable, may: Callable | None = None) -> Tree:
    """The tree of up to `depth` levels over points (their bins, sums and numbers of rows) that are all here, by the splits of `best_splits`.

    `value` gives leaf values of sums and rows, `good` says which gains are worth a split, `may` which of the tried features some nodes try.
    """
    columns, names = bins if len(tried) == len(bins) else bins[list(tried)], np.array(tried)
    widths = [int(c.max(initial=0)) + 1 for c in columns]
    feature, cut, left, values = [np.array([-1])], [np.array([0])], [np.array([0])], [np.atleast_1d(value(pull.sum(), n.sum()))]
    slot, nodes, first, least = np.zeros(len(pull), np.intp), 1, 0, 2 * max(min_rows, 1)
    for _ in range(depth):
        # Nodes of one point or of too few rows stay leaves, and their points go no further.
        able = (np.bincount(slot, n, nodes) >= least) & (np.bincount(slot, n > 0, nodes) > 1)
        ids, on = np.flatnonzero(able), able[slot]
        if not len(ids):
            break
        if not on.all():
            columns, pull, n, slot = columns[:, on], pull[on], n[on], slot[on]
        slot = (np.cumsum(able) - 1).take(slot)
        step = max(1, DENSE_CELLS // max(1, *widths))
        parts = []
        for low in range(0, len(ids), step):
            some = min(step, len(ids) - low)
            use = slice(None) if some == len(ids) else np.flatnonzero((slot >= low) & (slot < low + some))
            allowed = may(first + ids[low:low + some]) if may else None
            parts.append(best_cuts(columns[:, use], widths, pull[use], n[use], slot[use] - low, some, penalty, min_rows, allowed))
        column, at, gain, left_sum, left_n, whole_sum, whole_n = (np.concatenate(x) for x in zip(*parts))
        grown = (column >= 0) & good(gain, whole_sum, whole_n)
        count = int(grown.sum())
        if not count:
            break
        # The children of the nodes that split stand behind all nodes so far, in pairs.
        pair, size, split = np.where(grown, 2 * (np.cumsum(grown) - 1), 0), first + nodes, ids[grown]
        feature[-1][split], cut[-1][split], left[-1][split] = names[column[grown]], at[grown], size + pair[grown]
        a, b = value(left_sum[grown], left_n[grown]), value((whole_sum - left_sum)[grown], (whole_n - left_n)[grown])
        for level, fill in ((feature, -1), (cut, 0), (left, 0)):
            level.append(np.full(2 * count, fill))
        values.append(np.column_stack([a, b]).ravel())
        on = grown[slot]
        if not on.all():
            columns, pull, n, slot = columns[:, on], pull[on], n[on], slot[on]
        slot = pair.take(slot) + (columns.reshape(-1).take(column.take(slot) * columns.shape[1] + np.arange(len(slot))) > at.take(slot))
        first, nodes = size, 2 * count
    return Tree(*(np.concatenate(x) for x in (feature, cut, left, values)))


def boosted_out(bins: np.ndarray, pull: np.ndarray, n: np.ndarray, columns: Sequence[int], depth: int, plan: Plan) -> Tree:
    return grown_out(bins, pull, n, columns, depth, plan.penalty, plan.min_rows, lambda s, k: leaf_value(plan, s, k), lambda gain, s, k: worth(gain, s))


def boosted_round(bins: np.ndarray, pull: np.ndarray, n: np.ndarray, columns: Sequence[int], plan: Plan) -> tuple[Tree, np.ndarray]:
    """A whole tree and its predictions for the points. Points that the columns it may split by do not tell apart are one to it."""
    sizes = [int(bins[c].max(initial=0)) + 1 for c in columns]
    if math.prod(sizes) > bins.shape[1]:  # hardly any would fall together
        tree = boosted_out(bins, pull, n, columns, plan.max_depth, plan)
        return tree, tree.predict(bins.T.astype(np.uint8))
    key = np.ravel_multi_index([bins[c] for c in columns], sizes)
    here = np.flatnonzero(np.bincount(key))
    few = np.zeros((len(bins), len(here)), np.intp)
    few[list(columns)] = np.unravel_index(here, sizes)
    tree = boosted_out(few, np.bincount(key, pull)[here], np.bincount(key, n)[here], columns, plan.max_depth, plan)
    said = np.zeros(math.prod(sizes))
    said[here] = tree.predict(few.T.astype(np.uint8))
    return tree, said.take(key)


def best_splits(model: np.ndarray, node: np.ndarray, feature: np.ndarray, cell: np.ndarray, sums: np.ndarray, n: np.ndarray,
                penalty: np.ndarray, min_rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per (model, node) the split with the largest gain, ties by smaller feature, then cut: the columns of FOUND.

    Every feature's cells are summed from the left; the gain is the Newton gain of squared loss, where a row's second derivative is
    one, with the leaf penalty of the model. Nodes without a valid split have gain 0.
    """
    order = np.lexsort((cell, feature, node, model))
    model, node, feature, cell, sums, n = (x[order] for x in (model, node, feature, cell, sums, n))
    # Cells of several tasks fold into one.
    fresh = np.ones(len(model), bool)
    fresh[1:] = (model[1:] != model[:-1]) | (node[1:] != node[:-1]) | (feature[1:] != feature[:-1]) | (cell[1:] != cell[:-1])
    at = np.flatnonzero(fresh)
    sums, n = np.add.reduceat(sums, at), np.add.reduceat(n, at)
    model, node, feature, cell = model[at], node[at], feature[at], cell[at]
    first = np.ones(len(model), bool)
    first[1:] = (model[1:] != model[:-1]) | (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])
    start = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    left_sum, left_n = running(sums, start, group), running(n, start, group)
    sizes = np.diff(np.append(start, len(model)))
    whole_sum, whole_n = np.add.reduceat(sums, start)[group], np.add.reduceat(n, start)[group]
    lam, least = penalty[model], min_rows[model]
    right_sum, right_n = whole_sum - left_sum, whole_n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (left_sum**2 / (left_n + lam) + right_sum**2 / (right_n + lam) - whole_sum**2 / (whole_n + lam))
    last = np.zeros(len(model), bool)
    last[start + sizes - 1] = True
    gain[last | (left_n < least) | (right_n < least) | ~np.isfinite(gain)] = 0
    best = np.lexsort((cell, feature, -gain, node, model))
    keep = np.ones(len(best), bool)
    m, k = model[best], node[best]
    keep[1:] = (m[1:] != m[:-1]) | (k[1:] != k[:-1])
    b = best[keep]
    return model[b], node[b], feature[b], cell[b], gain[b], left_sum[b], left_n[b], whole_sum[b], whole_n[b]


def running(values: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Running sums within groups, each summed on its own, so that other groups leave no rounding behind."""
    out = np.cumsum(values)
    out = out - (out[start] - values[start])[group]
    return out


class Booster:
    """Grows several models in step.

    Rows are pooled by their bins: a tree sees the drawn rows of a cell as their number and sum of gradients. While the points of the
    whole table are few, one job grows some rounds of all models: tasks draw the rows of every round and send the sums of each cell to
    where the model grows. Beyond that a level's job serves all models: tasks add up gradients per (model, node, feature, bin), bring
    the cells of a node together, and send the driver one row a node; once all open nodes are small, one job brings the points of each together and
    grows it out. Validation rows are scored before each tree.
    """

    def __init__(self, train: DataFrame, val: DataFrame | None, features: str, label: str, bins: int = BINS) -> None:
        self.edges, self.spark = feature_edges(train, features, bins), train.sparkSession
        path, self.parts = bin_rows(train, val, features, label, self.edges)
        self.base = dealt(self.spark, path, BLOCK, self.parts)

        def facts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks_in(batches):
                yield pa.RecordBatch.from_arrays([pa.array([float(b.label[~b.val].sum())]), pa.array([int(b.val.sum())]), pa.array([len(b.label)]),
                                                  pa.array([len(b.starts)])], names=["label", "held", "n", "points"])

        said = self.base.mapInArrow(facts, "label double, held long, n long, points long").agg(*(F.sum(c).alias(c) for c in ("label", "held", "n", "points"))).first()
        self.scored, self.rows = (said["held"] or 0) > 0, (said["n"] or 0) - (said["held"] or 0)
        self.points = said["points"] or 0
        self.start = said["label"] / self.rows if self.rows else 0.0
        self.written, self.path, self.order, self.renewals, self.sent = None, None, [], 0, 0

    def close(self) -> None:
        self.base.unpersist()
        if self.written is not None:
            self.written.unpersist()
            discard(self.spark, self.path)

    def model(self, growing: Growing) -> "BoostedTreesModel":
        """The model so far, cut after its best round if validation rows told one."""
        trees = growing.trees[:int(np.argmin(growing.scores))] if growing.scores else growing.trees
        return BoostedTreesModel.of(self.start, self.edges, trees)

    def advance(self, models: Sequence[Growing], rounds: int) -> None:
        """Grows every model until it has `rounds` trees or all of its plan, or has stopped improving on the validation rows."""
        while live := [m for m in models if not m.done and len(m.trees) < rounds]:
            self._renew(live)
            if self.points <= SMALL_ROWS:
                self._rounds(live, rounds)
                continue
            for m in live:
                m.columns = m.columns_of(len(m.trees), len(self.edges))
                m.tree, m.open, m.small = Tree(), [0], []
            first = True
            for level in range(max(m.plan.max_depth for m in live)):
                work = [m for m in live if m.open and level < m.plan.max_depth]
                if not work:
                    break
                self._level(work if not first else live, level, first)
                first = False
            if any(m.small for m in live):
                self._finish(live)
            for m in live:
                m.trees.append(m.tree)
                m.open = []
        unscored = [m for m in models if self.scored and len(m.scores) <= len(m.trees)]
        if unscored:
            self._renew(unscored)
            for m in unscored:
                m.open = []
            self._level(unscored, 0, True)

    def _source(self) -> DataFrame:
        return self.base if self.written is None else self.written

    def _places(self, models: Sequence[Growing]) -> list[int | None]:
        """Which of the written margins are those of each model; none stand for the start."""
        return [self.order.index(m.number) if m.number in self.order else None for m in models]

    def _renew(self, models: Sequence[Growing]) -> None:
        """Margins of the cells, one for each model, written anew when a model grew by several trees; plans and tasks hold what came later."""
        if all(len(m.trees) - m.held < KEPT for m in models):
            return
        start, places, slim = self.start, self._places(models), [m.for_tasks() for m in models]

        def renewed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks_in(batches):
                yield replace(b, margins=np.column_stack([m.margin(b, start, place) for m, place in zip(slim, places)])).packed()

        schema, path = f"{BLOCK}, margins binary", scratch_path(self.spark, "margins")
        self._source().mapInArrow(renewed, schema).write.parquet(path)
        self._source().unpersist()
        if self.path is not None:
            discard(self.spark, self.path)
        self.written, self.path, self.order = dealt(self.spark, path, schema, self.parts), path, [m.number for m in models]
        self.renewals += 1
        for m in models:
            m.held = len(m.trees)

    def _rounds(self, models: Sequence[Growing], rounds: int) -> None:
        """Grows some rounds of all models, each model in one task to which the points of all blocks come."""
        start, places, slim, scored, width = self.start, self._places(models), [m.for_tasks() for m in models], self.scored, len(self.edges)
        most = max(1, min(KEPT, SENT_BYTES // (12 * self.points * len(models))))
        turns = [range(m.turn, m.turn + min(most, rounds - m.turn, m.plan.rounds - m.turn)) for m in slim]

        def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks_in(batches):
                held = None
                if scored:  # what squared errors need of the validation rows of a cell: number, mean, and squares around it
                    number, total = b.drawn_sums(b.val)
                    mean = total / np.maximum(number, 1)
                    apart = np.add.reduceat(np.where(b.val, (b.label - b.by_row(mean)) ** 2, 0.0), b.starts)
                    held = np.concatenate([number, mean, apart])
                for i, (m, place) in enumerate(zip(slim, places)):
                    yield record(i, -1, b.part, int(b.row[0]), b.cells, m.margin(b, start, place), held)
                    for turn in turns[i] if m.plan.subsample < 1 else turns[i][:1]:
                        n, total = b.drawn_sums(m.draw(b, turn))
                        yield record(i, turn, b.part, int(b.row[0]), n.astype(np.uint32), total, None)

        def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Records of a turn follow each other, with the blocks in the same order.
            for (i, turn), columns in joined(batches):
                m = slim[i]
                if turn < 0:
                    bins, margin, held = by_feature(np.frombuffer(columns[0], np.uint8).reshape(-1, width)), np.frombuffer(columns[1]).copy(), columns[2]
                    # The blocks' numbers, means and squares
                    number, mean, apart = (np.concatenate(c) for c in zip(*(np.frombuffer(c).reshape(3, -1) for c in held))) if scored else (None, None, None)
                    continue
                n, total = np.frombuffer(columns[0], np.uint32).astype(np.float64), np.frombuffer(columns[1])
                for turn in [turn] if m.plan.subsample < 1 else turns[i]:
                    error = float(np.sqrt((apart.sum() + (number * (mean - margin) ** 2).sum()) / number.sum())) if scored else None
                    tree, said = boosted_round(bins, total - n * margin, n, m.columns_of(turn, width), m.plan)
                    margin += said
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([turn], pa.int32()), pa.array([error], pa.float64()),
                                                      pa.array([tree.packed()], pa.binary())], names=["model", "turn", "error", "tree"])

        made = self._source().mapInArrow(sent, RECORD)
        made = made.repartitionById(len(models), "model").sortWithinPartitions("model", "turn", "part", "block")
        for r in sorted(made.mapInArrow(grown, "model int, turn int, error double, tree binary").collect()):  # one row a model and round
            m = models[r["model"]]
            if not m.done:  # else the rounds before have stopped it
                if scored:
                    m.judge(r["error"])
                m.trees.append(Tree.unpacked(r["tree"]))
        self.sent += 12 * self.points * sum(map(len, turns))
        if self.sent >= SENT_BYTES:
            sweep(self.spark)
            self.sent = 0

    def _level(self, models: Sequence[Growing], level: int, first: bool) -> None:
        start, places, slim, held = self.start, self._places(models), [m.for_tasks() for m in models], self.scored and first
        penalty = np.array([m.plan.penalty for m in models])
        min_rows = np.array([m.plan.min_rows for m in models])

        def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[int, list[np.ndarray]] = {}
            errors = np.zeros((len(slim), 2))
            for b in blocks_in(batches):
                for i, (m, place) in enumerate(zip(slim, places)):
                    margin = m.margin(b, start, place)
                    if held:
                        errors[i] += ((b.label - b.by_row(margin))[b.val] ** 2).sum(), b.val.sum()
                    if not m.open:
                        continue
                    n, total = b.drawn_sums(m.draw(b, m.turn))
                    slot_of = np.full(len(m.tree.feature), -1)
                    slot_of[m.open] = np.arange(len(m.open))
                    slot = slot_of[m.tree.nodes(b.cells)]
                    use = np.flatnonzero((slot >= 0) & (n > 0))
                    new = histogram_cells(b.cells[use], (total - n * margin)[use], n[use], slot[use], len(m.open), m.columns)
                    if i in kept:
                        kept[i] = [a + b for a, b in zip(kept[i], new)]
                    elif new[0].size <= CELLS:
                        kept[i] = list(new)
                    else:
                        yield flat_cells(i, m, *new)
            for i, m in enumerate(slim):
                if i in kept:
                    yield flat_cells(i, m, *kept[i])
            if held:
                yield cell_batch(np.arange(len(slim)), np.full(len(slim), -1), np.full(len(slim), -1), np.zeros(len(slim)), *errors.T)

        def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [[b.column(c).to_numpy() for c in ("model", "node", "feature", "cell", "sum", "n")] for b in batches if b.num_rows]
            if not parts:
                return
            columns = [np.concatenate(c) for c in zip(*parts)]
            found = best_splits(*columns, penalty, min_rows)
            names = ["model", "node", "feature", "cut", "gain", "left_sum", "left_n", "sum", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32) if k < 4 else c.astype(np.float64)) for k, c in enumerate(found)],
                                             names=names)

        made = self._source().mapInArrow(cells, "model int, node int, feature int, cell int, sum double, n double")
        for r in made.repartition("model", "node").mapInArrow(split, FOUND).collect():  # one row a model and open node
            m = models[r["model"]]
            if r["node"] < 0:
                m.judge(float(np.sqrt(r["sum"] / r["n"])))
                continue
            if r["node"] == 0:
                m.tree.value[0] = leaf_value(m.plan, r["sum"], r["n"])
            if worth(r["gain"], r["sum"]):
                halves = (r["left_sum"], r["left_n"]), (r["sum"] - r["left_sum"], r["n"] - r["left_n"])
                for node, (_, n) in zip(m.tree.split(r["node"], r["feature"], r["cut"], tuple(leaf_value(m.plan, *h) for h in halves)), halves):
                    if level + 1 >= m.plan.max_depth:
                        continue
                    if n <= SMALL_ROWS:
                        m.small.append((node, level + 1))
                    else:
                        m.open.append(node)
            m.open.remove(r["node"])

    def _finish(self, models: Sequence[Growing]) -> None:
        """Grows the small nodes of all models to their leaves, each where its points meet."""
        start, places, slim = self.start, self._places(models), [m.for_tasks() for m in models]

        def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks_in(batches):
                for i, (m, place) in enumerate(zip(slim, places)):
                    n, total = b.drawn_sums(m.draw(b, m.turn))
                    yield from node_points(i, [node for node, _ in m.small], m.tree.nodes(b.cells), b.cells, n, total - n * m.margin(b, start, place))

        def grown(rows: pa.Table) -> pa.Table:
            i, node, bins, n, pull = met_points(rows)
            m = slim[i]
            tree = boosted_out(by_feature(bins), pull, n, m.columns, m.plan.max_depth - dict(m.small)[node], m.plan)
            return pa.table([pa.array([i], pa.int32()), pa.array([node], pa.int32()), pa.array([tree.packed()], pa.binary())], names=["model", "node", "tree"])

        # As many tasks as there are nodes, so that those of several models grow side by side.
        tasks = max(1, min(sum(len(m.small) for m in models), TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism))
        rows = self._source().mapInArrow(sent, POINTS).repartition(tasks, "model", "node").groupBy("model", "node").applyInArrow(
            grown, "model int, node int, tree binary")
        for r in rows.collect():  # one row a small node, as long as its tree
            models[r["model"]].tree.graft(r["node"], Tree.unpacked(r["tree"]))


RECORD = "model int, turn int, part int, block long, a binary, b binary, c binary"
POINTS = "model int, node int, cells binary, n binary, pull binary"


def node_points(model: int, nodes: Sequence[int], at: np.ndarray, cells: np.ndarray, n: np.ndarray, pull: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One record for each of some nodes: the points that ended in it, by the node `at` which each point ended."""
    wanted = np.zeros(max(at.max(initial=0), *nodes, 0) + 1 if nodes else 1, bool)
    wanted[list(nodes)] = True
    use = np.flatnonzero((n > 0) & wanted[at]) if nodes else np.zeros(0, np.intp)
    if not len(use):
        return
    use = use[np.argsort(at[use], kind="stable")]
    found, first = np.unique(at[use], return_index=True)
    ends = np.append(first, len(use))
    columns = [pa.array([np.ascontiguousarray(c[use[a:b]]).tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
               for c in (cells, n.astype(np.uint32), pull)]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), model, np.int32)), pa.array(found.astype(np.int32)), *columns],
                                     names=["model", "node", "cells", "n", "pull"])


def met_points(rows: pa.Table) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Model and node of a group of records of `node_points`, and its points: bins, numbers of rows, sums."""
    cells, n, pull = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("cells", np.uint8), ("n", np.uint32), ("pull", np.float64)))
    return rows.column("model")[0].as_py(), rows.column("node")[0].as_py(), cells.reshape(len(n), -1), n.astype(np.float64), pull


def record(model: int, turn: int, part: int, block: int, *columns: np.ndarray | None) -> pa.RecordBatch:
    """What `joined` puts together."""
    return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (model, turn, part)), pa.array([block], pa.int64()),
                                       *(pa.array([None if c is None else np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns)],
                                      names=["model", "turn", "part", "block", "a", "b", "c"])


def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list]]:
    """Per model and turn, whose records follow each other, the columns a and b of all blocks put together, and the list of c."""
    rows = ((tuple(batch.column(c)[i].as_py() for c in ("model", "turn")), [batch.column(c)[i].as_py() for c in "abc"])
            for batch in batches for i in range(batch.num_rows))
    for key, some in groupby(rows, lambda r: r[0]):
        a, b, c = zip(*(columns for _, columns in some))
        yield key, [b"".join(x or b"" for x in a), b"".join(x or b"" for x in b), list(c)]


def cell_batch(model, node, feature, cell, sums, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(np.int32)) for c in (model, node, feature, cell)]
                                      + [pa.array(np.asarray(c, np.float64)) for c in (sums, n)],
                                      names=["model", "node", "feature", "cell", "sum", "n"])


def flat_cells(model: int, m: Growing, sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """The cells that hold rows, one a row."""
    slot, column, cell = np.nonzero(counts)
    return cell_batch(np.full(len(slot), model), np.array(m.open)[slot], np.array(m.columns)[column], cell,
                      sums[slot, column, cell], counts[slot, column, cell])


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Sum of trees over binned features; everything it knows is JSON text in `trees`, so it is saved like any stage."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "start, edges and trees (compressed, base64) as JSON text", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", trees="{}")

    @staticmethod
    def of(start: float, edges: Sequence[Sequence[float]], trees: Sequence[Tree]) -> "BoostedTreesModel":
        out = BoostedTreesModel()
        out._set(trees=json.dumps({"start": start, "edges": [list(e) for e in edges],
                                   "trees": [b64encode(t.shrunk()).decode() for t in trees]}))
        return out

    @property
    def n_trees(self) -> int:
        return len(json.loads(self.getOrDefault("trees"))["trees"])

    def setPredictionCol(self, value: str) -> "BoostedTreesModel":
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = self.getOrDefault("trees")

        @F.pandas_udf("double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = json.loads(text)
            start, edges, trees = known["start"], known["edges"], [Tree.grown_back(b64decode(t)) for t in known["trees"]]
            for vectors in batches:
                if not len(vectors):
                    yield pd.Series([], dtype=float)
                    continue
                bins = binned_array(np.stack(vectors.to_numpy()), edges)
                yield pd.Series(start + sum((t.predict(bins) for t in trees), np.zeros(len(bins))))

        return dataset.withColumn(self.getOrDefault("predictionCol"), predicted(vector_to_array(self.getOrDefault("featuresCol"))))


class BoostedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with Newton leaf values and gains, a leaf penalty, row and column sampling for each tree.

    With `validationIndicatorCol` the rows marked true are held out; growth stops when their error improves too little (see `Plan`),
    and the trees after the best round are dropped. Features equal to NaN go to the last bin.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    validationIndicatorCol = Param(Params._dummy(), "validationIndicatorCol", "rows to stop by", TypeConverters.toString)
    plan = Param(Params._dummy(), "plan", "the plan as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", validationIndicatorCol="", plan="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", validationIndicatorCol="", plan="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        features, label, mark = (self.getOrDefault(c) for c in ("featuresCol", "labelCol", "validationIndicatorCol"))
        held = F.coalesce(F.col(mark), F.lit(False)) if mark else F.lit(False)
        booster = Booster(dataset.where(~held), dataset.where(held), features, label)
        try:
            growing = Growing(0, replace(Plan(), **json.loads(self.getOrDefault("plan"))))
            booster.advance([growing], growing.plan.rounds)
            model = booster.model(growing)
        finally:
            booster.close()
        return model._set(featuresCol=features)
