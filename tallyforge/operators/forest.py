"""Random forests grown from grouped histograms over rows that lie together by their bins."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import boost
from tallyforge.operators.ranks import range_count
from tallyforge.session import scratch_path

#: Bins of a feature, and rows that tell their edges: Spark's own defaults.
BINS, EDGE_ROWS = 32, 10_000
#: Rows that a block holds, and rows below which a table is not worth another task.
BLOCK_ROWS, LEAST_ROWS = 1 << 17, 2_000
#: Cells (tree, node, feature, bin) of the histograms that a task holds at once.
CELLS = 1 << 21
#: Nodes of all trees that a model keeps on the driver, and bytes of trees that a task holds that scores by a written forest.
KEPT_NODES, GROUP_BYTES = 1 << 22, 1 << 26
#: Nodes of a tree that draw their features by one generator, beyond the first so many.
LOT = 512
#: Cells that travel as one record when they are scored.
SCORED_CELLS = 1 << 16
BLOCK = "cells binary, starts binary, label binary, mark binary, part int"
#: How often a row is drawn into a tree, by 16 random bits: a Poisson number with mean one.
TIMES = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float64)


@dataclass(frozen=True)
class ForestPlan:
    """What a forest is grown by; each node tries its own draw of the share `columns` of the features."""

    trees: int = 100
    max_depth: int = 5
    columns: float = 1.0
    min_rows: float = 1.0
    seed: int = 42


def edges_between(values: np.ndarray, bins: int = BINS) -> list[float]:
    """Upper edges of all bins but the last, halfway between neighbouring values: all of them, or those nearest to even shares of the rows."""
    known, counts = np.unique(values, return_counts=True)
    halfway = (known[:-1] + known[1:]) / 2
    if len(halfway) < bins:
        return halfway.tolist()
    edges, stride, seen = [], len(values) / bins, counts.cumsum()
    target = stride
    for i in range(1, len(known)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            edges.append(float(halfway[i - 1]))
            target += stride
    return edges


def sampled_edges(df: DataFrame, features: str, rows: int, seed: int, bins: int = BINS) -> list[list[float]]:
    """Edges of every feature from as many rows as Spark's trees take for their splits (all rows, if there are no more)."""
    wanted = max(bins * bins, EDGE_ROWS)
    part = df if rows <= wanted else df.sample(False, wanted / rows, seed)

    def found(pos: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pos": pos["pos"].iloc[:1], "edges": [edges_between(pos["col"].to_numpy(), bins)]})

    said = part.select(F.posexplode(vector_to_array(features))).groupBy("pos").applyInPandas(found, "pos int, edges array<double>").collect()
    return [list(r["edges"]) for r in sorted(said)]  # one row a feature, fewer edges than bins in each


def blocks(df: DataFrame, features: str, label: str, rows: int, mean: float, edges: Sequence[Sequence[float]], seed: int) -> DataFrame:
    """Blocks of rows sorted by their bins: the distinct bins, where each starts, and labels (less the mean) and random marks of the rows.

    Rows travel by ranges of bins and mark, so a task has few distinct bins and bins of very many rows are shared out.
    """

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column("v").flatten(), np.float64).reshape(batch.num_rows, -1)
                if not np.isfinite(values).all():
                    raise ValueError("features of a forest must be finite")
                yield pa.RecordBatch.from_arrays([boost.packed_matrix(boost.binned_array(values, edges)), batch.column("label"), batch.column("mark")],
                                                 names=["bins", "label", "mark"])

    def packed(parts: list[tuple[np.ndarray, ...]], part: int) -> pa.RecordBatch:
        bins, labels, marks = (np.concatenate(c) for c in zip(*parts))
        fresh = np.ones(len(bins), bool)
        fresh[1:] = (bins[1:] != bins[:-1]).any(axis=1)
        starts = np.flatnonzero(fresh)
        return pa.RecordBatch.from_arrays([*(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in (bins[starts], starts, labels, marks)),
                                           pa.array([part], pa.int32())], names=["cells", "starts", "label", "mark", "part"])

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                parts.append((boost.matrix(batch.column("bins"), np.uint8, batch.num_rows), batch.column("label").to_numpy(), batch.column("mark").to_numpy()))
            if sum(len(p[1]) for p in parts) >= BLOCK_ROWS:
                yield packed(parts, part)
                parts = []
        if parts:
            yield packed(parts, part)

    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, min(cores, rows // LEAST_ROWS), rows // BLOCK_ROWS)
    made = df.select(vector_to_array(features).alias("v"), (F.col(label).cast("double") - F.lit(mean)).alias("label"),
                     F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("mark"))
    made = made.mapInArrow(binned, "bins binary, label double, mark long").repartitionByRange(tasks, "bins", "mark")
    made = made.sortWithinPartitions("bins").withColumn("part", F.spark_partition_id())
    # Written once, so that a repeated task of a level meets the same rows.
    path = scratch_path(spark, "forest")
    made.mapInArrow(gathered, BLOCK).write.parquet(path)
    parts = min(tasks, boost.TASKS_PER_CORE * cores)
    return spark.read.schema(BLOCK).parquet(path).repartitionById(parts, F.col("part") % parts)


def times_drawn(marks: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree draws each row: a hash of the row's random mark with numbers of the tree, so that a repeated task draws the same."""
    factor, shift = np.random.default_rng([seed, tree]).integers(0, 1 << 63, 2, np.uint64)
    return TIMES[(marks.view(np.uint64) * (factor * np.uint64(2) + np.uint64(1)) + shift) >> np.uint64(48)]


def drawn_sums(starts: np.ndarray, label: np.ndarray, marks: np.ndarray, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of labels of the rows that a tree draws, by cell."""
    times = times_drawn(marks, seed, tree)
    return np.add.reduceat(times, starts), np.add.reduceat(times * label, starts)


def blocks_in(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Part, number in the part's task, distinct bins, starts, labels and marks of each block."""
    seen = 0
    for batch in batches:
        for i in range(batch.num_rows):
            bins, starts, label, marks = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in (
                ("cells", np.uint8), ("starts", np.int64), ("label", np.float64), ("mark", np.int64)))
            yield batch.column("part")[i].as_py(), seen, bins.reshape(len(starts), -1), starts, label, marks
            seen += 1


def tried(seed: int, *numbers: int) -> np.ndarray:
    """Which features a node tries: `tried(seed, tree, node, width, count)`; nodes below one that is grown out have its number before theirs."""
    *where, node, width, count = numbers
    return tried_by(seed, where, np.array([node]), width, count)[0]


def tried_by(seed: int, where: Sequence[int], nodes: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which features some nodes of a tree try. The first LOT nodes have a generator each, later ones share one by lots: deep trees have very many."""
    out = np.zeros((len(nodes), width), bool)
    for i in np.flatnonzero(nodes < LOT):
        out[i, np.random.default_rng([seed, *where, int(nodes[i])]).permutation(width)[:count]] = True
    lots = nodes // LOT
    for lot in np.unique(lots[lots > 0]):
        drawn = np.random.default_rng([seed, *where, int(lot), LOT]).permuted(np.tile(np.arange(width), (LOT, 1)), axis=1) < count
        mine = np.flatnonzero(lots == lot)
        out[mine] = drawn[nodes[mine] % LOT]
    return out


class _TreesWriter(DefaultParamsWriter):
    """Parameters as JSON; the trees beside them as parquet."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.trees.write.parquet(f"{path}/trees")


class _TreesReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.trees = self.sparkSession.read.schema(WrittenForest.TREES).parquet(f"{path}/trees")
        return model


class WrittenForest(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A forest whose trees are a table, one record a tree: deep forests have more nodes than a driver should hold.

    Distinct bins of the rows travel to every group of trees; their sums meet per block of bins and are joined to the rows.
    """

    TREES = "tree int, data binary"
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    known = Param(Params._dummy(), "known", "start, edges and number of groups of trees as JSON text", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", known="{}")
        self.trees: DataFrame | None = None

    @staticmethod
    def of(start: float, edges: Sequence[Sequence[float]], trees: DataFrame) -> "WrittenForest":
        said = trees.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("data")).alias("bytes")).first()
        # Trees take several times their compressed bytes.
        groups = min(said["n"], max(trees.sparkSession.sparkContext.defaultParallelism, 8 * said["bytes"] // GROUP_BYTES))
        out = WrittenForest()._set(known=json.dumps({"start": start, "edges": [list(e) for e in edges], "groups": groups, "n_trees": said["n"]}))
        out.trees = trees
        return out

    def write(self) -> _TreesWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> _TreesReader:
        return _TreesReader(cls)

    @property
    def n_trees(self) -> int:
        return json.loads(self.getOrDefault("known"))["n_trees"]

    def setPredictionCol(self, value: str) -> "WrittenForest":
        return self._set(predictionCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = json.loads(self.getOrDefault("known"))
        start, edges, groups, width = known["start"], known["edges"], known["groups"], len(known["edges"])

        @F.pandas_udf("binary")
        def binned(vectors: pd.Series) -> pd.Series:
            return pd.Series([b.tobytes() for b in boost.binned_array(np.stack(vectors.to_numpy()), edges)] if len(vectors) else [], dtype=object)

        def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = 0
            for batch in batches:
                for low in range(0, batch.num_rows, SCORED_CELLS):
                    some = batch.slice(low, SCORED_CELLS)
                    yield pa.RecordBatch.from_arrays([some.column("part")[:1], pa.array([block], pa.int32()),
                                                      pa.array([boost.matrix(some.column("bins"), np.uint8, some.num_rows).tobytes()], pa.binary())],
                                                     names=["part", "block", "data"])
                    block += 1

        def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # The trees of the group come first.
            trees = []
            for batch in batches:
                for i in range(batch.num_rows):
                    part, data = batch.column("part")[i].as_py(), batch.column("data")[i].as_py()
                    if part < 0:
                        trees.append(boost.Tree.grown_back(data))
                        continue
                    cells = np.frombuffer(data, np.uint8).reshape(-1, width)
                    sums = sum((t.predict(cells) for t in trees), np.zeros(len(cells)))
                    yield pa.RecordBatch.from_arrays([batch.column("part")[i:i + 1], batch.column("block")[i:i + 1], batch.column("data")[i:i + 1],
                                                      pa.array([sums.tobytes()], pa.binary())], names=["part", "block", "data", "sums"])

        def added(rows: pa.Table) -> pa.Table:
            bins = np.frombuffer(rows.column("data")[0].as_py(), np.uint8).reshape(-1, width)
            sums = sum(np.frombuffer(x) for x in sorted(rows.column("sums").to_pylist()))
            return pa.table([boost.packed_matrix(bins), pa.array(start + sums)], names=["__bins", "__said"])

        rows = dataset.withColumn("__bins", binned(vector_to_array(self.getOrDefault("featuresCol"))))
        # Sorted, so that a repeated task makes the same blocks.
        cells = rows.select(F.col("__bins").alias("bins")).distinct().sortWithinPartitions("bins").withColumn("part", F.spark_partition_id())
        cells = cells.mapInArrow(packed, "part int, block int, data binary").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        trees = self.trees.select(F.lit(-1).alias("part"), F.col("tree").alias("block"), "data", (F.col("tree") % groups).alias("g"))
        both = trees.unionByName(cells).repartitionById(groups, "g").sortWithinPartitions("part", "block")
        sums = both.mapInArrow(scored, "part int, block int, data binary, sums binary").groupBy("part", "block").applyInArrow(added, "__bins binary, __said double")
        return rows.join(sums, "__bins").withColumn(self.getOrDefault("predictionCol"), F.col("__said")).drop("__bins", "__said")


class RandomForest(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of regression trees, each over rows drawn with replacement (Poisson numbers), each node trying some of the features.

    Tasks draw the rows of every tree and sum them up per distinct bins (points). Trees of few points are grown in one task each, many side by
    side; else a level of all trees is one job (or several, so that histograms fit a task), in which the cells of a node meet in one place and
    the driver gets one row a node, until the points of a node are few.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    plan = Param(Params._dummy(), "plan", "the plan as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", plan="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", plan="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> boost.BoostedTreesModel | WrittenForest:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        plan = replace(ForestPlan(), **json.loads(self.getOrDefault("plan")))
        said = dataset.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("mean"),
                           F.count_if(F.col(label).isNull() | F.isnan(F.col(label).cast("double"))).alias("bad")).first()
        if not said["rows"]:
            raise ValueError("no rows to fit on")
        if said["bad"]:
            raise ValueError("labels must not be null or NaN")
        edges = sampled_edges(dataset, features, said["rows"], plan.seed)
        base = blocks(dataset, features, label, said["rows"], said["mean"], edges, plan.seed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            points = base.agg(F.sum(F.length("starts") / 8).cast("long")).first()[0]
            trees = whole_trees(base, len(edges), plan, points) if points <= boost.SMALL_ROWS else grown(base, len(edges), plan, points)
        finally:
            base.unpersist()
        if isinstance(trees, DataFrame):
            return WrittenForest.of(said["mean"], edges, trees)._set(featuresCol=features)
        return boost.BoostedTreesModel.of(said["mean"], edges, trees)._set(featuresCol=features)


def rules(plan: ForestPlan, width: int, *numbers: int) -> dict[str, Callable | float | None]:
    """How `boost.grown_out` grows nodes of a forest; the numbers say of which tree."""
    count = max(1, math.ceil(plan.columns * width))

    def value(sums, n):
        return np.where(n > 0, sums / np.maximum(n, 1), 0.0)

    def may(nodes: np.ndarray) -> np.ndarray:
        return tried_by(plan.seed, numbers, nodes, width, count)

    return {"penalty": 0.0, "min_rows": plan.min_rows, "value": value, "good": lambda gain, sums, n: gain > 1e-12 * sums**2 / np.maximum(n, 1),
            "may": may if count < width else None}


def kept(made: DataFrame, plan: ForestPlan, points: int, path: str, last: bool) -> list[boost.Tree] | DataFrame | None:
    """Trees of a job (tree, data): on the driver, or, if they may have very many nodes, added to the table at `path`."""
    if plan.trees * min(1 << plan.max_depth + 1, 2 * points) <= KEPT_NODES:
        return [boost.Tree.grown_back(r["data"]) for r in sorted(made.collect())]
    made.write.mode("append").parquet(path)
    return made.sparkSession.read.schema(WrittenForest.TREES).parquet(path) if last else None


def shared(tree: boost.Tree, trees: int) -> boost.Tree:
    """A tree with its share in the mean."""
    return replace(tree, value=np.array(tree.value) / trees)


def whole_trees(base: DataFrame, width: int, plan: ForestPlan, points: int) -> list[boost.Tree] | DataFrame:
    """The trees of a forest over few points, each grown in one task; a job sends the drawn points of as many trees as SENT_BYTES hold."""
    spark = base.sparkSession
    some, path = max(1, boost.SENT_BYTES // (12 * points)), scratch_path(spark, "forest-trees")
    out: list[boost.Tree] = []
    for low in range(0, plan.trees, some):
        numbers = range(low, min(low + some, plan.trees))
        tasks = min(len(numbers), boost.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

        def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, block, bins, starts, label, marks in blocks_in(batches):
                for task in range(tasks):
                    yield boost.record(task, -1, part, block, bins, None, None)
                for t in numbers:
                    n, pull = drawn_sums(starts, label, marks, plan.seed, t)
                    yield boost.record(t % tasks, t, part, block, n.astype(np.uint32), pull, None)

        def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (_, t), (a, b, _) in boost.joined(batches):
                if t < 0:
                    bins = boost.by_feature(np.frombuffer(a, np.uint8).reshape(-1, width))
                    continue
                n, pull = np.frombuffer(a, np.uint32).astype(np.float64), np.frombuffer(b)
                tree = boost.grown_out(bins, pull, n, range(width), plan.max_depth, **rules(plan, width, t))
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([shared(tree, plan.trees).shrunk()], pa.binary())], names=["tree", "data"])

        made = base.mapInArrow(sent, boost.RECORD).repartitionById(tasks, "model").sortWithinPartitions("model", "turn", "part", "block")
        found = kept(made.mapInArrow(grow, WrittenForest.TREES), plan, points, path, numbers[-1] + 1 == plan.trees)
        if isinstance(found, DataFrame):
            return found
        out += found or []
        boost.sweep(spark)
    return out


def grown(base: DataFrame, width: int, plan: ForestPlan, points: int) -> list[boost.Tree] | DataFrame:
    """The trees of a forest over many points: level by level, until the points of a node may meet in one task."""
    trees = [boost.Tree() for _ in range(plan.trees)]
    level: list[tuple[int, list[int]]] = [(t, [0]) for t in range(plan.trees)]
    small: list[tuple[int, int, int]] = []
    most = max(1, CELLS // (width * BINS))  # nodes of one job
    for depth in range(plan.max_depth):
        jobs: list[list[tuple[int, list[int]]]] = []
        room = 0
        for t, nodes in level:
            for low in range(0, len(nodes), most):
                some = nodes[low:low + most]
                if len(some) > room:
                    jobs.append([])
                    room = most
                jobs[-1].append((t, some))
                room -= len(some)
        nodes_of: dict[int, list[int]] = {}
        for job in jobs:
            for t, made in split_nodes(base, trees, job, width, plan):
                nodes_of.setdefault(t, []).extend(node for node, n in made if n > boost.SMALL_ROWS)
                small += [(t, node, depth + 1) for node, n in made if n <= boost.SMALL_ROWS and depth + 1 < plan.max_depth]
        level = sorted((t, nodes) for t, nodes in nodes_of.items() if nodes)
        if not level:
            break
    return finished(base, width, plan, points, trees, small)


def finished(base: DataFrame, width: int, plan: ForestPlan, points: int, trees: list[boost.Tree], small: list[tuple[int, int, int]]
             ) -> list[boost.Tree] | DataFrame:
    """Grows out the small nodes (tree, node, depth), each where its points meet, and puts them into their trees; some trees a job."""
    spark = base.sparkSession
    some, path = max(1, boost.SENT_BYTES // (20 * points)), scratch_path(spark, "forest-trees")
    out: list[boost.Tree] = []
    for low in range(0, plan.trees, some):
        tops = {t: trees[t] for t in range(low, min(low + some, plan.trees))}
        depths = {t: {node: depth for other, node, depth in small if other == t} for t in tops}

        def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, _, bins, starts, label, marks in blocks_in(batches):
                for t, top in tops.items():
                    n, pull = drawn_sums(starts, label, marks, plan.seed, t)
                    yield from boost.node_points(t, sorted(depths[t]), top.nodes(bins), bins, n, pull)

        def grow(rows: pa.Table) -> pa.Table:
            t, node, bins, n, pull = boost.met_points(rows)
            tree = boost.grown_out(boost.by_feature(bins), pull, n, range(width), plan.max_depth - depths[t][node], **rules(plan, width, t, node))
            return pa.table([pa.array([t], pa.int32()), pa.array([node], pa.int32()), pa.array([tree.packed()], pa.binary())], names=["model", "node", "data"])

        def put_together(rows: pa.Table) -> pa.Table:
            t = rows.column("model")[0].as_py()
            tree = tops[t]
            for node, data in sorted(zip(rows.column("node").to_pylist(), rows.column("data").to_pylist())):
                if node >= 0:
                    tree.graft(node, boost.Tree.unpacked(data))
            return pa.table([pa.array([t], pa.int32()), pa.array([shared(tree, plan.trees).shrunk()], pa.binary())], names=["tree", "data"])

        tasks = max(1, min(len(tops) + sum(map(len, depths.values())), boost.TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
        made = base.mapInArrow(sent, boost.POINTS).repartition(tasks, "model", "node").groupBy("model", "node").applyInArrow(grow, "model int, node int, data binary")
        every = spark.createDataFrame([(t, -1, b"") for t in tops], "model int, node int, data binary")  # a tree without small nodes, too
        found = kept(made.union(every).groupBy("model").applyInArrow(put_together, WrittenForest.TREES), plan, points, path, low + some >= plan.trees)
        if isinstance(found, DataFrame):
            return found
        out += found or []
        boost.sweep(spark)
    return out


def split_nodes(base: DataFrame, trees: list[boost.Tree], job: Sequence[tuple[int, list[int]]], width: int, plan: ForestPlan
                ) -> list[tuple[int, list[tuple[int, float]]]]:
    """Splits open nodes of some trees by one pass over the blocks; says which new nodes are open, and how many rows each has."""
    work = [(t, trees[t], nodes) for t, nodes in job]
    count = max(1, math.ceil(plan.columns * width))
    place = np.arange(width) * BINS

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros((2, len(nodes) * width * BINS)) for _, _, nodes in work]
        for _, _, bins, starts, label, marks in blocks_in(batches):
            at = bins + place
            for (t, tree, nodes), (sums, counts) in zip(work, kept):
                slot_of = np.full(len(tree.feature), -1)
                slot_of[nodes] = np.arange(len(nodes))
                slot = slot_of[tree.nodes(bins)]
                n, pull = drawn_sums(starts, label, marks, plan.seed, t)
                use = np.flatnonzero((slot >= 0) & (n > 0))
                key = (at[use] + (slot[use] * (width * BINS))[:, None]).ravel()
                sums += np.bincount(key, np.repeat(pull[use], width), len(sums))
                counts += np.bincount(key, np.repeat(n[use], width), len(counts))
        for i, ((_, _, nodes), (sums, counts)) in enumerate(zip(work, kept)):
            found = np.flatnonzero(counts)
            slot, feature, cell = np.unravel_index(found, (len(nodes), width, BINS))
            yield boost.cell_batch(np.full(len(found), i), np.array(nodes)[slot], feature, cell, sums[found], counts[found])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(c).to_numpy() for c in ("model", "node", "feature", "cell", "sum", "n")] for b in batches if b.num_rows]
        if not parts:
            return
        columns = [np.concatenate(c) for c in zip(*parts)]
        if count < width:
            pairs, of = np.unique(columns[0].astype(np.int64) << 32 | columns[1], return_inverse=True)
            mask = np.array([tried(plan.seed, work[int(p >> 32)][0], int(p & 0xFFFFFFFF), width, count) for p in pairs])
            columns = [c[mask[of, columns[2]]] for c in columns]
        found = boost.best_splits(*columns, np.zeros(len(work)), np.full(len(work), max(plan.min_rows, 1.0)))
        names = ["model", "node", "feature", "cut", "gain", "left_sum", "left_n", "sum", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32) if k < 4 else c.astype(np.float64)) for k, c in enumerate(found)], names=names)

    made = base.mapInArrow(cells, "model int, node int, feature int, cell int, sum double, n double")
    made = made.repartition(range_count(base), "model", "node").mapInArrow(split, boost.FOUND)
    opened: dict[int, list[int]] = {}
    for r in sorted(made.collect()):  # one row a tree and open node
        t, tree, _ = work[r["model"]]
        if r["node"] == 0:
            tree.value[0] = r["sum"] / r["n"]
        if r["gain"] > 1e-12 * r["sum"]**2 / r["n"]:
            right = (r["sum"] - r["left_sum"]) / (r["n"] - r["left_n"])
            made = tree.split(r["node"], r["feature"], r["cut"], (r["left_sum"] / r["left_n"], right))
            opened.setdefault(t, []).extend(zip(made, (r["left_n"], r["n"] - r["left_n"])))
    return list(opened.items())


def random_forest(features: str, label: str, plan: ForestPlan) -> RandomForest:
    return RandomForest(featuresCol=features, labelCol=label, plan=json.dumps(asdict(plan)))
