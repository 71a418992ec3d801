"""Nearest neighbours by low-dimensional stable projections, kd-trees and a chi-square stopping test."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil, exp, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import pick, stored


@dataclass(frozen=True)
class Settings:
    """`sample` rows fit the coarse tree (never more cells than a quarter of it); blocks bound what one task holds."""

    projections: int = 8
    confidence: float = 0.98
    sample: int = 32768
    block_rows: int = 8192
    block_queries: int = 4096
    leaf: int = 256
    seed: int = 3


def chi_square_quantile(p: float, freedom: int) -> float:
    """The quantile for an even number of degrees of freedom, by bisection of the closed form."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Projection:
    """Gaussian projections of vectors lifted to one length, so that nearest and largest inner product mean the same.

    A row x becomes (x, sqrt(longest^2 - |x|^2)) and a query q becomes (q, 0): the squared distance is then
    |q|^2 + longest^2 - 2 q.x, and the squared distance of the projections over it follows a chi-square law.
    """

    def __init__(self, dim: int, longest: float, s: Settings) -> None:
        self.axes = np.random.default_rng(s.seed).standard_normal((dim + 1, s.projections))
        self.longest = longest
        self.limit = chi_square_quantile(s.confidence, s.projections)

    def rows(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return x @ self.axes[:-1] + lift[:, None] * self.axes[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.axes[:-1]

    def reach(self, q: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """Squared projected distance beyond which the test says that nothing better than score `worst` is left."""
        return ((q * q).sum(axis=1) + self.longest**2 - 2 * worst) * self.limit


def kd_cells(points: np.ndarray, depth: int) -> tuple[list[tuple[int, float]], np.ndarray, np.ndarray]:
    """Splits (axis, cut) in heap order, and the boxes of the 2^depth cells, by medians of the widest axis."""
    dims = points.shape[1]
    splits: list[tuple[int, float]] = []
    level = [(points, np.full(dims, -np.inf), np.full(dims, np.inf))]
    for _ in range(depth):
        grown = []
        for inside, low, high in level:
            axis = int(np.argmax(np.ptp(inside, axis=0))) if len(inside) else 0
            cut = float(np.median(inside[:, axis])) if len(inside) else 0.0
            splits.append((axis, cut))
            left = inside[:, axis] <= cut
            below, above = high.copy(), low.copy()
            below[axis], above[axis] = min(high[axis], cut), max(low[axis], cut)
            grown += [(inside[left], low, below), (inside[~left], above, high)]
        level = grown
    return splits, np.array([low for _, low, _ in level]), np.array([high for _, _, high in level])


def cell_of(points: np.ndarray, splits: list[tuple[int, float]], depth: int) -> np.ndarray:
    """The cell each point falls into; points on a cut go to the lower side."""
    node = np.zeros(len(points), np.int64)
    if depth:
        axis, cut = np.array([a for a, _ in splits]), np.array([c for _, c in splits])
        for _ in range(depth):
            right = points[np.arange(len(points)), axis[node]] > cut[node]
            node = 2 * node + 1 + right
        node -= (1 << depth) - 1
    return node


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from points to boxes, one row per point."""
    out = np.empty((len(points), len(low)))
    for at in range(0, len(points), 256):
        part = points[at:at + 256, None, :]
        gap = np.maximum(np.maximum(low - part, part - high), 0)
        out[at:at + 256] = (gap * gap).sum(axis=2)
    return out


def leaves_of(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halves at the median place of the widest axis until a leaf is small."""
    out, open_nodes = [], [np.arange(len(points))]
    while open_nodes:
        rows = open_nodes.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        axis = int(np.argmax(np.ptp(points[rows], axis=0)))
        halves = np.argpartition(points[rows, axis], len(rows) // 2)
        open_nodes += [rows[halves[:len(rows) // 2]], rows[halves[len(rows) // 2:]]]
    return out


def search_block(q: np.ndarray, worst: np.ndarray, x: np.ndarray, order: np.ndarray, want: int, projection: Projection,
                 leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Best `want` scores and row numbers (-1: none) of a block for each query, ties to the smaller `order`.

    Leaves come up in the order of their projected distance; their rows are verified with exact inner products. A query stops as
    soon as the next leaf lies beyond the chi-square reach of its current worst score, `worst` at the start.
    """
    projected = projection.rows(x)
    leaves = leaves_of(projected, leaf)
    low = np.array([projected[r].min(axis=0) for r in leaves])
    high = np.array([projected[r].max(axis=0) for r in leaves])
    far = box_distance(projection.queries(q), low, high)
    turn = np.argsort(far, axis=1, kind="stable")
    score, row = np.full((len(q), want), -np.inf), np.full((len(q), want), -1, np.int64)
    rank = np.full((len(q), want), np.iinfo(np.int64).max)
    bound = worst.copy()
    active = np.arange(len(q))
    for step in range(len(leaves)):
        nearest = turn[active, step]
        active = active[far[active, nearest] <= projection.reach(q[active], bound[active])]
        if not len(active):
            break
        nearest = turn[active, step]
        by_leaf = np.argsort(nearest, kind="stable")
        for group in np.split(by_leaf, np.flatnonzero(np.diff(nearest[by_leaf])) + 1):
            who, members = active[group], leaves[nearest[group[0]]]
            got = q[who] @ x[members].T
            better = (got >= bound[who, None]).any(axis=1)
            who, got = who[better], got[better]
            if not len(who):
                continue
            all_scores = np.hstack([score[who], got])
            all_ranks = np.hstack([rank[who], np.broadcast_to(order[members], got.shape)])
            all_rows = np.hstack([row[who], np.broadcast_to(members, got.shape)])
            best = np.lexsort((all_ranks, -all_scores), axis=-1)[:, :want]
            score[who] = np.take_along_axis(all_scores, best, axis=1)
            rank[who] = np.take_along_axis(all_ranks, best, axis=1)
            row[who] = np.take_along_axis(all_rows, best, axis=1)
            bound[who] = np.maximum(bound[who], score[who, -1])
    return score, row


def as_matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), np.float64).reshape(len(whole), dim)


def usable(vectors: DataFrame, vector: str) -> Column:
    """Vectors that are not null, hold finite numbers only, and are not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
                       settings: Settings = Settings()) -> DataFrame:
    """One row per query and neighbour: query_id, rank (from 1), vec_id, score (inner product in double precision).

    Equal vectors are searched once, under their smallest key, and written out again afterwards by their k + 1 smallest keys, so
    crowds of copies cost one search. A coarse kd-tree over the projections of a bounded sample gives every distinct vector its
    cell, cut into blocks of bounded size. Queries first search their own cell; the score they reach there decides, by the
    chi-square test, which other cells they still have to see.

    Vectors that are null, zero, or hold null or non-finite components take no part, as neither do those without a key, nor those
    whose length is not the most frequent one. Candidates are all rows but those with the query's own key; ties go to the smaller
    key; fewer than k candidates give fewer rows. A table without usable vectors gives no rows.
    """
    s, spark = settings, vectors.sparkSession
    rows = pick(vectors, key, vector).select(
        F.col(key).alias("id"), F.transform(vector, lambda v: v.cast("double") + 0.0).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(rows, "v"))
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim = common["dim"] if common else 1
    rows = rows.where(F.size("v") == dim).select(
        "id", "v", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"), "asks")
    grouped = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("asks").alias("asks"), F.first("v").alias("v"))
    distinct = stored(grouped.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = distinct.agg(F.count("*").alias("n"), F.max(length).alias("longest"),
                         F.count(F.when(F.col("asks"), 1)).alias("queries")).first()
    projection = Projection(dim, facts["longest"] or 0.0, s)
    drawn = distinct.select("v").orderBy(F.xxhash64(F.lit(s.seed), "v")).limit(s.sample).collect()
    points = projection.rows(np.array([r["v"] for r in drawn], np.float64).reshape(-1, dim))
    depth = max(0, min(ceil(log2(max(1, facts["n"] / s.block_rows))), int(log2(max(4, len(points)))) - 2))
    splits, low, high = kd_cells(points, depth)

    def celled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cell_of(projection.rows(as_matrix(batch.column("v"), dim)), splits, depth)
            yield batch.append_column("cell", pa.array(cell))

    placed = stored(distinct.select("uid", "first", "asks", "v").mapInArrow(
        celled, "uid long, first long, asks boolean, v array<double>, cell long"), "cells")
    # Crowded cells are cut further, so that a block fits a task whatever the tree makes of the data.
    crowd = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(s.block_rows)).cast("int").alias("blocks"))
    crowd = stored(crowd, "crowd")
    block = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block")
    stock = placed.join(crowd, "cell").select("cell", block, "uid", "first", "v")
    asking = placed.where("asks").select("uid", "v", "cell")

    def listed(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    def searched(visits: DataFrame, name: str) -> DataFrame:
        """visits: uid, v, worst, cell; all blocks of the cell answer.

        The queries that visit a cell are dealt into as many turns as their number asks for, and the cell's rows are copied once a
        turn: cells without visits are not copied at all.
        """
        turns = stored(visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(s.block_queries)).cast("int").alias("turns")), name)
        turn = F.pmod(F.xxhash64(F.lit(s.seed), "uid"), F.col("turns")).cast("int").alias("turn")
        asked = visits.join(crowd, "cell").join(turns, "cell").select("cell", turn, "uid", "v", "worst", listed(F.col("blocks")).alias("block"))
        # Both sides stem from one table; fresh names keep them apart.
        asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])
        answering = stock.join(turns, "cell").select("cell", "block", "uid", "first", "v", listed(F.col("turns")).alias("turn"))

        def answered(key_values, queries: pa.Table, stocked: pa.Table) -> pa.Table:
            names = ["quid", "uid", "first", "score"]
            if not queries.num_rows or not stocked.num_rows:
                return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=names)
            first = stocked.column("first").to_numpy()
            score, row = search_block(as_matrix(queries.column("v"), dim), queries.column("worst").to_numpy().astype(np.float64),
                                      as_matrix(stocked.column("v"), dim), first, k + 1, projection, s.leaf)
            who, place = np.nonzero(row >= 0)
            took = row[who, place]
            return pa.table([pa.array(queries.column("uid").to_numpy()[who]), pa.array(stocked.column("uid").to_numpy()[took]),
                             pa.array(first[took]), pa.array(score[who, place])], names=names)

        return asked.groupBy("cell", "block", "turn").cogroup(answering.groupBy("cell", "block", "turn")).applyInArrow(
            answered, "quid long, uid long, first long, score double")

    best = Window.partitionBy("quid").orderBy(F.desc("score"), "first")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)

    home = stored(top(searched(asking.withColumn("worst", F.lit(float("-inf"))), "home-turns")), "own-cell")
    worst = home.where(F.col("place") == k + 1).select(F.col("quid").alias("uid"), F.col("score").alias("worst"))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = as_matrix(batch.column("v"), dim)
            bound = batch.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)
            near = box_distance(projection.queries(q), low, high) <= projection.reach(q, bound)[:, None]
            near[np.arange(len(q)), batch.column("cell").to_numpy()] = False
            who, cell = np.nonzero(near)
            at = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid").take(at), batch.column("v").take(at), batch.column("worst").take(at), pa.array(cell.astype(np.int64))],
                names=["uid", "v", "worst", "cell"])

    bounded = asking.join(worst, "uid", "left").select(
        "uid", "v", F.coalesce("worst", F.lit(float("-inf"))).alias("worst"), "cell")
    away = searched(bounded.mapInArrow(spread, "uid long, v array<double>, worst double, cell long"), "away-turns")
    merged = stored(top(home.drop("place").unionByName(away)), "neighbours")

    # Back from distinct vectors to rows: no more than the k + 1 smallest keys of a vector can count.
    owners = rows.select("id", "h1", "h2", "asks").join(distinct.select("h1", "h2", "uid"), ["h1", "h2"])
    owners = stored(owners.select("id", "uid", "asks"), "owners")
    smallest = Window.partitionBy("uid").orderBy("id")
    members = owners.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1).select("uid", F.col("id").alias("member"))
    answers = owners.where("asks").select(F.col("id").alias("query_id"), F.col("uid").alias("quid")).join(
        merged.select("quid", "uid", "score"), "quid").join(members, "uid").where(F.col("member") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "member")
    return answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("member").alias("vec_id"), "score")
