import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import projected_nn as nn


def brute(ids, x, is_query, k):
    out = {}
    for i in np.flatnonzero(is_query):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 9))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("blocks", [(8192, 4096), (50, 7)])
def test_recall_against_brute_force(spark, sf, blocks):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    s = nn.Settings(block_rows=blocks[0], block_queries=blocks[1], leaf=16)
    got = answers(nn.nearest_neighbours(table, F.col("vec_id") % 20 == 0, settings=s))
    want = brute(ids, x, ids % 20 == 0, 20)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == 20 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(s - x[ids == q][0] @ x[ids == v][0]) < 1e-12 for v, s in found)


def test_recall_at_default_settings_over_several_cells(spark):
    """20,000 vectors, half of them in clusters: four cells, some of which a query does not visit."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(40, 16)) * 3
    x = np.vstack([rng.normal(size=(10_000, 16)), centres[rng.integers(0, 40, 10_000)] + rng.normal(size=(10_000, 16)) * 0.3])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = answers(nn.nearest_neighbours(table, F.col("vec_id") % 50 == 0))
    want = brute(np.arange(20_000), x, np.arange(20_000) % 50 == 0, 20)
    assert got.keys() == want.keys()
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.95 * sum(map(len, want.values()))


def test_lengths_count_and_copies_are_whole(spark):
    """Vectors of many lengths and a crowd of copies: the largest inner product wins, equal ones by key."""
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (300, 6)).astype(float) * rng.choice([1, 5], (300, 1))
    x[100:180] = [9, 0, 0, 0, 0, 0]
    x[np.abs(x).sum(axis=1) == 0, 0] = 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    s = nn.Settings(confidence=0.999999, block_rows=40, block_queries=5, leaf=8)
    got = answers(nn.nearest_neighbours(table.withColumn("uid", F.lit("x")), F.col("vec_id") % 20 == 0, settings=s))
    assert got == brute(np.arange(300), x, np.arange(300) % 20 == 0, 20)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]),
            (None, [1.0, 1.0]), (20, [0.0, 0.0]), (8, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert answers(nn.nearest_neighbours(table, F.col("vec_id") % 20 == 0)) == {0: [(1, 0.5)]}
    assert nn.nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nn.nearest_neighbours(table.where("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square_quantiles():
    assert nn.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert nn.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2))
