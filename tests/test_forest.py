"""Forests from distinct bins against a plain search over the rows, and against Spark's forest."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tallyforge.operators import boost, forest, train
from tallyforge.session import scratch_path


def frame(spark, x, y):
    return spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "y"]).cache()


def data(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, (n, 3)), 1)
    x[:, 2] = rng.integers(0, 2, n)
    return x, np.sin(x[:, 0]) * 5 + x[:, 1] * x[:, 2] + rng.normal(size=n)


def plain_tree(x, y, times, edges, plan, number):
    """Predictions of one tree that tries every cut of every feature that a node may try, on the rows themselves."""
    said, count, at = np.empty(len(y)), int(np.ceil(plan.columns * x.shape[1])), 1

    def value(rows):
        return (times[rows] * y[rows]).sum() / times[rows].sum()

    level = [(0, np.ones(len(y), bool))]
    for depth in range(plan.max_depth + 1):
        following = []
        for node, rows in sorted(level, key=lambda n: n[0]):
            said[rows] = value(rows)
            best = (1e-9, None)
            may = forest.tried(plan.seed, number, node, x.shape[1], count)
            for f in np.flatnonzero(may) if depth < plan.max_depth else ():
                for cut in edges[f]:
                    left, right = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                    n = times[left].sum(), times[right].sum()
                    if min(n) >= plan.min_rows:
                        gain = sum(m * value(part) ** 2 for m, part in zip(n, (left, right))) - sum(n) * value(rows) ** 2
                        if gain > best[0] * (1 + 1e-9):
                            best = gain, (left, right)
            if best[1]:
                following += [(at, best[1][0]), (at + 1, best[1][1])]
                at += 2
        level = following
    return said


@pytest.mark.parametrize("cells", [forest.CELLS, 3 * 2 * forest.BINS])  # all nodes of a level in one job, or two
def test_forest_equals_a_plain_search(spark, monkeypatch, cells):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    monkeypatch.setattr(forest, "LEAST_ROWS", 50)
    monkeypatch.setattr(forest, "CELLS", cells)
    x, y = data(300)
    df = frame(spark, x, y)
    plan = forest.ForestPlan(trees=3, max_depth=3, columns=0.6, min_rows=4.0, seed=5)
    marks = np.array([r[0] for r in df.select(F.xxhash64(F.monotonically_increasing_id(), F.lit(5))).collect()])
    edges = [forest.edges_between(c) for c in x.T]
    want = np.mean([plain_tree(x, y, forest.times_drawn(marks, 5, t), edges, plan, t) for t in range(3)], axis=0)
    got = [r["prediction"] for r in forest.random_forest("features", "y", plan).fit(df).transform(df).collect()]
    assert got == pytest.approx(list(want))


def test_equal_rows_lie_in_one_cell_and_are_drawn_each_for_itself(spark):
    x, y = np.repeat([[1.0, 2.0], [3.0, 4.0]], 3000, axis=0), np.arange(6000.0)
    df = frame(spark, x, y)
    kept = forest.blocks(df, "features", "y", 6000, 10.0, [[2.0], [3.0]], 1).collect()
    # Passes go over the distinct bins of a block, not over its rows, and all rows are there.
    assert sum(len(r["cells"]) // 2 for r in kept) <= 2 + len(kept)
    assert sorted(np.concatenate([np.frombuffer(r["label"]) for r in kept])) == [t - 10 for t in range(6000)]
    marks = np.concatenate([np.frombuffer(r["mark"], np.int64) for r in kept])
    assert len(set(marks.tolist())) == 6000
    times = np.array([forest.times_drawn(marks, 1, t) for t in range(40)])
    assert times.mean() == pytest.approx(1, abs=0.01) and times.var() == pytest.approx(1, abs=0.02)
    assert np.abs(np.corrcoef(times) - np.eye(40)).max() < 0.07


def test_edges_and_error_are_those_of_sparks_forest(spark):
    x, y = data(3000)
    fit, val = frame(spark, x[:2000], y[:2000]), frame(spark, x[2000:], y[2000:])
    spark_model = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=20, maxDepth=5, seed=1, featureSubsetStrategy="0.8").fit(fit)
    own = train.regressor("random_forest", {"n_estimators": 20, "max_depth": 5, "max_features": 0.8}, "features", "y", (2000, 1.0), 1).fit(fit)
    assert isinstance(own, boost.BoostedTreesModel) and own.n_trees == 20
    edges = forest.sampled_edges(fit, "features", 2000, 1)
    cuts = {f: set() for f in range(3)}
    for line in spark_model.toDebugString.splitlines():
        if "<=" in line:
            feature, cut = line.strip().removeprefix("If (feature ").rstrip(")").split(" <= ")
            cuts[int(feature)].add(float(cut))
    for f in range(3):
        assert cuts[f] and all(np.isclose(edges[f], c, rtol=1e-12).any() for c in cuts[f])
    error = RegressionEvaluator(labelCol="y")
    assert error.evaluate(own.transform(val)) == pytest.approx(error.evaluate(spark_model.transform(val)), rel=0.05)


def test_labels_of_a_forest_are_known(spark):
    df = frame(spark, [[1.0], [2.0]], [1.0, float("nan")])
    with pytest.raises(ValueError, match="null or NaN"):
        forest.random_forest("features", "y", forest.ForestPlan(trees=2)).fit(df)


@pytest.mark.parametrize("cells", [forest.CELLS, 3 * 2 * forest.BINS])
def test_levels_of_many_points_equal_trees_grown_in_one_task(spark, monkeypatch, cells):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    monkeypatch.setattr(forest, "LEAST_ROWS", 50)
    monkeypatch.setattr(forest, "CELLS", cells)
    x, y = data(300)
    df = frame(spark, x, y)
    for columns, smalls in ((0.6, (0,)), (1.0, (0, 40))):  # nodes below one that is grown out have other draws of features
        plan = forest.ForestPlan(trees=3, max_depth=4, columns=columns, min_rows=3.0, seed=5)
        want = [r["prediction"] for r in forest.random_forest("features", "y", plan).fit(df).transform(df).collect()]
        for small in smalls:
            with monkeypatch.context() as m:
                m.setattr(boost, "SMALL_ROWS", small)
                got = [r["prediction"] for r in forest.random_forest("features", "y", plan).fit(df).transform(df).collect()]
            assert got == pytest.approx(want)


@pytest.mark.parametrize("small", [10**9, 40])
def test_deep_forests_are_tables(spark, monkeypatch, small):
    monkeypatch.setattr(boost, "SMALL_ROWS", small)
    monkeypatch.setattr(boost, "SENT_BYTES", 12 * 300 * 2)  # some trees a job
    monkeypatch.setattr(forest, "SCORED_CELLS", 100)
    x, y = data(300)
    df = frame(spark, x, y)
    plan = forest.ForestPlan(trees=5, max_depth=9, min_rows=2.0, seed=5)
    kept = forest.random_forest("features", "y", plan).fit(df)
    monkeypatch.setattr(forest, "KEPT_NODES", 0)
    written = forest.random_forest("features", "y", plan).fit(df)
    assert isinstance(kept, boost.BoostedTreesModel) and isinstance(written, forest.WrittenForest) and written.n_trees == 5
    path = scratch_path(spark, "written")
    train.save_pipeline(written, path)
    twice = df.union(df)
    want = sorted((r["y"], r["prediction"]) for r in kept.transform(twice).collect())
    for model in (written, forest.WrittenForest.load(path)):
        said = model.transform(twice)
        assert said.columns == [*df.columns, "prediction"] and np.allclose(sorted((r["y"], r["prediction"]) for r in said.collect()), want)
    assert written.transform(df.limit(0)).count() == 0
    assert train.mean_forest([(written, 5), (kept, 5)]).transform(df).count() == 300
