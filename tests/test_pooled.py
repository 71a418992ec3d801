"""Boosted trees over pooled rows against Spark's booster over the rows themselves."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from tallyforge.operators import pooled, train
from tallyforge.session import scratch_path


def data(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, (n, 3)))
    x[:, 2] = rng.integers(0, 2, n)
    return x, np.sin(x[:, 0]) * 5 + x[:, 1] * x[:, 2] + rng.normal(size=n)


def frame(spark, x, y, held):
    rows = [(Vectors.dense(r), float(t), bool(h)) for r, t, h in zip(x, y, held)]
    return spark.createDataFrame(rows, ["features", "y", "held"]).cache()


def test_pooled_rows_give_sparks_trees_and_stop(spark):
    x, y = data(3000)
    df = frame(spark, x, y, np.arange(3000) % 4 == 0)
    params = {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.3}
    own = train.regressor("gradient_boosting", params, "features", "y", (2250, 1.0), validation="held").fit(df)
    plain = GBTRegressor(featuresCol="features", labelCol="y", validationIndicatorCol="held", seed=42, maxIter=30, stepSize=0.3, maxDepth=3).fit(df)
    assert own.stages[1].getNumTrees == plain.getNumTrees < 30
    want = [r["prediction"] for r in plain.transform(df).collect()]
    assert [r["prediction"] for r in own.transform(df).collect()] == pytest.approx(want, rel=1e-9)
    path = scratch_path(spark, "pooled")
    train.save_pipeline(own, path)
    again = train.load_pipeline(path).transform(df)
    assert [r["prediction"] for r in again.collect()] == pytest.approx(want, rel=1e-9) and again.columns == [*df.columns, "prediction"]


def test_points_are_bounded_by_the_bins_and_keep_all_sums(spark):
    x, y = data(2000)
    df = frame(spark, np.repeat(x, 3, axis=0), np.concatenate([[t, t + 1, t + 5] for t in y]), np.repeat(np.arange(2000) % 5 == 0, 3))
    edges = [[3.0, 7.0], [5.0], [0.5]]
    points = pooled.pooled_points(df, "features", "y", "held", edges).collect()
    rows = df.collect()
    # Rounds go over two points for each of the twelve distinct bins of either part, however many rows there are.
    assert len(points) <= 2 * 2 * 12
    for held in (False, True):
        some = [p for p in points if p["held"] == held]
        labels = np.array([r["y"] for r in rows if r["held"] == held])
        for power in (0, 1, 2):
            assert sum(p["weight"] * p["label"] ** power for p in some) == pytest.approx((labels**power).sum())


def test_rows_drawn_for_each_tree_are_not_pooled(spark):
    est = train.regressor("gradient_boosting", {"n_estimators": 3, "subsample": 0.5}, "features", "y", (10, 1.0))
    assert isinstance(est, GBTRegressor) and est.getSubsamplingRate() == 0.5
