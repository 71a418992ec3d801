import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.operators import profile, ranks
from tallyforge.operators.drift import ecdf_distances
from tallyforge.operators.quality import roc_auc


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(5)
    rows = [(i, 0.0 if rng.random() < 0.35 else round(rng.gauss(0, 100), 2), float(rng.randint(0, 6)),
             None if rng.random() < 0.1 else rng.random()) for i in range(4000)]
    return spark.createDataFrame(rows, "id long, hot double, steps double, gaps double").repartition(5).cache()


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("slice_rows,accuracy", [(50, 20), (5, 10), (100_000, 2000)])
def test_bracketed_quantiles_are_exact(sample, slice_rows, accuracy):
    cols = ["hot", "steps", "gaps"]
    got = ranks.exact_quantiles(sample, cols, PROBS, slice_rows=slice_rows, accuracy=accuracy)
    pdf = sample.toPandas()
    for c in cols:
        for p in PROBS:
            assert got[c][p] == pytest.approx(pdf[c].quantile(p), abs=1e-9)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert ranks.exact_quantiles(df, ["x"], [0.5]) == {"x": {0.5: None}}


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_running_counts_do_not_depend_on_the_ranges(sample, ranges):
    counts = ranks.value_counts(sample, ["hot", "gaps"])
    key = lambda df: sorted(tuple(r) for r in df.collect())
    by, order = Window.partitionBy("column"), Window.partitionBy("column").orderBy("value")
    plain = counts.select("*", (F.sum("n").over(order) - F.col("n")).alias("n_before"), F.sum("n").over(by).alias("n_total"),
                          F.lead("value").over(order).alias("next_value"))
    assert key(ranks.running_counts(counts, ["column"], "value", ["n"], ranges=ranges)) == key(plain)


def test_rows_are_numbered_in_the_order_asked_for(sample):
    order = [F.col("hot").desc_nulls_first(), F.col("id").asc()]
    got = ranks.numbered(sample, order, "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(4000))
    assert [r["id"] for r in got] == [r["id"] for r in sample.orderBy(*order).collect()]


def test_running_counts_use_no_window_over_a_whole_column(sample):
    counts = ranks.value_counts(sample, ["hot"])
    plan = ranks.running_counts(counts, ["column"], "value", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window") and "value#" in line and "ASC" in line]
    assert windows and all("_w" in w or "lower" in w for w in windows)


def test_drift_of_a_table_against_itself_is_zero(sample):
    for r in ecdf_distances(sample, sample, ["hot", "steps", "gaps"]).collect():
        assert (r["wasserstein"], r["ks"]) == (0.0, 0.0)


def test_spearman_equals_pandas_with_nulls_and_ties(sample):
    got = {(r[0], r[1]): r[2] for r in profile.spearman_matrix(sample, ["hot", "steps", "gaps"]).collect()}
    pdf = sample.toPandas()
    for (a, b), r in got.items():
        both = pdf[[a, b]].dropna()
        assert r == round(both[a].rank().corr(both[b].rank()), 4)


def test_numeric_profile_equals_pandas(sample):
    pdf = sample.toPandas()
    for r in profile.numeric_profile(sample, ["hot", "gaps"]).collect():
        x = pdf[r["column"]]
        want = {"missing_null_ratio": x.isnull().mean(), "zero_ratio": (x == 0).mean(), "mean": x.mean(), "std_dev": x.std(),
                "median_50": x.median(), "iqr_25_75": x.quantile(.75) - x.quantile(.25), "skewness": x.skew(), "kurtosis": x.kurt()}
        for k, v in want.items():
            assert r[k] == pytest.approx(v, abs=1e-9), k


def test_moments_of_tiny_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, flat double")
    a, flat = (r for r in profile.numeric_profile(df).collect())
    assert a["skewness"] is None and a["kurtosis"] is None and flat["std_dev"] == 0.0


def test_kendall_equals_all_pairs(spark):
    rng = random.Random(3)
    pts = [(float(rng.randint(0, 12)), float(rng.randint(0, 9))) for _ in range(150)]
    df = spark.createDataFrame(pts, "x double, y double")
    con = dis = tx = ty = 0
    for i in range(len(pts)):
        for j in range(i):
            dx, dy = pts[i][0] - pts[j][0], pts[i][1] - pts[j][1]
            con += dx * dy > 0
            dis += dx * dy < 0
            tx += dx == 0
            ty += dy == 0
    n = len(pts) * (len(pts) - 1) / 2
    want = (con - dis) / ((n - tx) * (n - ty)) ** 0.5
    assert profile.kendall_tau(df, "x", "y", 9).first()["correlation"] == pytest.approx(want, abs=1e-8)


def test_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    t, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    pos, neg = s[t == 1], s[t == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(t, s)], "t int, s double")
    assert roc_auc(df, "t", "s").first()[0] == pytest.approx(want, abs=1e-12)
