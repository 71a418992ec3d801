import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.functions import pvalues
from tallyforge.operators import contract, drift, quality, recsys, text, text_drift
from tallyforge.operators.drift import ColumnRoles, DriftOptions
from tallyforge.session import scratch_path
from tallyforge.sources import conform, readers, writers
from tallyforge.streaming import jobs


def test_tails():
    assert pvalues.normal_tail(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi2_tail(5.991465, 2) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi2_tail(0.5, 4) == pytest.approx(0.973501, abs=1e-5)
    assert pvalues.t_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.t_tail(0.5, 3) == pytest.approx(0.651448, abs=1e-4)
    assert pvalues.kolmogorov_tail(1.358099) == pytest.approx(0.05, abs=1e-5)


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(2)
    def make(n, shift):
        return spark.createDataFrame([(float(v), "ab"[int(u < 0.3)]) for v, u in zip(rng.normal(shift, 1, n), rng.random(n))],
                                     "x double, g string")
    return make(500, 0.0), make(200, 1.0)


def test_shifted_numbers_drift_by_every_method(sides):
    for method in drift.NUMERIC_METHODS:
        row = drift.value_drift(*sides, ColumnRoles(numerical=["x"]), DriftOptions(num_method=method)).first()
        assert row["drifted"], method
    for method in drift.CATEGORY_METHODS:
        row = drift.value_drift(sides[0], sides[0], ColumnRoles(categorical=["g"]), DriftOptions(cat_method=method)).first()
        assert not row["drifted"], method


def test_wasserstein_equals_numpy(sides):
    a, b = (np.array([r[0] for r in s.select("x").collect()]) for s in sides)
    grid = np.sort(np.concatenate([a, b]))
    cdf = lambda v: np.searchsorted(np.sort(v), grid[:-1], side="right") / len(v)
    want = np.sum(np.abs(cdf(a) - cdf(b)) * np.diff(grid)) / a.std()
    assert drift.ecdf_distances(*sides, ["x"]).first()["wasserstein"] == pytest.approx(want, abs=1e-9)


def test_options_must_name_known_columns(sides):
    with pytest.raises(ValueError, match="unknown columns"):
        drift.value_drift(*sides, ColumnRoles(numerical=["x"]), DriftOptions(per_column_method={"X": "ks"}))
    with pytest.raises(ValueError, match="does not apply"):
        drift.value_drift(*sides, ColumnRoles(categorical=["g"]), DriftOptions(per_column_method={"g": "ks"}))
    scores = drift.value_drift(*sides, ColumnRoles(numerical=["x"], categorical=["g"]), DriftOptions(selected=["x"]))
    assert drift.dataset_drift(scores).first()["dataset_drift"]


def test_random_features_come_near_the_exact_discrepancy(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(150, 8)), rng.normal(0.7, 1, size=(120, 8))
    kernel = lambda p, q: np.exp(-((p[:, None] - q[None]) ** 2).sum(-1) / 8).mean()
    want = kernel(a, a) + kernel(b, b) - 2 * kernel(a, b)
    frames = [spark.createDataFrame([(r.tolist(),) for r in v], "e array<double>").repartition(3) for v in (a, b)]
    got = drift.embedding_mmd(*frames, "e", features=4096).first()
    assert got["mmd"] == pytest.approx(want, rel=0.15) and got["p_value"] < 0.02 and got["embedding_drift"]


def test_discrepancy_of_the_given_vectors_and_its_chance(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    sides = [vectors.where(F.col("label") < 5), vectors.where(F.col("label") >= 5)]
    a, b = (np.asarray([r[0] for r in side.select("embedding").collect()], dtype=float) for side in sides)
    width = a.shape[1]

    def kernel(p, q):
        return np.exp(-((p ** 2).sum(1)[:, None] + (q ** 2).sum(1)[None] - 2 * p @ q.T) / width).mean()
    got = drift.embedding_mmd(*sides, "embedding", features=8192).first()
    assert got["mmd"] == pytest.approx(kernel(a, a) + kernel(b, b) - 2 * kernel(a, b), rel=0.1, abs=1e-4)


def test_equal_sides_are_rarely_called_different(spark):
    rng = np.random.default_rng(5)
    values = []
    for _ in range(12):
        frames = [spark.createDataFrame([(r.tolist(),) for r in rng.normal(size=(n, 4))], "e array<double>") for n in (90, 240)]
        values.append(drift.embedding_mmd(*frames, "e", features=128).first()["p_value"])
    assert min(values) < 0.7 and max(values) > 0.3 and sum(v < 0.05 for v in values) <= 3


def test_text_content_tells_topics_apart_and_halves_not(spark):
    rng = np.random.default_rng(2)

    def texts(vocabulary, n, start):
        return spark.createDataFrame([(start + i, " ".join(rng.choice(vocabulary, 12)), 1.0) for i in range(n)], "id long, text string, x double")
    old, new = [f"old{i}" for i in range(40)], [f"old{i}" for i in range(30)] + [f"new{i}" for i in range(10)]
    ref, same, other = texts(old, 150, 0), texts(old, 150, 1000), texts(new, 150, 2000)
    near, far = text_drift.content_drift(ref, same, ["text"], "id").first(), text_drift.content_drift(ref, other, ["text"], "id").first()
    assert abs(near["roc_auc"] - 0.5) < 0.12 and 0.5 < near["threshold"] < 0.65
    assert far["roc_auc"] > 0.85 and far["drifted"]
    # the area equals the plain one of each fold
    scored = text_drift.domain_scores(ref, other, "text", "id").collect()
    areas = []
    for fold in (0, 1):
        pos, neg = ([r["score"] for r in scored if r["fold"] == fold and r["label"] == y] for y in (1.0, 0.0))
        areas.append(np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]))
    assert far["roc_auc"] == pytest.approx(np.mean(areas), abs=1e-9)
    roles = ColumnRoles(numerical=("x",), text=("text",), id="id")
    both = drift.value_drift(ref, other, roles, DriftOptions.from_config({"text": {"method": "domain", "threshold": 0.8}})).collect()
    assert {(r["column"], r["kind"], r["drifted"]) for r in both} == {("x", "num", False), ("text", "text", True)}
    assert [r["column"] for r in drift.value_drift(ref, other, roles).collect()] == ["x"]
    with pytest.raises(ValueError, match="does not apply"):
        drift.value_drift(ref, other, roles, DriftOptions(text_method="ks"))
    empty = text_drift.content_drift(ref, other.limit(0), ["text"], "id").first()
    assert empty["roc_auc"] is None and empty["drifted"] is False


def test_personalization_equals_the_pair_form(spark):
    lists = {1: [1, 2, 3], 2: [2, 3, 4], 3: [7, 8, 9]}
    recs = spark.createDataFrame([(u, i, r + 1, 1.0) for u, items in lists.items() for r, i in enumerate(items)],
                                 "user int, item int, rank int, score double")
    pairs = [(a, b) for a in lists for b in lists if a < b]
    want = 1 - sum(len(set(lists[a]) & set(lists[b])) / 3 for a, b in pairs) / len(pairs)
    assert recsys.personalization(recs, 3).first()[0] == pytest.approx(want)
    assert [tuple(r) for r in recsys.recommendation_cases(recs, 2, [3]).collect()] == [(3, "7,8")]


def test_ranking_of_a_hand_made_case(spark):
    recs = spark.createDataFrame([(1, i, r, 1.0) for r, i in enumerate((5, 6, 7), 1)], "user int, item int, rank int, score double")
    relevant = spark.createDataFrame([(1, 6), (1, 9), (2, 1)], "user int, item int")
    r = recsys.ranking_quality(recs, relevant, 3).first()
    idcg = 1 + 1 / math.log2(3)
    assert (r["precision_at_k"], r["recall_at_k"], r["mrr_at_k"], r["hit_rate_at_k"]) == pytest.approx((1 / 6, 0.25, 0.25, 0.5))
    assert (r["map_at_k"], r["ndcg_at_k"]) == pytest.approx((0.125, 1 / math.log2(3) / idcg / 2))


@pytest.mark.parametrize("content,want", [('{"a": 1}', True), ("12 words", False), ("1],[2", False), ("1,2", False), ("", False),
                                          ('"x"', True), ("null", True), ("{", False), (None, None)])
def test_json_means_the_whole_text(spark, content, want):
    df = spark.createDataFrame([(content,)], "t string")
    assert df.select(text.is_json(F.col("t"))).first()[0] is want


def test_missing_splits_are_named_together(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        readers.read_splits(spark, str(tmp_path), "a int")
    assert all(n in str(error.value) for n in ("train.csv", "val.csv", "test.csv"))
    with pytest.raises(ValueError):
        readers.read_dataset(spark, "x", "xml")
    with pytest.raises(ValueError):
        readers.scan_table(spark, {})


def test_bulk_load_is_all_or_nothing(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nx,3\n")
    (tmp_path / "good.csv").write_text("a;b\n1;2\n3;4\n")
    done = {r.table: r for r in writers.bulk_load_all(spark, {
        "bad": {"source_path": str(tmp_path / "bad.csv"), "target": str(tmp_path / "bad"), "schema": "a int, b int"},
        "good": {"source_path": str(tmp_path / "good.csv"), "target": str(tmp_path / "good"), "schema": "a int, b int",
                 "options": {"delimiter": ";"}}})}
    assert done[str(tmp_path / "bad")].status == "failed" and done[str(tmp_path / "good")].rows == 2
    assert not readers.path_exists(spark, str(tmp_path / "bad/_SUCCESS"))


def test_a_failed_load_leaves_the_target_alone(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.createDataFrame([(i, i) for i in range(5)], "a int, b int").write.parquet(target)
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nx,3\n")
    (tmp_path / "good.csv").write_text("a,b\n7,8\n")
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception):  # noqa: B017
            writers.bulk_load(spark, str(tmp_path / "bad.csv"), target, "a int, b int", mode=mode)
        assert spark.read.parquet(target).count() == 5
    assert writers.bulk_load(spark, str(tmp_path / "good.csv"), target, "a int, b int").rows == 1
    assert spark.read.parquet(target).count() == 6
    writers.bulk_load(spark, str(tmp_path / "good.csv"), target, "a int, b int", mode="overwrite")
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(7, 8)]
    assert sorted(p.name for p in tmp_path.iterdir() if p.is_dir()) == ["t"]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    for n in ("train", "val", "test"):
        (tmp_path / f"{n}.csv").write_text("b,c,a\n1,x,2\n")
    (tmp_path / "more.csv").write_text("b,a\n3,4\n")
    assert {tuple(df.first()) for df in readers.read_splits(spark, str(tmp_path), "a int, b int").values()} == {(2, 1)}
    assert readers.read_dataset(spark, str(tmp_path / "train.csv"), "csv", schema="a int, b int").first() == (2, 1)
    writers.append_csv(spark, str(tmp_path / "more.csv"), str(tmp_path / "t"), "a int, b int")
    assert spark.read.parquet(str(tmp_path / "t")).first() == (4, 3)
    with pytest.raises(ValueError, match="no column z"):
        readers.read_csv(spark, str(tmp_path / "more.csv"), "a int, z int")


def test_streams_share_a_table(spark, tmp_path):
    target = str(tmp_path / "all")
    for name, rows in (("one", 5), ("two", 3)):
        spark.range(rows).write.parquet(str(tmp_path / name))
        source = jobs.read_files(spark, str(tmp_path / name), spark.range(1).schema)
        jobs.stream_load(source, target, ["id"], str(tmp_path / f"progress-{name}"))
    assert spark.read.parquet(target).columns == ["id"] and spark.read.parquet(target).count() == 8
    again = spark.range(3)
    jobs.put_batch(again, target, str(tmp_path / "progress-two"), 0)
    assert spark.read.parquet(target).count() == 8


def test_stability_of_a_table_against_itself(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None)], "kind string, x double")
    got = {(r["metric"], r["column"]): r["value"] for r in quality.stability_metrics(df, df, ["kind"]).collect()}
    assert got[("out_of_list", "kind")] == 0 and got[("out_of_range", "x")] == 0
    fresh = quality.stability_metrics(df.where("kind = 'a'"), df, ["kind"])
    assert {r["value"] for r in fresh.where("metric = 'out_of_list'").collect()} == {2.0}


def test_bins_leave_nan_out(spark):
    df = spark.createDataFrame([(0.5,), (float("nan"),), (None,), (9.0,)], "x double")
    assert [r["x"] for r in drift.binned(df, {"x": [1.0, 2.0]}).collect()] == ["0", None, None, "2"]


def test_ddl_from_declared_columns():
    cols = conform.declared({"id": {"type": "integer", "nullable": False}, "day": {"type": "date"}, "kind": {"type": "categorical"}})
    assert conform.ddl("Bảng Một", cols) == "CREATE TABLE IF NOT EXISTS bang_mot (`id` bigint NOT NULL, `day` date, `kind` string) USING parquet"


def test_stream_restart_loads_nothing_twice(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(50).withColumn("v", F.col("id") * 2).write.parquet(source)
    for _ in range(2):
        jobs.stream_load(jobs.read_files(spark, source, spark.read.parquet(source).schema), target, ["v", "id"], progress)
    assert spark.read.parquet(target).select("v", "id").count() == 50
    spark.range(50, 60).withColumn("v", F.col("id")).write.mode("append").parquet(source)
    jobs.stream_load(jobs.read_files(spark, source, spark.read.parquet(source).schema), target, ["v", "id"], progress)
    assert spark.read.parquet(target).count() == 60


def test_a_batch_shows_in_both_tables_or_in_neither(spark, tmp_path, monkeypatch):
    source, valid, aside, progress = (str(tmp_path / n) for n in ("in", "valid", "aside", "progress"))
    spark.range(20).withColumn("v", F.col("id").cast("double")).repartition(1).write.parquet(source)
    rule = contract.Contract("c", (contract.Field("v", "double", (contract.Check("in_range", {"min_val": 5, "max_val": 450}),)),), ("id",))
    records = jobs.records_of(valid)

    def run():
        jobs.stream_validate(jobs.read_files(spark, source, spark.read.parquet(source).schema), rule, None, valid, aside, progress)

    def seen():
        return [jobs.read_recorded(spark, t, records).count() for t in (valid, aside)]
    put = jobs.put_batch

    def dies_between(batch, target, *rest):
        if target == aside:
            raise RuntimeError("lost")
        put(batch, target, *rest)
    run()
    assert seen() == [15, 5]
    spark.range(2, 9).withColumn("v", F.col("id").cast("double")).repartition(1).write.mode("append").parquet(source)
    monkeypatch.setattr(jobs, "put_batch", dies_between)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(valid).count() == 19 and seen() == [15, 5]  # half a batch lies there, nobody reads it
    monkeypatch.setattr(jobs, "put_batch", put)
    run()
    run()
    assert seen() == [19, 8] == [spark.read.parquet(t).count() for t in (valid, aside)]
    assert spark.read.parquet(records).count() == 2
    monkeypatch.setattr(jobs, "put_batch", dies_between)
    assert jobs.is_recorded(spark, records, progress, 1) and not jobs.is_recorded(spark, records, progress, 2)
    assert jobs.read_recorded(spark, valid, str(tmp_path / "none")).count() == 0


def test_suite_counts_absent_metrics_as_failed(spark):
    metrics = spark.createDataFrame([("a", "", 1.0), ("b", "x", 5.0)], "metric string, column string, value double")
    tests = [quality.MetricTest("a", "<=", 1), quality.MetricTest("b", "<", 5, "x", "warn"), quality.MetricTest("c", ">", 0)]
    s = quality.summarize_tests(quality.run_tests(metrics, tests)).first()
    assert (s["success_tests"], s["warning_tests"], s["failed_tests"], s["all_passed"]) == (1, 1, 1, False)


def test_history_keeps_the_latest(spark):
    path = scratch_path(spark, "hist")
    for day, v in (("2024-01-01", 1.0), ("2024-01-03", 3.0), ("2024-01-02", 2.0)):
        quality.append_history(spark.createDataFrame([("m", "", v)], "metric string, column string, value double"), day, path)
    assert quality.latest_metrics(spark.read.parquet(path)).first()["value"] == 3.0
