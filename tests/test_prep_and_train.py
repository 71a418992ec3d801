import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyforge.operators import knn, prep, quality, train
from tallyforge.operators.knn import knn_impute
from tallyforge.operators.prep import TabularPreprocessor
from tallyforge.operators.quality import evaluation_metrics
from tallyforge.operators.split import exact_split, hashed_split, split_sizes
from tallyforge.plans import train_queries
from tallyforge.session import checkpoint_root, scratch_path


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 15000])
def test_split_sizes_are_exact_and_disjoint(spark, n):
    df = exact_split(spark.range(n), "id")
    got = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    want = {k: v for k, v in split_sizes(n, {"train": .7, "val": .15, "test": .15}).items() if v}
    assert got == want
    if n == 15000:
        assert got == {"train": 10500, "val": 2250, "test": 2250}


def test_split_ignores_layout_and_follows_the_seed(spark):
    pick = lambda df: {r[0] for r in df.where("split = 'val'").select("id").collect()}
    a, b = exact_split(spark.range(500).repartition(7), "id"), exact_split(spark.range(500).coalesce(1), "id")
    assert pick(a) == pick(b) != pick(exact_split(spark.range(500), "id", seed=43))
    with pytest.raises(ValueError):
        exact_split(spark.range(5), "id", {"train": 0.9, "val": 0.3})
    shares = hashed_split(spark.range(4000), "id").groupBy("split").count().collect()
    assert abs({r[0]: r[1] for r in shares}["train"] / 4000 - 0.7) < 0.05


def brute(rows, donors, features, k, weights):
    out = []
    for r in rows:
        filled = list(r)
        for f in range(1, features + 1):
            if r[f] is not None:
                continue
            near = []
            for d in donors:
                shared = [j for j in range(1, features + 1) if r[j] is not None and d[j] is not None]
                if d[f] is None or not shared:
                    continue
                near.append((features / len(shared) * sum((r[j] - d[j]) ** 2 for j in shared), str(d[0]), d[f]))
            near = sorted(near)[:k]
            if not near:
                known = [d[f] for d in donors if d[f] is not None]
                filled[f] = sum(known) / len(known)
            elif weights == "uniform":
                filled[f] = sum(n[2] for n in near) / len(near)
            elif near[0][0] == 0:
                same = [n[2] for n in near if n[0] == 0]
                filled[f] = sum(same) / len(same)
            else:
                w = [1 / math.sqrt(n[0]) for n in near]
                filled[f] = sum(x * n[2] for x, n in zip(w, near)) / sum(w)
        out.append(tuple(filled))
    return out


@pytest.mark.parametrize("weights,box_rows", [("uniform", 8), ("distance", 8), ("uniform", 20_000)])
def test_knn_equals_brute_force(spark, weights, box_rows):
    rng = np.random.default_rng(11)
    data = []
    for i in range(240):
        x = [float(v) for v in np.round(rng.normal(size=3) * [1, 10, 100], 1)]
        if i % 3 == 0:
            x = [1.0, 2.0, 3.0]  # a third of the rows are copies
        holes = rng.random(3) < 0.2
        data.append((i, *[None if h else v for h, v in zip(holes, x)]))
    data.append((999, None, None, None))
    df = spark.createDataFrame(data, "id long, a double, b double, c double")
    got = {r["id"]: tuple(r) for r in knn_impute(df, df, ["a", "b", "c"], "id", 5, weights, box_rows).collect()}
    assert len(got) == len(data)
    for want in brute(data, data, 3, 5, weights):
        assert got[want[0]] == pytest.approx(want, abs=1e-9)


def test_scalers(spark):
    df = spark.createDataFrame([(float(i), 4.0) for i in range(1, 6)], "x double, flat double")
    for kind, want in (("robust", [-1, -.5, 0, .5, 1]), ("standard", [(i - 3) / math.sqrt(2) for i in range(1, 6)]),
                       ("minmax", [0, .25, .5, .75, 1]), ("none", [1, 2, 3, 4, 5])):
        got = prep.scale(df, prep.fit_scaler(df, ["x", "flat"], kind)).orderBy("x").collect()
        assert [r["x"] for r in got] == pytest.approx(want)
        assert {r["flat"] for r in got} == ({4.0} if kind == "none" else {0.0})
    for bad in (lambda: prep.fit_scaler(df, ["x"], "cubic"), lambda: prep.fit_imputer(df, ["x"], "guess")):
        with pytest.raises(ValueError):
            bad()


CONF = {"numerical": {"scaler": {"type": "none"}}, "categorical": {"encoder": {"type": "onehot", "handle_unknown": "ignore"}}}


def mini(spark):
    fit = spark.createDataFrame([(float(a), "FM"[a % 2], 3.0 * a + 2) for a in range(20)], "Age double, Gender string, y double")
    val = spark.createDataFrame([(20.0, "X", 62.0), (21.0, "F", 65.0), (22.0, "M", 68.0)], "Age double, Gender string, y double")
    return fit, val


def test_unseen_categories_become_zeros_and_the_target_is_last(spark):
    fit, val = mini(spark)
    model = TabularPreprocessor(numerical=["Age"], categorical=["Gender"], config=CONF).fit(fit)
    flat = model.flat(val, target="y")
    assert flat.columns == ["numerical__Age", "categorical__Gender_F", "categorical__Gender_M", "y"]
    assert [tuple(r) for r in flat.orderBy("y").collect()] == [(20, 0, 0, 62), (21, 1, 0, 65), (22, 0, 1, 68)]
    strict = TabularPreprocessor(numerical=["Age"], categorical=["Gender"], config={}).fit(fit)
    with pytest.raises(Exception, match="unknown category"):
        strict.flat(val).collect()


def test_statistics_come_from_the_training_rows(spark):
    fit = spark.createDataFrame([(1.0,), (2.0,)], "f double")
    model = TabularPreprocessor(numerical=["f"], config={"numerical": {"scaler": {"type": "minmax"}}}).fit(fit)
    other = spark.createDataFrame([(100.0,), (None,)], "f double")
    assert sorted(r[0] for r in model.flat(other).collect()) == [0.5, 99.0]


def test_knn_preprocessor_survives_saving(spark):
    fit = spark.createDataFrame([(i, float(i), float(i * 2)) for i in range(10)], "id long, a double, b double")
    conf = {"numerical": {"imputer": {"type": "knn", "n_neighbors": 1, "donor_key": "id"}, "scaler": {"type": "none"}}}
    model = TabularPreprocessor(numerical=["a", "b"], config=conf).fit(fit)
    path = scratch_path(spark, "prep")
    model.save(path)
    back = type(model).load(path)
    query = spark.createDataFrame([(100, 3.2, None)], "id long, a double, b double")
    assert back.flat(query).first()["numerical__b"] == 6.0


def test_wide_categories_by_table(spark):
    df = spark.createDataFrame([(i, f"v{i:05d}") for i in range(12_000)] + [(12_000, None)], "id int, c string")
    names = prep.category_table(df.where("id % 2 = 0"), "c")
    got = prep.ordinal_by_table(df, "c", names, "use_encoded_value", -1).collect()
    assert {r["id"]: r["c"] for r in got} == {i: (i / 2 if i % 2 == 0 and i < 12_000 else -1.0) for i in range(12_001)}
    hot = {r["id"]: r["hot"] for r in prep.onehot_by_table(df.where("id < 6"), "c", names, "hot", "ignore").collect()}
    assert all(v.size == 6_000 for v in hot.values()) and list(hot[4].indices) == [2] and list(hot[5].indices) == []
    with pytest.raises(Exception, match="unknown category in c"):
        prep.ordinal_by_table(df, "c", names).collect()
    with pytest.raises(Exception, match="unknown category in c"):
        prep.onehot_by_table(df, "c", names, "hot").collect()


@pytest.mark.parametrize("encoder", [{"type": "onehot", "handle_unknown": "ignore"}, {"type": "onehot", "handle_unknown": "ignore", "drop": "first"},
                                     {"type": "ordinal", "handle_unknown": "use_encoded_value", "unknown_value": -2}])
def test_wide_categories_equal_narrow_ones(spark, encoder):
    """The joined table gives the vectors that literal columns give, in the fitted and in the reloaded model."""
    fit = spark.createDataFrame([(float(i), f"v{i % 7}", "ab"[i % 2]) for i in range(30)], "x double, c string, d string")
    new = spark.createDataFrame([(1.0, "v3", "a"), (2.0, "new", "b"), (3.0, None, "z"), (4.0, "v0", None)], "x double, c string, d string")
    vectors = []
    for most in (100, 3):
        config = {"numerical": {"scaler": {"type": "none"}}, "categorical": {"encoder": {**encoder, "max_columns": most}}}
        model = TabularPreprocessor(numerical=["x"], categorical=["c", "d"], config=config).fit(fit)
        assert set(model.tables) == ({"c"} if most == 3 else set())
        path = scratch_path(spark, "prep")
        model.save(path)
        for m in (model, type(model).load(path)):
            out = m.transform(new)
            assert out.columns == [*new.columns, "features"]
            vectors.append([r["features"].toArray().tolist() for r in out.orderBy("x").collect()])
    assert all(v == vectors[0] for v in vectors)
    strict = {"categorical": {"encoder": {"type": "onehot", "max_columns": 3}}}
    with pytest.raises(Exception, match="unknown category in c"):
        TabularPreprocessor(categorical=["c"], config=strict).fit(fit).transform(new).collect()


def test_wide_pipeline_is_saved_and_scores(spark):
    fit = spark.createDataFrame([(float(i), f"v{i % 40}", 3.0 * i) for i in range(200)], "x double, c string, y double")
    config = {"numerical": {"scaler": {"type": "none"}}, "categorical": {"encoder": {"type": "onehot", "handle_unknown": "ignore", "max_columns": 10}}}
    model = train.fit_pipeline(fit, TabularPreprocessor(numerical=["x"], categorical=["c"], config=config), "ridge", {"alpha": 1e-3}, "y")
    path = scratch_path(spark, "p")
    train.save_pipeline(model, path)
    for r in train.score(train.load_pipeline(path), fit.drop("y").limit(5)).collect():
        assert r["prediction"] == pytest.approx(3 * r["x"], abs=0.1)


def test_gates(spark):
    df = spark.createDataFrame([("train", 1.0, 1.0), ("val", 1.0, None)], "split string, x double, y double")
    with pytest.raises(ValueError, match="missing required"):
        prep.require_columns(df, ["x", "z"], "y")
    report = prep.require_columns(df, ["x"], "y")
    with pytest.raises(ValueError, match="without rows"):
        prep.check_features(report)
    with pytest.raises(ValueError, match="target"):
        prep.check_features(report, ("train", "val"))
    path = scratch_path(spark, "m")
    prep.write_matrix(df, ["x"], "y", path)
    with pytest.raises(ValueError, match="non-finite"):
        prep.read_matrix(spark, path)


def line(spark, xs):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in xs], "x double, y double")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


def test_ridge_equals_the_closed_form(spark):
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(x), float(x)) for x in range(4)], "x double, y double"))
    model = train.regressor("ridge", {"alpha": 1.0}, "features", "y", train.label_stats(data, "y")).fit(data)
    assert model.coefficients[0] == pytest.approx(5 / 6, abs=1e-6)


def test_search_finds_the_line(spark):
    found = train.search(spark, line(spark, range(20)), line(spark, (20, 21, 22)), "y", n_trials=2, seed=7, model="ridge",
                         metrics=["r2_score", "root_mean_squared_log_error"])
    assert found.trials.count() == 4
    best = {r["metric"]: r for r in train.best_trials(found.trials).collect()}
    assert 0 < best["r2_score"]["best_score"] <= 1 and best["r2_score"]["completed"] == 2
    assert set(found.best) == {"r2_score", "root_mean_squared_log_error"}
    with pytest.raises(ValueError):
        train.search(spark, line(spark, [1]), line(spark, [1]), "y", metrics=["luck"])
    with pytest.raises(ValueError):
        train.sample_trials(1, 1, "oracle")


def test_own_metrics_and_failed_searches(spark):
    worst = lambda df, label, prediction: df.agg(F.max(F.abs(F.col(label) - F.col(prediction)))).first()[0]
    found = train.search(spark, line(spark, range(20)), line(spark, (20, 21, 22)), "y", n_trials=3, seed=7, model="ridge",
                         metrics=[], own_metrics={"largest_gap": ("minimize", worst)})
    scores = [r["score"] for r in found.trials.collect()]
    assert set(found.best) == {"largest_gap"} and len(scores) == 3
    assert worst(found.best["largest_gap"].transform(line(spark, (20, 21, 22))), "y", "prediction") == pytest.approx(min(scores))
    with pytest.raises(RuntimeError, match="none of 2 trials"):
        train.search(spark, line(spark, range(20)), line(spark, (20, 21)), "y", n_trials=2, model="ridge", metrics=[],
                     own_metrics={"none": ("maximize", lambda *_: float("nan"))})


def test_ridge_with_several_features_equals_the_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 10, 0.1]
    y = x @ [2, -1, 5] + 3 + rng.normal(size=200)
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double"))
    model = train.regressor("ridge", {"alpha": 3.0}, "features", "y", train.label_stats(data, "y")).fit(data)
    centred = x - x.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred + 3.0 * np.eye(3), centred.T @ (y - y.mean()))
    assert list(model.coefficients) == pytest.approx(list(want), abs=1e-6)


def test_samples_stay_in_the_space():
    for name, params in train.sample_trials(40, 3):
        for p, (kind, lo, hi, *_) in train.SPACE[name].items():
            assert lo <= params[p] <= hi


def test_pipeline_round_trip_takes_raw_rows(spark):
    fit, val = mini(spark)
    model = train.fit_pipeline(fit, TabularPreprocessor(numerical=["Age"], categorical=["Gender"], config=CONF), "ridge", {"alpha": 1e-4}, "y")
    path = scratch_path(spark, "p")
    train.save_pipeline(model, path)
    back = train.load_pipeline(path)
    for r in train.score(back, val.drop("y")).collect():
        assert r["prediction"] == pytest.approx(3 * r["Age"] + 2, abs=0.1)
    with pytest.raises(Exception):
        train.load_pipeline(path + "-gone")


def test_non_finite_predictions_are_an_error(spark):
    df = spark.createDataFrame([(1.0, float("nan"))], "y double, p double")
    with pytest.raises(Exception, match="non-finite"):
        evaluation_metrics(df, "y", "p").collect()


def test_multiclass_suite_holds_log_loss_against_the_class_shares(spark):
    rows = [(c, c, {c: 0.8}) for c in "aaabbc"]
    df = spark.createDataFrame(rows, "t string, p string, chances map<string,double>")
    found = quality.long_metrics(quality.multiclass_quality(df, "t", "p", "chances")).unionByName(
        quality.long_metrics(quality.dummy_multiclass(df, "t", log_loss=True), "dummy_"))
    got = {r["metric"]: r for r in quality.run_suite(found, "multiclass").collect()}
    entropy = -sum(n / 6 * math.log(n / 6) for n in (3, 2, 1))
    assert got["log_loss"]["bound"] == pytest.approx(entropy) and got["log_loss"]["status"] == "SUCCESS"
    poor = found.withColumn("value", F.expr("if(metric = 'log_loss', 1.2, value)"))
    assert {r["metric"]: r["status"] for r in quality.run_suite(poor, "multiclass").collect()}["log_loss"] == "FAIL"
    assert "log_loss" not in quality.dummy_multiclass(df, "t").columns


def test_registered_training_has_the_full_size(monkeypatch):
    seen = {}
    monkeypatch.setattr(train_queries, "_features", lambda spark, sf: spark_free)
    monkeypatch.setattr(train_queries.train, "search", lambda *a, **k: seen.update(k))
    monkeypatch.setattr(train_queries, "_fitted", lambda spark, sf, name, params: seen.update({name: params}))

    class spark_free:
        where = staticmethod(lambda *a: None)

    monkeypatch.setattr(train_queries.F, "col", lambda name: name)
    train_queries._search(None, "")
    assert seen["n_trials"] == 20 and seen["space"] is train.SPACE and set(train.SPACE) == set(train.MODELS)
    for fit in (train_queries.random_forest, train_queries.gradient_boosting, train_queries.second_order_boosting):
        fit(None, "")
    for name in ("random_forest", "gradient_boosting", "xgboost"):
        kind, low, high, _ = train.SPACE[name]["n_estimators"]
        assert low <= seen[name]["n_estimators"] <= high


def pool_of(spark, points):
    rows = [(0, [float(v) for v in p], 0.0, str(i)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "combo int, x array<double>, y double, donor string")


def test_boxes_of_a_capped_feature_are_divided(spark):
    checkpoint_root(spark)
    rng = np.random.default_rng(4)
    points = np.column_stack([np.minimum(rng.uniform(0, 1000, 4000), 300.0), rng.uniform(0, 10, 4000)])
    placed, levels = knn._boxes(pool_of(spark, points), 250)
    counts = [r["count"] for r in placed.groupBy("node").count().collect()]
    assert sum(counts) == 4000 and max(counts) <= 2 * len(points) / 16 and len(levels) <= 4
    leaves = {r["node"]: r for boxes in levels for r in boxes.where("cuts is null").collect()}
    for r in placed.collect():  # every donor lies inside its box, and boxes know their rows
        assert all(b["lo"] <= v <= b["hi"] for v, b in zip(r["x"], leaves[r["node"]]["bounds"]))
    assert sum(r["n"] for r in leaves.values()) == 4000
    placed, levels = knn._boxes(pool_of(spark, np.zeros((50, 2))), 20)
    assert len(levels) == 1 and placed.where("node = ''").count() == 50


def test_knn_with_short_boxes_and_donors_that_no_cut_divides(spark):
    """Nine tenths of the donors agree in every quantile; boxes smaller than k; both sides of a box dealt over tasks."""
    rng = np.random.default_rng(7)
    data = []
    for i in range(200):
        a, b = (5.0, 5.0) if i % 10 else (float(np.round(rng.normal() * 50, 2)), float(np.round(rng.normal() * 3, 2)))
        a, b = (a + (i % 7) * 1e-9, b) if i % 3 else (a, b)
        data.append((i, a, b, None if i % 4 == 0 else float(np.round(rng.normal(), 3))))
    df = spark.createDataFrame(data, "id long, a double, b double, c double")
    for box_rows, k in ((3, 7), (16, 4), (3, 1000)):
        got = {r["id"]: r["c"] for r in knn_impute(df, df, ["a", "b", "c"], "id", k, "uniform", box_rows).collect()}
        for want in brute(data, data, 3, k, "uniform"):
            assert got[want[0]] == pytest.approx(want[3], abs=1e-9)


def test_rows_are_hashed_once_by_a_split(spark):
    plan = exact_split(spark.range(50), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


def test_rows_of_a_pipeline_are_dealt_once(spark):
    class Watched(TabularPreprocessor):
        def _fit(self, dataset):
            seen.append(dataset.is_cached or dataset.storageLevel.useMemory)
            return super()._fit(dataset)

    seen = []
    fit = spark.createDataFrame([(float(i), float(2 * i)) for i in range(20)], "x double, y double")
    train.fit_pipeline(fit, Watched(numerical=["x"]), "ridge", {"alpha": 1e-3}, "y")
    assert seen == [True]


def test_one_search_serves_medians_and_robust_scales(spark, monkeypatch):
    rows = [(float(i % 7), None if i % 3 else float(i), float("nan") if i == 4 else -float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    fills = prep.fit_imputer(df, ["a", "b", "c"], "median")
    scales = prep.fit_scaler(prep.fill(df, fills), ["a", "b", "c"], "robust")
    asked, quantiles = [], prep.exact_quantiles
    monkeypatch.setattr(prep, "exact_quantiles", lambda df, columns, probs: asked.append(list(columns)) or quantiles(df, columns, probs))
    model = TabularPreprocessor(numerical=["a", "b", "c"]).fit(df)
    assert model.fitted()["fills"] == fills and {c: tuple(v) for c, v in model.fitted()["scaler"].items()} == scales
    assert asked == [["a", "b", "c"], ["b", "c"]]
    with pytest.raises(ValueError):
        TabularPreprocessor(numerical=["a"]).fit(df.where("a is null"))
