"""Boosted trees against a plain split search, and searches with and without rungs."""

import json

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.operators import boost, train
from tallyforge.session import scratch_path


def frame(spark, x, y):
    return spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "y"]).cache()


def data(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, (n, 3)), 1)
    x[:, 2] = rng.integers(0, 2, n)
    return x, np.sin(x[:, 0]) * 5 + x[:, 1] * x[:, 2] + rng.normal(size=n)


def plain(x, y, edges, plan):
    """Boosting by trying every cut of every feature on the rows themselves."""
    def grow(rows, depth):
        g, n = residual[rows].sum(), len(rows)
        best = None
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left = x[rows, f] <= cut
                if plan.min_rows <= left.sum() <= n - plan.min_rows:
                    a, b = residual[rows][left].sum(), residual[rows][~left].sum()
                    gain = a * a / (left.sum() + plan.penalty) + b * b / (n - left.sum() + plan.penalty) - g * g / (n + plan.penalty)
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12) + 1e-12):
                        best = gain, f, cut
        if depth == 0 or best is None:
            out[rows] = plan.learning_rate * g / (n + plan.penalty)
            return
        left = x[rows, best[1]] <= best[2]
        grow(rows[left], depth - 1)
        grow(rows[~left], depth - 1)

    said, out = np.full(len(y), y.mean()), np.zeros(len(y))
    for _ in range(plan.rounds):
        residual = y - said
        grow(np.arange(len(y)), plan.max_depth)
        said = said + out
    return said


@pytest.mark.parametrize("small", [10**9, 60, 0])
@pytest.mark.parametrize("penalty", [0.0, 5.0])
def test_trees_equal_a_plain_split_search(spark, monkeypatch, small, penalty):
    monkeypatch.setattr(boost, "SMALL_ROWS", small)
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    x, y = data(400)
    plan = boost.Plan(rounds=3, max_depth=3, learning_rate=0.5, penalty=penalty, min_rows=5)
    df = frame(spark, x, y)
    model = boost.BoostedTrees(labelCol="y", plan=json.dumps(plan.__dict__)).fit(df)
    edges = json.loads(model.getOrDefault("trees"))["edges"]
    got = np.array([r["prediction"] for r in model.transform(df).collect()])
    assert got == pytest.approx(plain(x, y, edges, plan), abs=1e-9)


def test_the_penalty_shrinks_leaves_and_odd_rows_pass(spark):
    df = frame(spark, [[1.0], [2.0]], [0.0, 8.0])
    free, held = (boost.BoostedTrees(labelCol="y", plan=json.dumps({"rounds": 1, "max_depth": 1, "learning_rate": 1.0, "penalty": p})).fit(df)
                  for p in (0.0, 1.0))
    assert [r["prediction"] for r in free.transform(df).collect()] == [0.0, 8.0]
    assert [r["prediction"] for r in held.transform(df).collect()] == [2.0, 6.0]
    odd = frame(spark, [[float("nan")], [-1e300]], [0.0, 0.0])
    assert [r["prediction"] for r in free.transform(odd).collect()] == [8.0, 0.0]
    assert free.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        boost.BoostedTrees(labelCol="y").fit(df.limit(0))


def test_growth_stops_by_the_validation_rows_and_is_saved(spark):
    x, y = data(500)
    rng = np.random.default_rng(2)
    df = frame(spark, x, np.where(rng.random(500) < 0.5, y, rng.permutation(y))).withColumn("held", F.col("y") * 1000 % 3 < 1)
    model = boost.BoostedTrees(labelCol="y", validationIndicatorCol="held", plan=json.dumps(
        {"rounds": 200, "max_depth": 4, "learning_rate": 0.5, "subsample": 0.7, "columns": 0.7, "patience": 4})).fit(df)
    assert 0 < model.n_trees < 100
    path = scratch_path(spark, "boosted")
    model.save(path)
    back = boost.BoostedTreesModel.load(path)
    assert [r["prediction"] for r in back.transform(df).collect()] == [r["prediction"] for r in model.transform(df).collect()]


def test_models_grown_in_step_equal_models_grown_alone(spark):
    x, y = data(300)
    fit, val = frame(spark, x[:200], y[:200]), frame(spark, x[200:], y[200:])
    plans = [boost.Plan(rounds=11, max_depth=2, subsample=0.8, seed=3), boost.Plan(rounds=5, max_depth=4, columns=0.5, penalty=1.0)]

    def grown(plans):
        b = boost.Booster(fit, val, "features", "y")
        models = [boost.Growing(i, p) for i, p in enumerate(plans)]
        for rounds in (2, 9, 11):
            b.advance(models, rounds)
        b.close()
        return [(m.trees, m.scores) for m in models]

    together, alone = grown(plans), [grown([p])[0] for p in plans]
    for (trees, scores), (own, own_scores) in zip(together, alone):
        assert [t.feature for t in trees] == [t.feature for t in own] and scores == pytest.approx(own_scores)


def small_space():
    """Trials that differ in depth and row share, at one pace, so that early scores say who wins."""
    grown = {"n_estimators": ("step", 20, 20, 5), "learning_rate": ("log", 0.3, 0.301), "max_depth": ("step", 1, 4, 1)}
    return {"ridge": {"alpha": ("log", 1e-4, 1.0)}, "random_forest": {"n_estimators": ("step", 12, 14, 2), "max_depth": ("step", 2, 6, 1)},
            "gradient_boosting": grown, "xgboost": {**grown, "colsample_bytree": ("real", 0.9, 1.0)}}


def test_rungs_find_the_trial_that_a_whole_search_finds(spark):
    x, y = data(400)
    fit, val = frame(spark, x[:300], y[:300]), frame(spark, x[300:], y[300:])
    found = {rungs: train.search(spark, fit, val, "y", n_trials=8, seed=5, space=small_space(), rungs=rungs) for rungs in ((10,), ())}
    states = {rungs: {r["trial"]: r["state"] for r in f.trials.collect()} for rungs, f in found.items()}
    assert set(states[()].values()) == {"COMPLETE"} and set(states[(10,)].values()) == {"COMPLETE", "PRUNED"}
    best = [train.best_trials(f.trials).first() for f in found.values()]
    assert best[0]["best_params"] == best[1]["best_params"] and best[0]["pruned"] > 0
    assert best[0]["best_score"] == pytest.approx(best[1]["best_score"], rel=0.05)  # a forest of parts has other seeds


def test_forests_of_parts_are_means_and_saved(spark):
    x, y = data(200)
    df = frame(spark, x, y)
    parts = [(train.regressor("random_forest", {"n_estimators": n}, "features", "y", (200, 1.0), seed).fit(df), n) for n, seed in ((2, 1), (6, 2))]
    whole = train.mean_forest(parts)
    want = [[r["prediction"] for r in part.transform(df).collect()] for part, _ in parts]
    got = [r["prediction"] for r in whole.transform(df).collect()]
    assert got == pytest.approx([(2 * a + 6 * b) / 8 for a, b in zip(*want)])
    path = scratch_path(spark, "forest")
    train.save_pipeline(whole, path)
    assert [r["prediction"] for r in train.load_pipeline(path).transform(df).collect()] == got and whole.transform(df).columns == [*df.columns, "prediction"]


def test_blocks_keep_all_rows_and_deep_margins_are_checkpointed(spark, monkeypatch):
    monkeypatch.setattr(boost, "BLOCK_ROWS", 32)
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    monkeypatch.setattr(boost, "KEPT", 2)
    x, y = data(450)
    fit, val = frame(spark, x[:400], y[:400]), frame(spark, x[400:], y[400:])
    b = boost.Booster(fit, val, "features", "y")
    # A record is a block, so that tasks do not pass rows one by one.
    assert 4 <= b.base.count() < 30 and b.rows == 400 and b.start == pytest.approx(y[:400].mean())
    rows = [(int(n), r.tolist(), t, h) for row, bins, label, held in boost.opened(b.base.toArrow().to_batches())
            for n, r, t, h in zip(row, bins, label, held)]
    want = [(r, t, i >= 400) for i, (r, t) in enumerate(zip(boost.binned_array(x, b.edges).tolist(), y.tolist()))]
    assert sorted(r[1:] for r in rows) == sorted(want) and len({r[0] for r in rows}) == 450
    plan = boost.Plan(rounds=10, max_depth=3, patience=99)
    model = boost.Growing(0, plan)
    b.advance([model], 10)
    assert b.renewals >= 5 and len(model.trees) == 10
    said = np.array([r["prediction"] for r in boost.BoostedTreesModel.of(b.start, b.edges, model.trees).transform(val).collect()])
    assert model.scores[-1] == pytest.approx(float(np.sqrt(np.mean((said - y[400:]) ** 2))))
    b.close()


def test_rows_reach_leaves_of_any_depth():
    tree = boost.Tree()
    left, right = tree.split(0, 1, 3, (1.0, 2.0))
    tree.split(right, 0, 7, (5.0, 9.0))
    assert tree.predict(np.array([[8, 3], [7, 4], [8, 4]], np.uint8)).tolist() == [1.0, 5.0, 9.0]
    assert boost.Tree().nodes(np.zeros((2, 3), np.uint8)).tolist() == [0, 0] and len(tree.nodes(np.zeros((0, 2), np.uint8))) == 0


def test_pooled_rounds_equal_level_jobs_and_leave_no_long_plans(spark, monkeypatch):
    x, y = data(400)
    x = np.round(x)  # equal rows with other labels, drawn each for itself
    fit, val = frame(spark, x[:300], y[:300]), frame(spark, x[300:], y[300:])
    monkeypatch.setattr(boost, "KEPT", 2)
    plans = [boost.Plan(rounds=7, max_depth=3, subsample=0.7, columns=0.7, seed=3), boost.Plan(rounds=5, max_depth=4, penalty=1.0, min_rows=3)]
    got = []
    for small in (10**9, 40, 0):
        monkeypatch.setattr(boost, "SMALL_ROWS", small)
        b = boost.Booster(fit, val, "features", "y")
        assert b.points < 200
        models = [boost.Growing(i, p) for i, p in enumerate(plans)]
        b.advance(models, 7)
        # Margins are read back from where they were written: a plan that held all rounds so far made the driver's memory grow.
        assert b.renewals >= 2 and "MapInArrow" not in b.written._jdf.queryExecution().logical().toString()
        b.close()
        got.append([(sorted(round(v, 9) for v in m.trees[-1].value), len(m.trees), m.scores) for m in models])
    for other in got[1:]:
        for (values, n, scores), (own, own_n, own_scores) in zip(got[0], other):
            assert n == own_n and scores == pytest.approx(own_scores) and values == pytest.approx(own)


def test_trees_are_packed_and_grafted():
    tree, other = boost.Tree(), boost.Tree()
    left, right = tree.split(0, 1, 3, (1.0, 2.0))
    other.split(other.split(0, 0, 7, (5.0, 9.0))[1], 2, 1, (3.0, 4.0))
    tree.graft(right, other)
    back = boost.Tree.unpacked(tree.packed())
    assert back == tree and len(tree.packed()) == 16 * 7
    assert back.predict(np.array([[9, 3, 0], [7, 4, 0], [8, 4, 1], [8, 4, 2]], np.uint8)).tolist() == [1.0, 5.0, 3.0, 4.0]


def test_a_search_grows_every_trial_to_its_full_size(spark):
    x, y = data(300)
    noise = np.random.default_rng(8).normal(size=300)  # nothing to learn: neither rungs nor validation rows may end a trial
    fit, val = frame(spark, x[:200], noise[:200]), frame(spark, x[200:], noise[200:])
    found = train.search(spark, fit, val, "y", n_trials=3, seed=5, model="xgboost", space={"xgboost": {
        "n_estimators": ("step", 30, 40, 5), "max_depth": ("step", 2, 4, 1), "learning_rate": ("real", 0.2, 0.3), "subsample": ("real", 0.6, 1.0)}})
    rows = found.trials.collect()
    assert {r["state"] for r in rows} == {"COMPLETE"}
    best = min(rows, key=lambda r: r["score"])
    assert found.best["root_mean_squared_error"].n_trees == eval(best["params"])["n_estimators"]
    wide = train.search(spark, fit, val, "y", n_trials=8, seed=5, space=small_space())
    assert {r["state"] for r in wide.trials.collect()} == {"COMPLETE"}
