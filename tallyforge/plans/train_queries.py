from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyforge.operators import quality, train
from tallyforge.operators.contract import Check, Contract, Field
from tallyforge.operators.prep import TabularPreprocessor
from tallyforge.operators.split import exact_split
from tallyforge.plans.drift_queries import _rounded
from tallyforge.plans.registry import query, table
from tallyforge.session import scratch_path
from tallyforge.sources.writers import export_splits, training_report

_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
_NUM = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]
_PREP = {"numerical": {"imputer": {"type": "simple"}, "scaler": {"type": "robust"}},
         "categorical": {"encoder": {"type": "onehot", "handle_unknown": "ignore"}}}
_CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


#: Trials of a search, and trees or rounds of a single fit: the sizes of the full job, see "Full-size training" in the README.
TRIALS, TREES = 20, 200


def _lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.withColumn("charge", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))


def _split_lines(spark, sf):
    """The split is written once and read by every later stage."""
    path = scratch_path(spark, "split-lines")
    export_splits(exact_split(_lines(spark, sf), _KEY), path)
    return spark.read.parquet(path)


def _features(spark, sf):
    """Feature vectors of all lines with their split; scaling is fitted on the training rows."""
    parts = _split_lines(spark, sf)
    model = TabularPreprocessor(numerical=_NUM, categorical=["l_returnflag"], config=_PREP).fit(
        parts.where(F.col("split") == "train"))
    return model.transform(parts).select("split", "features", "charge")


@query("g13_ridge", f"""
with t as (select l_extendedprice / 1000 as x, {_CHARGE} / 1000 as y from lineitem), m as (select avg(x) as mx, avg(y) as my from t),
s as (select sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + 50.0) as slope, max(mx) as mx, max(my) as my from t, m)
select round(slope, 6) as slope, round(my - slope * mx, 5) as intercept from s""")
def ridge(spark, sf):
    lines = _lines(spark, sf).select((F.col("l_extendedprice") / 1000).alias("x"), (F.col("charge") / 1000).alias("y"))
    data = train.spread(VectorAssembler(inputCols=["x"], outputCol="features").transform(lines))
    model = train.regressor("ridge", {"alpha": 50.0}, "features", "y", train.label_stats(data, "y")).fit(data)
    return spark.range(1).select(F.round(F.lit(float(model.coefficients[0])), 6).alias("slope"),
                                 F.round(F.lit(float(model.intercept)), 5).alias("intercept"))


def _fitted(spark, sf, name, params):
    """Validation scores next to those of a constant predictor."""
    parts = train.spread(_features(spark, sf).where(F.col("split") != "test")).persist()
    fit_on, val = parts.where(F.col("split") == "train"), parts.where(F.col("split") == "val")
    model = train.regressor(name, params, "features", "charge", train.label_stats(fit_on, "charge"), validation="held")
    if name in ("gradient_boosting", "xgboost"):  # they stop by the validation rows
        fit_on = parts.withColumn("held", F.col("split") == "val")
    model = model.fit(fit_on)
    scores = quality.evaluation_metrics(model.transform(val), "charge", "prediction").first()
    dummy = quality.dummy_regression(val, "charge").first()
    parts.unpersist()
    return spark.createDataFrame([(name, scores["root_mean_squared_error"], scores["r2_score"], dummy["dummy_rmse"])],
                                 "model string, rmse double, r2_score double, dummy_rmse double")


@query("g13_ridge_multi")
def ridge_multi(spark, sf):
    return _fitted(spark, sf, "ridge", {"alpha": 1.0})


@query("g14_rf")
def random_forest(spark, sf):
    return _fitted(spark, sf, "random_forest", {"n_estimators": TREES, "max_depth": 6, "max_features": 0.8})


@query("g15_gbt")
def gradient_boosting(spark, sf):
    return _fitted(spark, sf, "gradient_boosting", {"n_estimators": TREES, "max_depth": 4, "learning_rate": 0.3})


@query("g16_xgb")
def second_order_boosting(spark, sf):
    return _fitted(spark, sf, "xgboost", {"n_estimators": TREES, "max_depth": 5, "learning_rate": 0.3, "subsample": 0.8,
                                           "colsample_bytree": 0.8})


def _search(spark, sf):
    parts = _features(spark, sf)
    return train.search(spark, parts.where(F.col("split") == "train"), parts.where(F.col("split") == "val"), "charge",
                        n_trials=TRIALS, seed=7, metrics=["root_mean_squared_error", "r2_score"], space=train.SPACE)


@query("g17_search")
def search(spark, sf):
    return _search(spark, sf).trials


@query("g19_best_trial")
def best_trial(spark, sf):
    return train.best_trials(_search(spark, sf).trials)


@query("g19_own_metric", f"""
with t as (select l_extendedprice / 1000 as x, {_CHARGE} / 1000 as y from lineitem), m as (select avg(x) as mx, avg(y) as my from t),
s as (select sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + 50.0) as slope, max(mx) as mx, max(my) as my from t, m)
select 'run' as run_id, 'largest_gap' as metric, 'minimize' as direction, round(max(abs(y - (s.my - slope * s.mx + slope * x))), 4) as best_score,
       'ridge' as model_type, 2::bigint as total, 2::bigint as completed, 2::bigint as n_reported, count(*) as train_rows from t, s""")
def own_metric(spark, sf):
    """A search by a metric of the caller's own, and its report."""
    lines = _lines(spark, sf).select((F.col("l_extendedprice") / 1000).alias("x"), (F.col("charge") / 1000).alias("y"))
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(lines)
    gap = lambda df, label, said: df.agg(F.max(F.abs(F.col(label) - F.col(said)))).first()[0]
    found = train.search(spark, data, data, "y", n_trials=2, model="ridge", space={"ridge": {"alpha": ("real", 50.0, 50.0)}}, metrics=[],
                         own_metrics={"largest_gap": ("minimize", gap)})
    report = training_report(train.best_trials(found.trials), data, data, 1)
    return report.select("run_id", "metric", "direction", F.round("best_score", 4).alias("best_score"), "model_type", "total", "completed",
                         F.lit(found.trials.count()).cast("long").alias("n_reported"), "train_rows")


def _pipeline(spark, sf):
    parts = _split_lines(spark, sf)
    prep = TabularPreprocessor(numerical=_NUM, categorical=["l_returnflag"], config=_PREP)
    return parts, train.fit_pipeline(parts.where(F.col("split") == "train"), prep, "ridge", {"alpha": 1.0}, "charge")


@query("g21_roundtrip", """select count(*) as n_rows, count(*) as n_equal from lineitem""")
def roundtrip(spark, sf):
    parts, model = _pipeline(spark, sf)
    path = scratch_path(spark, "pipeline")
    train.save_pipeline(model, path)
    back = train.load_pipeline(path)
    before = model.transform(parts).withColumnRenamed("prediction", "first").drop("features")
    both = back.transform(before)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("first") == F.col("prediction")).alias("n_equal"))


SCORING = Contract("scoring", (
    Field("l_quantity", "double", (Check("in_range", {"min_val": 2, "max_val": 48}),)),
    Field("l_extendedprice", "double", (Check("in_range", {"min_val": 1000, "max_val": 100000}),)),
    Field("l_discount", "double", (Check("in_range", {"min_val": 0, "max_val": 1}),)),
    Field("l_tax", "double", (Check("in_range", {"min_val": 0, "max_val": 1}),)),
    Field("l_returnflag", "string", (Check("isin", {"values": ["A", "N", "R"]}),))), ("l_returnflag",), strict=True)


@query("g23_batch_score", """
select l_returnflag, count(*) as n_scored from lineitem
where l_quantity between 2 and 48 and l_extendedprice between 1000 and 100000 group by l_returnflag""")
def batch_score(spark, sf):
    parts, model = _pipeline(spark, sf)
    scored = train.score(model, parts.select(*_NUM, "l_returnflag"), SCORING)
    return scored.groupBy("l_returnflag").agg(F.count("prediction").alias("n_scored"))


@query("g23_score_quality")
def score_quality(spark, sf):
    """Prediction error of the saved-form pipeline over the test rows."""
    parts, model = _pipeline(spark, sf)
    return _rounded(quality.regression_quality(train.score(model, parts.where(F.col("split") == "test")), "charge", "prediction"))
