"""Data-quality counts, model quality, test suites and the history of metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import is_finite, is_missing, numeric_columns, quoted, ratio
from tallyforge.operators.ranks import exact_quantiles, running_counts

# --- data quality ---------------------------------------------------------------------------------


def _missing(df: DataFrame, column: str, markers: Sequence[Any] | None) -> Column:
    """Null, NaN or one of the markers, compared as text."""
    test = is_missing(df, column)
    if markers:
        test = test | F.coalesce(F.col(quoted(column)).cast("string").isin([str(m) for m in markers]), F.lit(False))
    return test


def dataset_missing(df: DataFrame, markers: Sequence[Any] | None = None) -> DataFrame:
    total = F.lit(0)
    for c in df.columns:
        total = total + _missing(df, c, markers).cast("int")
    one = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("missing_count"))
    return one.select("missing_count", ratio(F.col("missing_count"), F.col("n") * len(df.columns)).alias("missing_share"))


def count_where(df: DataFrame, tests: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows that pass each named test and their share, over the table or per group; one pass."""
    names = list(tests)
    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"),
                              *[F.count_if(tests[n]).alias(f"__t{i}") for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"__t{i}").alias("value"),
                              ratio(F.col(f"__t{i}"), F.col("__n")).alias("share")) for i, n in enumerate(names)])
    return one.select(*by, F.inline(rows))


def column_missing(df: DataFrame, columns: Sequence[str], markers: Sequence[Any] | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    return count_where(df, {c: _missing(df, c, markers) for c in columns}, by).withColumnRenamed("metric", "column")


def regex_tests(column: str, pattern: str) -> dict[str, Column]:
    hit = F.col(quoted(column)).cast("string").rlike(f"^(?:{pattern})")
    return {"match": hit, "mismatch": ~hit}


def range_tests(column: str, left: Any = None, right: Any = None) -> dict[str, Column]:
    col = F.col(quoted(column))
    inside = col.isNotNull()
    if left is not None:
        inside = inside & (col >= left)
    if right is not None:
        inside = inside & (col <= right)
    return {"in_range": inside, "out_of_range": col.isNotNull() & ~inside}


def list_tests(column: str, values: Sequence[Any]) -> dict[str, Column]:
    hit = F.col(quoted(column)).isin(list(values))
    return {"in_list": hit, "out_of_list": ~hit}


# --- regression --------------------------------------------------------------------------------------

def regression_quality(df: DataFrame, target: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean error, MAE, MAPE in percent, RMSE, R2 and largest error over rows where both sides are known."""
    y, p = F.col(quoted(target)).cast("double"), F.col(quoted(prediction)).cast("double")
    err = p - y
    one = df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.avg(err).alias("me"), F.avg(F.abs(err)).alias("mae"), (F.avg(F.try_divide(F.abs(err), F.abs(y))) * 100).alias("mape"),
        F.avg(err * err).alias("__mse"), F.var_pop(y).alias("__var"), F.max(F.abs(err)).alias("max_error"))
    return one.select(*by, "me", "mae", "mape", F.sqrt("__mse").alias("rmse"),
                      (1 - F.try_divide(F.col("__mse"), F.col("__var"))).alias("r2_score"), "max_error")


def evaluation_metrics(df: DataFrame, target: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, RMSLE (both sides clipped at zero) and R2; a non-finite prediction or target is an error."""
    def finite(name):
        col = F.col(quoted(name)).cast("double")
        return F.when(is_finite(col), col).otherwise(
            F.raise_error(F.lit(f"non-finite value in {name}")).cast("double"))
    rows = df.select(*by, finite(target).alias("__y"), finite(prediction).alias("__p"))
    err = F.col("__p") - F.col("__y")
    log_err = F.log1p(F.greatest("__p", F.lit(0.0))) - F.log1p(F.greatest("__y", F.lit(0.0)))
    one = rows.groupBy(*by).agg(F.avg(err * err).alias("mse"), F.avg(log_err * log_err).alias("msle"),
                                F.var_pop("__y").alias("var"))
    return one.select(*by, F.col("mse").alias("mean_squared_error"), F.sqrt("mse").alias("root_mean_squared_error"),
                      F.sqrt("msle").alias("root_mean_squared_log_error"),
                      (1 - F.try_divide(F.col("mse"), F.col("var"))).alias("r2_score"))


def dummy_regression(df: DataFrame, target: str) -> DataFrame:
    """What a constant predictor reaches: the median for MAE and MAPE, the mean for RMSE."""
    median = exact_quantiles(df, [target], [0.5])[target][0.5]
    y = F.col(quoted(target)).cast("double")
    gap = F.abs(y - F.lit(median))
    return df.agg(F.avg(gap).alias("dummy_mae"), (F.avg(F.try_divide(gap, F.abs(y))) * 100).alias("dummy_mape"),
                  F.stddev_pop(y).alias("dummy_rmse"))


# --- classification -------------------------------------------------------------------------------------

def roc_auc(df: DataFrame, target: str, score: str) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half."""
    t = F.col(quoted(target))
    counts = (df.where(t.isNotNull() & F.col(quoted(score)).isNotNull())
              .groupBy(F.lit("score").alias("column"), F.col(quoted(score)).cast("double").alias("value"))
              .agg(F.count_if(t == 1).alias("pos"), F.count_if(t == 0).alias("neg")))
    placed = running_counts(counts, ["column"], "value", ["pos", "neg"])
    wins = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)
    one = placed.agg(F.sum(wins).alias("wins"), F.max("pos_total").alias("p"), F.max("neg_total").alias("n"))
    return one.select(F.try_divide(F.col("wins"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"))


def _confusion(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return [ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), zero(precision).alias("precision"),
            zero(recall).alias("recall"), zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1")]


def classification_quality(df: DataFrame, target: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1, ROC-AUC and log-loss of a probability score."""
    t, s = F.col(quoted(target)), F.col(quoted(score)).cast("double")
    known = df.where(t.isNotNull() & s.isNotNull())
    yes = s >= threshold
    p = F.least(F.greatest(s, F.lit(1e-15)), F.lit(1 - 1e-15))
    cells = known.agg(
        F.count_if((t == 1) & yes).alias("tp"), F.count_if((t == 0) & yes).alias("fp"),
        F.count_if((t == 1) & ~yes).alias("fn"), F.count_if((t == 0) & ~yes).alias("tn"),
        F.avg(F.when(t == 1, -F.ln(p)).otherwise(-F.ln(1 - p))).alias("log_loss"))
    left = cells.select(F.lit(0).alias("k"), *_confusion(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]), "log_loss")
    right = roc_auc(known, target, score).select(F.lit(0).alias("k"), "roc_auc")
    return left.join(right, "k").drop("k")


def dummy_classification(df: DataFrame, target: str) -> DataFrame:
    """Scores of always saying the majority class (0 on a tie); its ROC-AUC is one half."""
    t = F.col(quoted(target))
    one = df.agg(F.count_if(t == 1).alias("pos"), F.count_if(t == 0).alias("neg"))
    say = F.col("pos") > F.col("neg")
    zero = F.lit(0).cast("long")
    cells = one.select(F.when(say, F.col("pos")).otherwise(zero).alias("tp"), F.when(say, F.col("neg")).otherwise(zero).alias("fp"),
                       F.when(say, zero).otherwise(F.col("pos")).alias("fn"), F.when(say, zero).otherwise(F.col("neg")).alias("tn"))
    return cells.select(*_confusion(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]), F.lit(0.5).alias("roc_auc"))


def class_quality(df: DataFrame, target: str, prediction: str, digits: int | None = None) -> DataFrame:
    """(class, n_rows, precision, recall, f1) of every class that occurs as target or prediction; shares without cases are 0."""
    known = df.select(F.col(quoted(target)).cast("string").alias("t"), F.col(quoted(prediction)).cast("string").alias("p"))
    cells = known.where("t is not null and p is not null").groupBy("t", "p").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("is"), F.lit(0).cast("long").alias("said"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).cast("long").alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("is"), F.col("n").alias("said"), F.lit(0).cast("long").alias("hit")))))
    per = sides.groupBy("class").agg(F.sum("is").alias("is"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    share = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))
    cut = lambda c: c if digits is None else F.round(c, digits)
    return per.select("class", F.col("is").alias("n_rows"), cut(share(F.col("hit"), F.col("said"))).alias("precision"),
                      cut(share(F.col("hit"), F.col("is"))).alias("recall"),
                      cut(share(2 * F.col("hit"), F.col("is") + F.col("said"))).alias("f1"))


def multiclass_quality(df: DataFrame, target: str, prediction: str, probabilities: str | None = None) -> DataFrame:
    """Accuracy, macro precision, recall and F1 (means over the classes), and the log-loss of a map from class to probability."""
    t, p = F.col(quoted(target)).cast("string"), F.col(quoted(prediction)).cast("string")
    known = df.where(t.isNotNull() & p.isNotNull())
    macro = class_quality(known, target, prediction).agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"))
    aggs = [F.avg((t == p).cast("double")).alias("accuracy")]
    if probabilities:
        sure = F.coalesce(F.try_element_at(F.col(quoted(probabilities)), t).cast("double"), F.lit(0.0))
        aggs.append(F.avg(-F.ln(F.least(F.greatest(sure, F.lit(1e-15)), F.lit(1 - 1e-15)))).alias("log_loss"))
    one = known.agg(*aggs).withColumn("k", F.lit(0))
    return one.join(macro.withColumn("k", F.lit(0)), "k").drop("k")


def dummy_multiclass(df: DataFrame, target: str, log_loss: bool = False) -> DataFrame:
    """Scores of always saying the most frequent class, the first in text order on a tie.

    With `log_loss` also that of giving every row the class shares as probabilities, which is their entropy.
    """
    t = F.col(quoted(target)).cast("string")
    per = df.where(t.isNotNull()).groupBy(t.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    one = per.agg(F.sum("n").cast("double").alias("all"), F.count(F.lit(1)).alias("classes"), F.sum(F.col("n") * F.ln("n")).alias("n_ln_n"),
                  F.min(F.struct((-F.col("n")).alias("neg"), F.col("class").alias("class"))).alias("top"))
    hit, classes = -F.col("top.neg"), F.col("classes")
    return one.select(F.col("top.class").alias("class"), ratio(hit, F.col("all")).alias("accuracy"),
                      (ratio(hit, F.col("all")) / classes).alias("macro_precision"), ratio(F.lit(1.0), classes).alias("macro_recall"),
                      (ratio(2 * hit, F.col("all") + hit) / classes).alias("macro_f1"),
                      *([F.greatest(F.ln("all") - F.col("n_ln_n") / F.col("all"), F.lit(0.0)).alias("log_loss")] if log_loss else []))


# --- test suites ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class MetricTest:
    """`metric` of `column` compared with a bound; a failed `warn` test is a warning."""
    metric: str
    op: str  # one of <, <=, >, >=, ==
    bound: float
    column: str = ""
    severity: str = "fail"


#: Named suites: what a model or table is held to. Bounds are names of other metrics (baselines) or numbers.
SUITES: dict[str, tuple[tuple[str, str, str | float], ...]] = {
    "regression": (("rmse", "<", "dummy_rmse"), ("mae", "<", "dummy_mae"), ("r2_score", ">", 0.0)),
    "binary": (("accuracy", ">", "dummy_accuracy"), ("precision", ">", "dummy_precision"), ("recall", ">", 0.0),
               ("f1", ">", "dummy_f1"), ("roc_auc", ">", 0.5)),
    "multiclass": (("accuracy", ">", "dummy_accuracy"), ("macro_f1", ">", "dummy_macro_f1"), ("log_loss", "<", "dummy_log_loss")),
    "recsys": (("precision_at_k", ">", 0.0), ("recall_at_k", ">", 0.0), ("ndcg_at_k", ">", 0.0), ("hit_rate_at_k", ">", 0.0)),
    "stability": (("row_count_ratio", ">=", 0.9), ("row_count_ratio", "<=", 1.1), ("changed_types", "==", 0.0),
                  ("out_of_range", "==", 0.0), ("out_of_list", "==", 0.0)),
    "drift": (("dataset_drift_share", "<", 0.5),),
    "quality": (("dataset_missing_share", "<", 0.1), ("duplicate_rows", "==", 0.0), ("constant_columns", "==", 0.0)),
    "no_target": (("dataset_drift_share", "<", 0.5), ("dataset_missing_share", "<", 0.1), ("row_count_ratio", ">=", 0.9)),
}


def long_metrics(wide: DataFrame, prefix: str = "") -> DataFrame:
    """(metric, column, value) rows of the numeric columns of a one-row table."""
    cells = [F.struct(F.lit(prefix + c).alias("metric"), F.lit("").alias("column"), F.col(quoted(c)).cast("double").alias("value"))
             for c in numeric_columns(wide)]
    return wide.select(F.inline(F.array(*cells)))


def run_suite(metrics: DataFrame, name: str) -> DataFrame:
    """(metric, column, value, op, bound, status) of a named suite on a long metric table.

    A test runs once for every column that has its metric. A test whose metric or baseline is absent fails.
    """
    if name not in SUITES:
        raise ValueError(f"unknown suite {name!r}, expected one of {sorted(SUITES)}")
    rules = metrics.sparkSession.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(m).alias("metric"), F.lit(op).alias("op"), F.lit(b if isinstance(b, str) else None).cast("string").alias("baseline"),
        F.lit(None if isinstance(b, str) else float(b)).cast("double").alias("fixed")) for m, op, b in SUITES[name]])))
    values = metrics.select("metric", "column", F.col("value").cast("double").alias("value"))
    baselines = values.where(F.col("column") == "").select(F.col("metric").alias("baseline"), F.col("value").alias("measured"))
    v, b, op = F.col("value"), F.coalesce("fixed", "measured"), F.col("op")
    holds = (F.when(op == "<", v < b).when(op == "<=", v <= b).when(op == ">", v > b)
             .when(op == ">=", v >= b).when(op == "==", v == b))
    return rules.join(baselines, "baseline", "left").join(values, "metric", "left").select(
        "metric", F.coalesce("column", F.lit("")).alias("column"), "value", "op", b.alias("bound"),
        F.when(F.coalesce(holds, F.lit(False)), "SUCCESS").otherwise("FAIL").alias("status"))


def run_tests(metrics: DataFrame, tests: Sequence[MetricTest]) -> DataFrame:
    """(metric, column, value, op, bound, status) for a long metric table (metric, column, value).

    A metric that is absent or null fails its test.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("test_id"), F.lit(t.metric).alias("metric"), F.lit(t.column).alias("column"),
                               F.lit(t.op).alias("op"), F.lit(float(t.bound)).alias("bound"),
                               F.lit(t.severity).alias("severity")) for i, t in enumerate(tests)])
    rules = metrics.sparkSession.range(1).select(F.inline(cells))
    v, b, op = F.col("value"), F.col("bound"), F.col("op")
    holds = (F.when(op == "<", v < b).when(op == "<=", v <= b).when(op == ">", v > b)
             .when(op == ">=", v >= b).when(op == "==", v == b))
    status = F.when(F.coalesce(holds, F.lit(False)), "SUCCESS").when(F.col("severity") == "warn", "WARNING").otherwise("FAIL")
    return (rules.join(metrics.select("metric", "column", F.col("value").cast("double").alias("value")),
                       ["metric", "column"], "left")
            .select("metric", "column", "value", "op", "bound", status.alias("status")))


def table_metrics(df: DataFrame) -> DataFrame:
    """Long metric table about one table alone: share of missing cells, rows repeated in full, and columns with one value at most."""
    rows = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    missing = sum((F.when(is_missing(df, c), F.col("__n")).otherwise(0) for c in df.columns), F.lit(0))
    lows, highs = ([f(quoted(c)).alias(f"{p}{i}") for i, c in enumerate(df.columns)] for p, f in (("l", F.min), ("h", F.max)))
    one = rows.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("kinds"), F.sum(missing).alias("missing"), *lows, *highs)
    constant = sum((F.coalesce(F.col(f"l{i}") == F.col(f"h{i}"), F.lit(True)).cast("int") for i in range(len(df.columns))), F.lit(0))
    cells = [("dataset_missing_share", F.coalesce(ratio(F.col("missing"), F.col("rows") * len(df.columns)), F.lit(0.0))),
             ("duplicate_rows", F.col("rows") - F.col("kinds")), ("constant_columns", constant)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("").alias("column"), v.cast("double").alias("value"))
                                         for m, v in cells])))


def summarize_tests(results: DataFrame) -> DataFrame:
    by = lambda s: F.count_if(F.col("status") == s)
    return results.agg(F.count(F.lit(1)).alias("total_tests"), by("SUCCESS").alias("success_tests"),
                       by("FAIL").alias("failed_tests"), by("WARNING").alias("warning_tests"),
                       (F.count_if(F.col("status") != "SUCCESS") == 0).alias("all_passed"))


def stability_metrics(reference: DataFrame, current: DataFrame, categories: Sequence[str] = ()) -> DataFrame:
    """Long metric table that says how far the current table leaves the reference.

    Row-count ratio, columns whose type changed, and per column the rows outside the
    reference's range (numbers) or value list (categories).
    """
    nums = [c for c in numeric_columns(reference) if c in current.columns]
    ranges = reference.agg(F.count(F.lit(1)).alias("n"), *[
        f(quoted(c)).cast("double").alias(f"{p}{i}") for i, c in enumerate(nums) for p, f in (("lo", F.min), ("hi", F.max))]).first()
    changed = len([1 for c, t in reference.dtypes if dict(current.dtypes).get(c) != t])
    one = current.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(~F.col(quoted(c)).between(ranges[f"lo{i}"], ranges[f"hi{i}"])).alias(f"out{i}") for i, c in enumerate(nums)])
    rows = [("row_count_ratio", "", F.try_divide(F.col("n").cast("double"), F.lit(float(ranges["n"])))),
            ("changed_types", "", F.lit(float(changed)))]
    rows += [("out_of_range", c, F.col(f"out{i}").cast("double")) for i, c in enumerate(nums)]
    out = one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column"), v.alias("value"))
                                        for m, c, v in rows])))
    for c in categories:
        known = reference.select(F.col(quoted(c)).alias("__known")).distinct()
        fresh = current.groupBy(F.col(quoted(c)).alias("__value")).agg(F.count(F.lit(1)).alias("n")).join(
            known, F.col("__value").eqNullSafe(F.col("__known")), "left_anti")
        out = out.unionByName(fresh.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value")).select(
            F.lit("out_of_list").alias("metric"), F.lit(c).alias("column"), "value"))
    return out


# --- metric history -------------------------------------------------------------------------------------

def metric_row(metrics: DataFrame, run_ts: str, names: Sequence[str]) -> DataFrame:
    """The named metrics as one wide row stamped with the run; absent ones are null."""
    return metrics.agg(*[F.max(F.when((F.col("metric") == n) & (F.col("column") == ""), F.col("value"))).alias(n)
                         for n in names]).select(F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"), *names)


def append_history(metrics: DataFrame, run_ts: str, path: str) -> None:
    (metrics.where(F.col("value").isNotNull())
     .select(F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"), "metric", "column", F.col("value").cast("double").alias("value"))
     .write.mode("append").parquet(path))


def latest_metrics(history: DataFrame) -> DataFrame:
    """The most recent value of every metric and column."""
    return history.groupBy("metric", "column").agg(F.max("run_ts").alias("run_ts"), F.max_by("value", "run_ts").alias("value"))


def metric_lines(history: DataFrame, metric: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One line per column over the runs of a history: run_ts, column, value, and how far it moved since the run before.

    Of several values of one run the largest counts; a column that a run does not have is left out of it.
    """
    rows = history.where(F.col("metric") == metric)
    if columns is not None:
        rows = rows.where(F.col("column").isin(list(columns)))
    per_run = rows.groupBy("column", "run_ts").agg(F.max("value").alias("value"))
    before = F.lag("value").over(Window.partitionBy("column").orderBy("run_ts"))
    return per_run.select("column", "run_ts", "value", (F.col("value") - before).alias("change"))
