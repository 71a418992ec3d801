"""Regression models: building, searching, reporting, saving and scoring with Spark ML."""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.columns import is_finite
from tallyforge.operators import boost, forest, pooled
from tallyforge.operators.contract import Contract
from tallyforge.operators.quality import evaluation_metrics
from tallyforge.operators.ranks import range_count

log = logging.getLogger(__name__)

# Metrics and the direction that is better, names of models, and the search space.
METRICS = {"mean_squared_error": "minimize", "root_mean_squared_error": "minimize",
           "root_mean_squared_log_error": "minimize", "r2_score": "maximize"}
MODELS = ("ridge", "random_forest", "gradient_boosting", "xgboost")
SPACE = {
    "ridge": {"alpha": ("log", 1e-4, 100.0)},
    "random_forest": {"n_estimators": ("step", 100, 500, 50), "max_depth": ("step", 3, 20, 1),
                      "min_samples_leaf": ("step", 1, 10, 1), "max_features": ("real", 0.5, 1.0)},
    "gradient_boosting": {"n_estimators": ("step", 50, 300, 25), "learning_rate": ("log", 0.01, 0.3),
                          "max_depth": ("step", 2, 8, 1), "subsample": ("real", 0.6, 1.0)},
    "xgboost": {"n_estimators": ("step", 100, 600, 50), "max_depth": ("step", 3, 12, 1),
                "learning_rate": ("log", 0.01, 0.3), "subsample": ("real", 0.6, 1.0),
                "colsample_bytree": ("real", 0.6, 1.0)},
}
#: Trees after which a search that is asked to compares trials of one kind and lets the better third go on.
RUNGS = (8, 24, 72)


def sample_trials(n: int, seed: int, model: str | None = None, space: dict[str, Any] | None = None
                  ) -> list[tuple[str, dict[str, Any]]]:
    """A seeded list of (model, parameters) drawn from the search space."""
    space = space or SPACE
    if model is not None and model not in space:
        raise ValueError(f"unsupported model {model!r}, choose from {', '.join(space)}")
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        name = model or str(rng.choice(list(space)))
        params = {}
        for p, (kind, lo, hi, *step) in space[name].items():
            if kind == "step":
                params[p] = int(lo + step[0] * rng.integers(0, (hi - lo) // step[0] + 1))
            elif kind == "log":
                params[p] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
            else:
                params[p] = float(rng.uniform(lo, hi))
        out.append((name, params))
    return out


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly: iterative fits read them dozens of times, so one shuffle is worth it whatever the files look like."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, range_count(df)))


def label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return row["n"], row["s"] or 1.0


def boosting_plan(name: str, params: dict[str, Any], seed: int = 42) -> boost.Plan:
    """How `boost` grows the trees of a boosting model; the second name has a leaf penalty of one and draws features for each tree."""
    return boost.Plan(rounds=params.get("n_estimators", 100), learning_rate=params.get("learning_rate", 0.1),
                      max_depth=params.get("max_depth", 3), subsample=params.get("subsample", 1.0),
                      columns=params.get("colsample_bytree", 1.0), penalty=1.0 if name == "xgboost" else 0.0, seed=seed)


def regressor(name: str, params: dict[str, Any], features: str, label: str, stats: tuple[int, float], seed: int = 42,
              validation: str | None = None):
    """Estimator for a model name.

    Ridge's penalty is stated for the sum of squares; Spark's is per row and in units of the
    label's deviation. It is solved from the sums of one pass. `validation` names a boolean column of the rows that boosted trees
    stop by; other models take no notice of it.
    """
    if name == "ridge":
        n, std = stats
        return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=0.0, standardization=False,
                                solver="normal", regParam=params.get("alpha", 1.0) / n * std)
    if name == "random_forest":
        share = params.get("max_features", 1.0)
        return forest.random_forest(features, label, forest.ForestPlan(
            trees=params.get("n_estimators", 100), max_depth=params.get("max_depth", 5), columns=min(share, 1.0),
            min_rows=params.get("min_samples_leaf", 1), seed=seed))
    if name == "xgboost":
        return boost.BoostedTrees(featuresCol=features, labelCol=label, validationIndicatorCol=validation or "",
                                  plan=json.dumps(asdict(boosting_plan(name, params, seed))))
    if name == "gradient_boosting":
        if params.get("subsample", 1.0) >= 1:  # rows drawn for each tree cannot be pooled
            return pooled.PooledBoosting(featuresCol=features, labelCol=label, validationIndicatorCol=validation or "", plan=json.dumps({
                "rounds": params.get("n_estimators", 100), "learning_rate": params.get("learning_rate", 0.1),
                "max_depth": params.get("max_depth", 3), "seed": seed}))
        stop = {"validationIndicatorCol": validation} if validation else {}
        return GBTRegressor(**stop, featuresCol=features, labelCol=label, seed=seed, maxIter=params.get("n_estimators", 100),
                            stepSize=params.get("learning_rate", 0.1), maxDepth=params.get("max_depth", 3),
                            subsamplingRate=params.get("subsample", 1.0))
    raise ValueError(f"unsupported model {name!r}, choose from {', '.join(MODELS)}")


@dataclass
class Search:
    """Outcome of a search: one row per trial and metric, and the best model per metric."""
    trials: DataFrame
    best: dict[str, Any] = field(default_factory=dict)


@dataclass
class Trial:
    """A drawn model while the search runs; `parts` are fitted forests with their numbers of trees."""
    number: int
    name: str
    params: dict[str, Any]
    state: str = "RUNNING"
    model: Any = None
    growing: boost.Growing | None = None
    parts: list[tuple[Any, int]] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)

    @property
    def trees(self) -> int:
        return sum(n for _, n in self.parts)


def mean_forest(parts: Sequence[tuple[Any, int]]) -> Any:
    """One model of several forests, each weighted by its trees; it is saved and loaded like any pipeline."""
    if len(parts) == 1:
        return parts[0][0]
    total, stages = sum(n for _, n in parts), []
    for i, (part, _) in enumerate(parts):
        own = part.copy()
        stages.append(own.setPredictionCol(f"__part{i}"))
    mean = " + ".join(f"__part{i} * {n / total!r}D" for i, (_, n) in enumerate(parts))
    hidden = ", ".join(f"__part{i}" for i in range(len(parts)))
    return PipelineModel([*stages, SQLTransformer(statement=f"SELECT * EXCEPT ({hidden}), {mean} AS prediction FROM __THIS__")])


def cancelled(error: Exception) -> bool:
    """A job that was stopped from outside is no failed fit."""
    return "cancel" in str(error).lower()


def search(spark: SparkSession, train: DataFrame, val: DataFrame, label: str, *, features: str = "features",
           n_trials: int = 4, seed: int = 42, metrics: Sequence[str] = ("root_mean_squared_error",),
           model: str | None = None, space: dict[str, Any] | None = None, parallelism: int = 2, rungs: Sequence[int] = (),
           run_id: str = "run", own_metrics: Mapping[str, tuple[str, Callable[[DataFrame, str, str], float]]] | None = None) -> Search:
    """Fit the sampled trials on train, score them on val, keep the best model of each metric.

    Every trial grows all of its trees. Boosted models of all trials grow in step over one table of binned features, forests and others
    beside them. With `rungs` (such as RUNGS) trials of many trees are compared before that: all grow to the first number of trees, of each kind of
    model the better third (by any of the metrics) grows on from there to the next, and those left after the last rung grow to their full size; the
    others end as PRUNED with the score they had. A few trees say little about forests against boosting, so kinds are not compared before the end.
    Forests then take further trees beside the ones they have.

    `own_metrics` maps a name to its direction ("minimize" or "maximize") and a function of the scored rows, the label and the
    prediction column. A trial whose fit or score fails is FAIL, a cancelled job ends the search. It is an error if no trial completes.
    """
    own_metrics = dict(own_metrics or {})
    if any(way not in ("minimize", "maximize") for way, _ in own_metrics.values()):
        raise ValueError("the direction of a metric is 'minimize' or 'maximize'")
    directions = {**{m: METRICS[m] for m in metrics if m in METRICS}, **{m: way for m, (way, _) in own_metrics.items()}}
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unsupported metrics {unknown}, choose from {', '.join(METRICS)}")
    trials = [Trial(i, name, params) for i, (name, params) in enumerate(sample_trials(n_trials, seed, model, space))]
    fit_on = spread(train.select(features, F.col(label).cast("double").alias(label))).persist(StorageLevel.MEMORY_AND_DISK)
    score_on = val.select(features, F.col(label).cast("double").alias(label)).persist(StorageLevel.MEMORY_AND_DISK)
    booster = None

    def failed(trial: Trial, error: Exception) -> None:
        if cancelled(error):
            raise error
        log.error("trial %d (%s) failed: %s", trial.number, trial.name, error)
        trial.state, trial.scores, trial.model = "FAIL", {}, None

    def grow(trial: Trial, trees: int | None) -> None:
        try:
            if trial.name == "random_forest":
                whole = trial.params.get("n_estimators", 100)
                more = min(whole, trees or whole) - trial.trees
                if more > 0:
                    part = regressor(trial.name, {**trial.params, "n_estimators": more}, features, label, stats, seed + trial.trees)
                    trial.parts.append((part.fit(fit_on), more))
                trial.model = mean_forest(trial.parts)
            else:
                trial.model = regressor(trial.name, trial.params, features, label, stats, seed).fit(fit_on)
        except Exception as error:
            failed(trial, error)

    def grow_in_step(some: Sequence[Trial], trees: int | None) -> None:
        booster.advance([t.growing for t in some], trees or max(t.growing.plan.rounds for t in some))

    def model_of(trial: Trial) -> Any:
        # Boosted models take the driver's memory only while they are needed.
        return booster.model(trial.growing) if trial.growing is not None else trial.model

    def judge(trial: Trial) -> None:
        try:
            scored = model_of(trial).transform(score_on)
            row = evaluation_metrics(scored, label, "prediction").first().asDict()
            row.update({m: float(of(scored, label, "prediction")) for m, (_, of) in own_metrics.items()})
            if not all(math.isfinite(row[m]) for m in directions):
                raise ValueError("non-finite score")
            trial.scores = row
        except Exception as error:
            failed(trial, error)

    def badness(trial: Trial, metric: str) -> tuple[float, int]:
        return (trial.scores[metric] if directions[metric] == "minimize" else -trial.scores[metric]), trial.number

    try:
        stats = label_stats(fit_on, label)
        boosted = [t for t in trials if t.name in ("gradient_boosting", "xgboost")]
        if boosted:
            booster = boost.Booster(fit_on, None, features, label)
            for t in boosted:
                t.growing = boost.Growing(t.number, boosting_plan(t.name, t.params, seed))
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for rung in [*rungs, None]:
                live = [t for t in trials if t.state == "RUNNING"]
                in_step = [t for t in live if t.growing is not None]
                jobs = [pool.submit(grow_in_step, in_step, rung)] if in_step else []
                jobs += [pool.submit(grow, t, rung) for t in live if t.growing is None]
                for job in jobs:
                    job.result()
                list(pool.map(judge, [t for t in live if t.state == "RUNNING"]))
                for t in live:
                    whole = t.growing.done if t.growing is not None else t.name != "random_forest" or t.trees == t.params.get("n_estimators", 100)
                    if t.state == "RUNNING" and whole:
                        t.state = "COMPLETE"
                live = [t for t in live if t.state == "RUNNING"]
                for kind in {t.name for t in live} if rung else ():
                    own = [t for t in live if t.name == kind]
                    stay = {t.number for m in directions for t in sorted(own, key=lambda t: badness(t, m))[:math.ceil(len(own) / 3)]}
                    for t in own:
                        if t.number not in stay:
                            t.state, t.parts, t.growing = "PRUNED", [], None
    finally:
        fit_on.unpersist()
        score_on.unpersist()
        if booster is not None:
            booster.close()
    complete = [t for t in trials if t.state == "COMPLETE"]
    if not complete:
        raise RuntimeError(f"none of {n_trials} trials completed")
    best = {m: model_of(min(complete, key=lambda t: badness(t, m))) for m in directions}
    rows = [(run_id, t.number, t.name, str(t.params), t.state, m, way, t.scores.get(m)) for t in trials for m, way in directions.items()]
    table = spark.createDataFrame(rows, "run_id string, trial int, model_type string, params string, state string, "
                                        "metric string, direction string, score double")
    return Search(table, best)


def best_trials(trials: DataFrame) -> DataFrame:
    """Per run and metric: direction, best score, its model and parameters, and trial counts."""
    # one sign for both directions: the smallest `badness` wins
    ok = trials.withColumn("badness", F.when(F.col("state") == "COMPLETE", F.when(
        F.col("direction") == "minimize", F.col("score")).otherwise(-F.col("score"))))
    return ok.groupBy("run_id", "metric", "direction").agg(
        F.min_by("score", "badness").alias("best_score"), F.min_by("model_type", "badness").alias("model_type"),
        F.min_by("params", "badness").alias("best_params"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("state") == "COMPLETE").alias("completed"), F.count_if(F.col("state") == "PRUNED").alias("pruned"),
        F.count_if(F.col("state") == "FAIL").alias("failed"))


def fit_pipeline(train: DataFrame, preprocessor, name: str, params: dict[str, Any], label: str, seed: int = 42) -> PipelineModel:
    """Preprocessor and model as one pipeline that takes raw rows."""
    features = preprocessor.getOrDefault("outputCol")
    # Dealt once: the passes of the preprocessor and of the model would each shuffle the rows again.
    train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = regressor(name, params, features, label, label_stats(train, label), seed)
        return Pipeline(stages=[preprocessor, model]).fit(train)
    finally:
        train.unpersist()


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Predictions of the rows that keep the contract; a prediction that is not finite is dropped with its row."""
    rows = contract.drop_invalid(df) if contract else df
    return model.transform(rows).where(is_finite(F.col("prediction")))
