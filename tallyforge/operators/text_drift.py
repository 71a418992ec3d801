"""Drift of what texts say: how well a classifier over hashed terms tells the current texts from the reference."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import quoted
from tallyforge.operators.ranks import running_counts
from tallyforge.operators.text import words
from tallyforge.session import checkpoint_root

# Width of the term vectors, folds of the classifier, resampled labellings and the level they set the threshold at.
BUCKETS, FOLDS, DRAWS, LEVEL = 1 << 14, 2, 60, 0.95


def domain_scores(reference: DataFrame, current: DataFrame, column: str, key: str, buckets: int = BUCKETS, folds: int = FOLDS,
                  seed: int = 42) -> DataFrame:
    """(key, label, fold, score): every text scored by a linear model that was fitted without its fold.

    Label 1 is the current side. Null texts count as empty. Each fold must hold texts of both sides.
    """
    checkpoint_root(reference.sparkSession)
    sides = [df.select(F.col(quoted(key)).cast("string").alias("key"), F.lit(label).alias("label"),
                       words(F.lower(F.coalesce(F.col(quoted(column)), F.lit("")))).alias("words"))
             for label, df in ((0.0, reference), (1.0, current))]
    both = sides[0].unionByName(sides[1]).withColumn("fold", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(folds)).cast("int"))
    terms = (HashingTF(inputCol="words", outputCol="features", numFeatures=buckets, binary=True)
             .transform(both).drop("words").checkpoint())
    scored = []
    for fold in range(folds):
        model = LogisticRegression(maxIter=30, regParam=0.01).fit(terms.where(F.col("fold") != fold))
        margin = vector_to_array("rawPrediction")[1]
        scored.append(model.transform(terms.where(F.col("fold") == fold)).select("key", "label", "fold", margin.alias("score")))
    out = scored[0]
    for part in scored[1:]:
        out = out.unionByName(part)
    return out


def resampled_auc(scored: DataFrame, draws: int = DRAWS, seed: int = 42) -> DataFrame:
    """(draw, roc_auc): the area averaged over folds, for the true labels (draw 0) and for labels dealt anew by hash.

    Ranks do not change with the labels, so all labellings come from one pass over the distinct scores.
    """
    checkpoint_root(scored.sparkSession)
    share = F.col("__share")
    shares = scored.groupBy("fold").agg(F.avg("label").alias("__share"))
    unit = [F.pmod(F.xxhash64("key", F.col("label"), F.lit(seed + b)), F.lit(1 << 30)) / float(1 << 30) for b in range(1, draws + 1)]
    counts = (scored.join(shares, "fold").groupBy("fold", F.col("score").alias("value"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p0"),
                   *[F.count_if(u < share).alias(f"p{b}") for b, u in enumerate(unit, 1)])).checkpoint()
    placed = running_counts(counts, ["fold"], "value", ["n"])
    rank = F.col("n_before") + (F.col("n") + 1) / 2.0
    sums = placed.groupBy("fold").agg(F.max("n_total").alias("n"), F.array(*[F.struct(
        F.lit(b).alias("draw"), F.sum(F.col(f"p{b}") * rank).alias("ranks"), F.sum(f"p{b}").cast("double").alias("p"))
        for b in range(draws + 1)]).alias("all"))
    each = sums.select("n", F.inline("all"))
    area = F.try_divide(F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p")))
    return each.groupBy("draw").agg(F.avg(area).alias("roc_auc"))


def content_drift(reference: DataFrame, current: DataFrame, columns: list[str], key: str, threshold: float | None = None,
                  draws: int = DRAWS, level: float = LEVEL, seed: int = 42) -> DataFrame:
    """(column, roc_auc, threshold, drifted): drift where the area lies above the threshold.

    Without a given threshold it is the `level` quantile of the areas that labels dealt at random reach on the same
    scores. A side without texts gives a null area and no drift.
    """
    out = None
    for column in columns:
        if reference.isEmpty() or current.isEmpty():
            one = reference.sparkSession.range(1).select(F.lit(None).cast("double").alias("roc_auc"), F.lit(threshold).cast("double").alias("threshold"))
        else:
            areas = resampled_auc(domain_scores(reference, current, column, key, seed=seed), draws, seed)
            chance = F.percentile(F.when(F.col("draw") > 0, F.col("roc_auc")), F.lit(level))
            one = areas.agg(F.max(F.when(F.col("draw") == 0, F.col("roc_auc"))).alias("roc_auc"),
                            (chance if threshold is None else F.lit(float(threshold))).alias("threshold"))
        one = one.select(F.lit(column).alias("column"), "*", F.coalesce(F.col("roc_auc") > F.col("threshold"), F.lit(False)).alias("drifted"))
        out = one if out is None else out.unionByName(one)
    return out
