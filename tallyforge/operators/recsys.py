"""Quality, diversity and bias of top-k recommendations.

Recommendations are rows (user, item, rank, score) with at most k rows per user, so windows
over a user are bounded by k; everything over items or users is a grouped count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import ratio
from tallyforge.operators.ranks import running_counts


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """Rank (user, item, score) rows per user, ties by item, and keep k."""
    order = Window.partitionBy("user").orderBy(F.col("score").desc(), "item")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranking_quality(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Precision, recall, F, MAP, NDCG, MRR and hit rate at k, averaged over users with relevant items.

    `relevant` holds distinct (user, item). A user without recommendations counts as zero.
    """
    hits = (recs.where(F.col("rank") <= k).select("user", "item", "rank")
            .join(relevant.select("user", "item"), ["user", "item"]))
    so_far = F.row_number().over(Window.partitionBy("user").orderBy("rank"))
    per_hit = hits.select("user", "rank", so_far.alias("nth"))
    per_user = per_hit.groupBy("user").agg(
        F.count(F.lit(1)).alias("hits"), F.sum(ratio(F.col("nth"), F.col("rank"))).alias("precisions"),
        F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("dcg"), F.min("rank").alias("first"))
    users = relevant.groupBy("user").agg(F.count(F.lit(1)).alias("n_relevant")).join(per_user, "user", "left")
    ideal, gains = [], 0.0
    for i in range(1, k + 1):
        gains += 1.0 / math.log2(i + 1)
        ideal.append(F.lit(gains))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    best = F.least(F.col("n_relevant"), F.lit(k)).cast("int")
    hit = zero(F.col("hits").cast("double"))
    p, r = hit / k, hit / F.col("n_relevant")
    return users.agg(
        F.avg(p).alias("precision_at_k"), F.avg(r).alias("recall_at_k"),
        F.avg(zero(F.try_divide(2 * p * r, p + r))).alias("f_at_k"),
        F.avg(zero(F.col("precisions") / best)).alias("map_at_k"),
        F.avg(zero(F.col("dcg") / F.element_at(F.array(*ideal), best))).alias("ndcg_at_k"),
        F.avg(zero(1.0 / F.col("first"))).alias("mrr_at_k"), F.avg((hit > 0).cast("double")).alias("hit_rate_at_k"))


def personalization(recs: DataFrame, k: int) -> DataFrame:
    """One minus the mean overlap of two users' lists, from item counts alone."""
    top = recs.where(F.col("rank") <= k)
    n = F.col("n").cast("double")
    items = top.groupBy("item").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(n * (n - 1)).alias("shared"))
    users = top.agg(F.count_distinct("user").alias("u"))
    u = F.col("u").cast("double")
    return (items.select(F.lit(0).alias("j"), "shared").join(users.select(F.lit(0).alias("j"), "u"), "j")
            .select((1 - F.try_divide(F.col("shared"), u * (u - 1) * k)).alias("personalization")))


def novelty(recs: DataFrame, interactions: DataFrame, k: int) -> DataFrame:
    """Mean surprise, -log2 of the share of training users who met the item, per user and then over users."""
    seen = interactions.select("user", "item").distinct()
    users = seen.agg(F.count_distinct("user").alias("u")).first()["u"]
    item = seen.groupBy("item").agg((-F.log2(F.count(F.lit(1)) / F.lit(float(users)))).alias("surprise"))
    per_user = recs.where(F.col("rank") <= k).join(item, "item").groupBy("user").agg(F.avg("surprise").alias("s"))
    return per_user.agg(F.avg("s").alias("novelty"))


def _unit(features: Sequence[str]) -> list[Column]:
    norm = F.sqrt(sum((F.col(f).cast("double") * F.col(f) for f in features), F.lit(0.0)))
    return [F.try_divide(F.col(f).cast("double"), norm).alias(f"u{i}") for i, f in enumerate(features)]


def diversity(recs: DataFrame, items: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    """Mean cosine distance inside each user's list, averaged over users with two items or more.

    The pair sum comes from the length of the summed unit vectors, so no pairs are formed.
    """
    units = items.select("item", *_unit(features))
    sums = [F.sum(f"u{i}").alias(f"s{i}") for i in range(len(features))]
    per_user = (recs.where(F.col("rank") <= k).join(units, "item").groupBy("user")
                .agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") > 1))
    n = F.col("n").cast("double")
    squared = sum((F.col(f"s{i}") * F.col(f"s{i}") for i in range(len(features))), F.lit(0.0))
    return per_user.agg(F.avg(1 - (squared - n) / (n * (n - 1))).alias("diversity"))


def serendipity(recs: DataFrame, relevant: DataFrame, interactions: DataFrame, items: DataFrame,
                features: Sequence[str], k: int) -> DataFrame:
    """Mean over recommendations of (1 - mean cosine to the user's history), counted for relevant items only."""
    units = items.select("item", *_unit(features))
    width = range(len(features))
    history = (interactions.select("user", "item").distinct().join(units, "item").groupBy("user")
               .agg(*[F.avg(f"u{i}").alias(f"h{i}") for i in width]))
    hit = relevant.select("user", "item", F.lit(1.0).alias("hit"))
    cosine = sum((F.col(f"u{i}") * F.col(f"h{i}") for i in width), F.lit(0.0))
    scored = (recs.where(F.col("rank") <= k).join(units, "item").join(history, "user")
              .join(hit, ["user", "item"], "left"))
    per_user = scored.groupBy("user").agg(F.avg((1 - cosine) * F.coalesce("hit", F.lit(0.0))).alias("s"))
    return per_user.agg(F.avg("s").alias("serendipity"))


def score_entropy(recs: DataFrame, k: int) -> DataFrame:
    """Entropy of each user's scores taken as shares, averaged over users."""
    share = ratio(F.col("score"), F.sum("score").over(Window.partitionBy("user")))
    top = recs.where(F.col("rank") <= k).select("user", share.alias("p"))
    per_user = top.groupBy("user").agg(F.sum(F.when(F.col("p") > 0, -F.col("p") * F.ln("p")).otherwise(0.0)).alias("e"))
    return per_user.agg(F.avg("e").alias("score_entropy"))


def popularity_bias(recs: DataFrame, interactions: DataFrame, k: int) -> DataFrame:
    """Mean popularity of recommended items, share of the catalogue recommended, and Gini of recommendation counts."""
    top = recs.where(F.col("rank") <= k)
    catalogue = interactions.select("user", "item").distinct().groupBy("item").agg(F.count(F.lit(1)).alias("popularity"))
    arp = (top.join(catalogue, "item").groupBy("user").agg(F.avg("popularity").alias("p"))
           .agg(F.avg("p").alias("average_popularity")))
    counted = catalogue.join(top.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "item", "left")
    sizes = (counted.select(F.coalesce("n", F.lit(0)).cast("double").alias("value")).groupBy("value")
             .agg(F.count(F.lit(1)).alias("m")).withColumn("column", F.lit("n")))
    placed = running_counts(sizes, ["column"], "value", ["m"])
    m = F.col("m").cast("double")
    one = placed.agg(F.sum(F.col("value") * (m * F.col("m_before") + m * (m + 1) / 2)).alias("ranked"),
                     F.sum(F.col("value") * m).alias("total"), F.sum(m).alias("items"),
                     F.sum(F.when(F.col("value") > 0, m).otherwise(0.0)).alias("used"))
    gini = 2 * F.col("ranked") / (F.col("items") * F.col("total")) - (F.col("items") + 1) / F.col("items")
    shape = one.select(F.lit(0).alias("j"), (F.col("used") / F.col("items")).alias("coverage"), gini.alias("gini"))
    return arp.select(F.lit(0).alias("j"), "average_popularity").join(shape, "j").drop("j")


def attribute_bias(recs: DataFrame, interactions: DataFrame, attributes: DataFrame, on: str, column: str, k: int) -> DataFrame:
    """Shares of an item or user attribute in the training rows and in the recommendations."""
    sides = []
    for side, df in (("train", interactions), ("recommended", recs.where(F.col("rank") <= k))):
        sides.append(df.select(on).join(attributes.select(on, column), on).groupBy(column)
                     .agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), column, "n"))
    both = sides[0].unionByName(sides[1])
    return both.select("side", column, "n", ratio(F.col("n"), F.sum("n").over(Window.partitionBy("side"))).alias("share"))


def recommendation_cases(recs: DataFrame, k: int, user_ids: Sequence | None = None, interactions: DataFrame | None = None,
                         items: DataFrame | None = None, display_features: Sequence[str] = ()) -> DataFrame:
    """Each user's list in rank order, for the chosen users or for all.

    With `display_features` the named columns of `items` (one row per item) stand beside the list, one entry per rank, empty where
    an item has none. With `interactions` the table also says how many different items the user has met before.
    """
    top = recs.where(F.col("rank") <= k)
    if user_ids is not None:
        top = top.where(F.col("user").isin(list(user_ids)))
    shown = list(display_features)
    if shown:
        top = top.join(items.select("item", *[F.col(c).cast("string").alias(c) for c in shown]), "item", "left")
    listed = F.sort_array(F.collect_list(F.struct("rank", "item", *shown)))  # at most k entries

    def joined(column: str) -> Column:
        return F.array_join(F.transform("list", lambda x: F.coalesce(x[column].cast("string"), F.lit(""))), ",")

    out = top.groupBy("user").agg(listed.alias("list")).select("user", joined("item").alias("items"), *[joined(c).alias(c) for c in shown])
    if interactions is None:
        return out
    met = interactions.groupBy("user").agg(F.count_distinct("item").alias("n_interactions"))
    return out.join(met, "user", "left").withColumn("n_interactions", F.coalesce("n_interactions", F.lit(0)))
