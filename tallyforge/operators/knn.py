"""Exact nearest-neighbour imputation without comparing all rows.

Donors are cut into boxes level by level: grouped quantiles of every box find its cuts, in Spark, and the cuts and the
boxes' bounds stay tables. Every row to fill searches its own box first; the distance of its k-th donor then tells which
other boxes can still hold a nearer one, and only those are searched, walking down from the whole table through joins of
boxes with their parts. A row whose own box holds fewer than k donors takes the furthest corner of the smallest box
around it that holds k. Equal rows to fill are searched once, of equal donors only the first k can matter, and both the
rows and the donors of a crowded box are shared out over several tasks, whose best k are merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import is_missing, quoted
from tallyforge.session import checkpoint_root

BOX_ROWS = 4_000
FAN_OUT = 16
CELLS_AT_ONCE = 4_000_000
SENT_ROWS = 10_000  # tables of up to this many combos or boxes are broadcast; longer ones have keys enough to meet by shuffle
HITS = "combo int, qid string, d2 double, donor string, y double"
NO_HITS = pd.DataFrame({"combo": pd.Series(dtype="int32"), "qid": pd.Series(dtype=object), "d2": pd.Series(dtype=float),
                        "donor": pd.Series(dtype=object), "y": pd.Series(dtype=float)})


@dataclass(frozen=True)
class Combo:
    """Rows that miss `target` and know `known`, against donors of one pattern; `shared` are their common features."""
    target: str
    pattern: int
    donor_pattern: int
    shared: tuple[str, ...]


def knn_impute(df: DataFrame, donors: DataFrame, features: Sequence[str], donor_key: str, k: int = 5,
               weights: str = "uniform", box_rows: int = BOX_ROWS) -> DataFrame:
    """Fill the missing `features` of df from the k nearest donors that know the feature.

    Squared distance is (features / shared features) x sum of squared gaps over the features
    both rows know. Equal distances go by the donor key's text. With weights="distance" donors
    count by inverse distance, and donors at distance zero exclude all others. A feature that
    no donor shares anything with takes the donors' mean.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError(f"weights must be 'uniform' or 'distance', not {weights!r}")
    features = list(features)
    checkpoint_root(df.sparkSession)
    typed = df.withColumns({f: F.when(~is_missing(df, f), F.col(quoted(f)).cast("double")) for f in features})
    typed = typed.withColumn("__pattern", _pattern(features))
    known = donors.select(F.col(quoted(donor_key)).cast("string").alias("donor"),
                          *[F.when(~is_missing(donors, f), F.col(quoted(f)).cast("double")).alias(f) for f in features])
    known = known.withColumn("__pattern", _pattern(features))
    full = 2 ** len(features) - 1
    have = [r[0] for r in typed.where(F.col("__pattern") != full).select("__pattern").distinct().collect()]
    given = [r[0] for r in known.select("__pattern").distinct().collect()]
    if not have:
        return typed.drop("__pattern")
    means = known.agg(*[F.avg(f).alias(f) for f in features]).first()
    combos = _combos(features, have, given)
    out = typed
    if combos:
        filled = _fill(typed, known, combos, features, k, weights, box_rows)
        out = out.withColumn("__qid", _qid(features))
        for f in features:
            mine = filled.where(F.col("target") == f).select(F.col("qid").alias("__qid"), F.col("y").alias("__y"))
            missing = F.when(F.col(quoted(f)).isNull(), F.col("__qid"))
            if any(c.target == f for c in combos):
                out = (out.withColumn("__q", missing).join(mine.withColumnRenamed("__qid", "__q"), "__q", "left")
                       .withColumn(f, F.coalesce(F.col(quoted(f)), F.col("__y"))).drop("__q", "__y"))
        out = out.drop("__qid")
    return (out.withColumns({f: F.coalesce(F.col(quoted(f)), F.lit(means[f])) for f in features if means[f] is not None})
            .select(*df.columns))


def _pattern(features: list[str]):
    bits = F.lit(0)
    for i, f in enumerate(features):
        bits = bits + F.when(F.col(quoted(f)).isNotNull(), 2 ** i).otherwise(0)
    return bits


def _qid(features: list[str]):
    """Text of the original feature vector; equal vectors share one search."""
    return F.concat_ws("|", *[F.coalesce(F.col(quoted(f)).cast("string"), F.lit("")) for f in features])


def _combos(features: list[str], have: list[int], given: list[int]) -> list[Combo]:
    out = []
    for q in sorted(have):
        for i, f in enumerate(features):
            if q >> i & 1:
                continue
            for d in sorted(given):
                shared = tuple(g for j, g in enumerate(features) if (q & d) >> j & 1)
                if d >> i & 1 and shared:
                    out.append(Combo(f, q, d, shared))
    return out


def _sent(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= SENT_ROWS else table


def _combo_table(spark, combos: list[Combo], features: list[str]) -> DataFrame:
    """One row per combo: which rows and donors it joins, the places of their common features, the scale of its distances."""
    rows = [(i, c.pattern, c.donor_pattern, c.target, [features.index(s) for s in c.shared], len(features) / len(c.shared))
            for i, c in enumerate(combos)]
    table = spark.createDataFrame(rows, "combo int, pattern int, donor_pattern int, target string, shared array<int>, scale double")
    return _sent(table, len(rows))


def _points(df: DataFrame, combos: DataFrame, which: str, features: list[str], *extra: Column) -> DataFrame:
    """One row per (row, combo) with the coordinates both sides know."""
    known = df.select("__pattern", F.array(*[F.col(quoted(f)) for f in features]).alias("__all"), *extra)
    value = F.element_at(F.create_map(*[v for i, f in enumerate(features) for v in (F.lit(f), F.get("__all", i))]), F.col("target"))
    return known.join(combos, F.col("__pattern") == F.col(which)).select(
        "combo", F.transform("shared", lambda i: F.get("__all", i)).alias("x"), value.alias("y"),
        *[c for c in known.columns if not c.startswith("__")])


def _fill(typed, known, combos, features, k, weights, box_rows):
    combos = _combo_table(typed.sparkSession, combos, features)
    scales = combos.select("combo", "scale")
    queries = (_points(typed, combos, "pattern", features, _qid(features).alias("qid"))
               .groupBy("combo", "qid").agg(F.any_value("x").alias("x")))
    first = Window.partitionBy("combo", "x").orderBy("donor")
    pool = (_points(known, combos, "donor_pattern", features, F.col("donor"))
            .withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= k).drop("__n")).checkpoint()
    placed, levels = _boxes(pool, box_rows)
    own = _own_box(queries, levels).checkpoint()
    near = _search(own, placed, scales, k, box_rows).checkpoint()
    asked = _limits(own, near, levels, scales, k)
    best = reduce(DataFrame.unionByName, [near] + [_search(o, placed, scales, k, box_rows) for o in _others(asked, levels)])
    slots = combos.select("combo", F.concat_ws("|", "pattern", "target").alias("slot"))
    order = Window.partitionBy("slot", "qid").orderBy("d2", "donor")
    top = best.join(slots, "combo").withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k)
    y = F.avg("y")
    if weights == "distance":
        inverse = F.when(F.col("d2") > 0, 1 / F.sqrt("d2"))
        y = F.coalesce(F.avg(F.when(F.col("d2") == 0, F.col("y"))),
                       F.sum(F.col("y") * inverse) / F.sum(inverse))
    return (top.groupBy("slot", "qid").agg(y.alias("y"))
            .select(F.substring_index("slot", "|", -1).alias("target"), "qid", "y"))


def _box_table(donors: DataFrame, box_rows: int) -> DataFrame:
    """Every box with its rows, bounds, and the feature and values it is cut at (null: it stays whole).

    A box is cut at its quantiles into as many parts as it holds `box_rows`, 16 at most, along the feature that offers
    the most different quantiles, the widest of those. Cuts lie below the largest value, so no part is empty; a box whose
    quantiles agree in every feature holds nearly equal donors and stays whole.
    """
    probs = [i / FAN_OUT for i in range(1, FAN_OUT)]
    sides = (donors.select("combo", "node", F.posexplode("x").alias("dim", "v")).groupBy("combo", "node", "dim")
             .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                  F.percentile_approx("v", probs).alias("q")))
    parts = F.least(F.lit(FAN_OUT), F.ceil(F.col("n") / box_rows)).cast("int")
    # the cuts between equal parts, below the top; where a value repeats, the next lower quantile cuts instead
    below = F.array_distinct(F.filter("q", lambda c: c < F.col("hi")))
    wanted = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda j: F.element_at("q", F.round(j * FAN_OUT / F.col("parts")).cast("int")))
    cuts = F.when(F.size(F.array_distinct("q")) > 1, F.array_distinct(F.transform(
        wanted, lambda w: F.coalesce(F.array_max(F.filter(F.col("below"), lambda c: c <= w)), F.get("below", 0)))))
    sides = sides.withColumn("parts", parts).withColumn("below", below).withColumn("cuts", F.when(F.col("parts") > 1, cuts))
    offer = F.when(F.col("cuts").isNotNull(), F.struct(
        F.size("cuts").alias("many"), (F.col("hi") - F.col("lo")).alias("width"), (-F.col("dim")).alias("order"), "cuts"))
    return (sides.groupBy("combo", "node")
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", "lo", "hi"))).alias("bounds"), F.max(offer).alias("offer"))
            .select("combo", "node", "n", "bounds", (-F.col("offer.order")).alias("dim"), F.col("offer.cuts").alias("cuts")))


def _part(node: Column) -> Column:
    """The box a point moves into: one hexadecimal digit per level says which part."""
    return F.concat(node, F.lower(F.hex(F.size(F.filter("cuts", lambda c: c < F.get("x", F.col("dim")))))))


def _boxes(pool: DataFrame, box_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Donors with their final box, and one table of boxes per level; the driver learns only whether a level has cuts."""
    open_rows, whole, levels = pool.withColumn("node", F.lit("")), [], []
    while True:
        boxes = _box_table(open_rows, box_rows).checkpoint()
        levels.append(_sent(boxes, boxes.count()))
        if boxes.where(F.col("cuts").isNotNull()).isEmpty():
            return reduce(DataFrame.unionByName, [*whole, open_rows]), levels
        moved = open_rows.join(levels[-1].select("combo", "node", "dim", "cuts"), ["combo", "node"]).select(
            *pool.columns, F.coalesce(_part(F.col("node")), F.col("node")).alias("node"), F.col("cuts").isNull().alias("__whole")).checkpoint()
        whole.append(moved.where("__whole").drop("__whole"))
        open_rows = moved.where(~F.col("__whole")).drop("__whole")


def _own_box(queries: DataFrame, levels: list[DataFrame]) -> DataFrame:
    at = queries.withColumn("node", F.lit(""))
    for boxes in levels[:-1]:
        cut = boxes.where(F.col("cuts").isNotNull()).select("combo", "node", "dim", "cuts")
        at = at.join(cut, ["combo", "node"], "left").select(
            *queries.columns, F.coalesce(_part(F.col("node")), F.col("node")).alias("node"))
    return at


def _gap(x: str, bounds: str, nearest: bool) -> Column:
    """Squared distance to the nearest point of a box, or to its furthest corner."""
    def side(v: Column, b: Column) -> Column:
        return F.greatest(b["lo"] - v, v - b["hi"], F.lit(0.0)) if nearest else F.greatest(v - b["lo"], b["hi"] - v)
    return F.aggregate(F.zip_with(x, bounds, lambda v, b: side(v, b) * side(v, b)), F.lit(0.0), lambda total, g: total + g)


def _limits(own: DataFrame, near: DataFrame, levels: list[DataFrame], scales: DataFrame, k: int) -> DataFrame:
    """Rows with the distance beyond which no donor can matter: of their k-th hit, else of a box that holds k donors for sure."""
    reach = near.withColumn("__n", F.row_number().over(Window.partitionBy("combo", "qid").orderBy("d2"))).where(F.col("__n") <= k)
    reach = reach.groupBy("combo", "qid").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2"))
    asked = own.join(scales, "combo").join(reach, ["combo", "qid"], "left").select(
        "combo", "qid", "x", "scale", F.col("node").alias("own"), F.when(F.col("n") >= k, F.col("d2")).alias("limit"))
    around = reduce(DataFrame.unionByName, levels).where(F.col("n") >= k).select("combo", "node", "bounds")
    short = (asked.where(F.col("limit").isNull())
             .select("combo", "qid", "x", "scale", F.explode(F.transform(
                 F.sequence(F.lit(0), F.length("own")), lambda i: F.substring(F.col("own"), F.lit(1), i))).alias("node"))
             .join(around, ["combo", "node"])
             .groupBy("combo", "qid").agg(F.min(_gap("x", "bounds", False) * F.col("scale")).alias("corner")))
    return asked.join(short, ["combo", "qid"], "left").withColumn(
        "limit", F.coalesce("limit", "corner", F.lit(float("inf"))) * (1 + 1e-9)).drop("corner")


def _others(asked: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """A row per other box that can still hold a nearer donor: one table, none where the whole table is one box."""
    at, found = asked.withColumn("node", F.lit("")), []
    for boxes in levels[1:]:
        parts = boxes.select("combo", F.expr("left(node, length(node) - 1)").alias("node"), F.col("node").alias("part"), "bounds",
                             F.col("cuts").isNull().alias("whole"))
        at = (at.join(parts, ["combo", "node"]).where(_gap("x", "bounds", True) * F.col("scale") <= F.col("limit"))
              .select(*asked.columns, F.col("part").alias("node"), "whole")).checkpoint()
        found.append(at.where(F.col("whole") & (F.col("node") != F.col("own"))).select("combo", "qid", "x", "node"))
        at = at.where(~F.col("whole")).drop("whole")
    return [reduce(DataFrame.unionByName, found)] if found else []


def _search(queries: DataFrame, pool: DataFrame, scales: DataFrame, k: int, box_rows: int) -> DataFrame:
    """The k nearest donors of each query in every share of its box; nothing more leaves a task.

    A box of many queries or many donors (near-equal ones that no cut divides) is dealt out by both: every share of the
    queries meets every share of the donors, and who merges the hits takes the best k of all shares.
    """
    def shares(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("combo", "node").agg(F.ceil(F.count(F.lit(1)) / box_rows).cast("int").alias(name))
    loads = shares(queries, "q_shares").join(shares(pool, "d_shares"), ["combo", "node"]).join(scales, "combo")

    def dealt(df: DataFrame, key: str, mine: str, other: str, columns: list[str]) -> DataFrame:
        salt = F.pmod(F.xxhash64(key), F.col(f"{mine}_shares")).cast("int").alias(mine)
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_shares") - 1)).alias(other)
        return df.join(loads, ["combo", "node"]).select("combo", "node", salt, copies, *columns)
    box = ["combo", "node", "q", "d"]
    left = dealt(queries, "qid", "q", "d", ["qid", "x", "scale"])
    right = dealt(pool, "donor", "d", "q", ["donor", "x", "y"])
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table of loads
    # few bytes mean much work here, so the partitions are named and adaptive execution leaves them apart
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.repartition(parts, *box), right.repartition(parts, *box)

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return NO_HITS
        right = right.sort_values("donor", kind="stable")
        q = np.asarray(left["x"].tolist(), dtype=float)
        d = np.asarray(right["x"].tolist(), dtype=float)
        keep, step = min(k, len(d)), max(1, CELLS_AT_ONCE // len(d))
        rows, cols, dist = [], [], []
        for at in range(0, len(q), step):
            gaps = np.zeros((len(q[at:at + step]), len(d)))
            for j in range(q.shape[1]):
                gaps += (q[at:at + step, j, None] - d[None, :, j]) ** 2
            last = np.partition(gaps, keep - 1, axis=1)[:, keep - 1]
            r, c = np.nonzero(gaps <= last[:, None])
            g = gaps[r, c]
            order = np.lexsort((c, g, r))  # columns are in donor order
            r, c, g = r[order], c[order], g[order]
            place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
            rows.append(r[place < keep] + at)
            cols.append(c[place < keep])
            dist.append(g[place < keep])
        r, c = np.concatenate(rows), np.concatenate(cols)
        return pd.DataFrame({"combo": left["combo"].to_numpy()[r], "qid": left["qid"].to_numpy()[r],
                             "d2": np.concatenate(dist) * left["scale"].iloc[0], "donor": right["donor"].to_numpy()[c],
                             "y": right["y"].to_numpy()[c]})
    return left.groupBy(*box).cogroup(right.groupBy(*box)).applyInPandas(nearest, HITS)
