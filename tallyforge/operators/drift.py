"""Distribution drift between a reference and a current table, and the gate built on it."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import is_finite, long_form, quoted, ratio
from tallyforge.functions.pvalues import p_value
from tallyforge.operators.ranks import exact_quantiles, running_counts
from tallyforge.operators.text_drift import content_drift

log = logging.getLogger(__name__)

DISTANCES = ("wasserstein", "jensenshannon", "psi")  # drift when score >= threshold
TESTS = ("ks", "chisquare", "z", "t_test")  # drift when p < threshold
NUMERIC_METHODS = ("wasserstein", "ks", "psi", "t_test")
CATEGORY_METHODS = ("jensenshannon", "psi", "chisquare", "z")
TEXT_METHODS = ("domain",)  # area of a classifier of the two sides; drift above the threshold
# Default limits, share floor of empty bins, smallest scale for normalising.
DISTANCE_LIMIT, ALPHA, DATASET_SHARE = 0.1, 0.05, 0.5
PSI_WARNING, PSI_CRITICAL = 0.10, 0.25
EMPTY_SHARE, SMALLEST_STD = 1e-4, 0.001
PSI_BINS = 10


@dataclass(frozen=True)
class ColumnRoles:
    numerical: Sequence[str] = ()
    categorical: Sequence[str] = ()
    text: Sequence[str] = ()
    datetime: Sequence[str] = ()
    target: str | None = None
    prediction: str | None = None
    id: str | None = None
    task: str | None = None


@dataclass(frozen=True)
class DriftOptions:
    num_method: str = "wasserstein"
    cat_method: str = "jensenshannon"
    num_threshold: float | None = None
    cat_threshold: float | None = None
    per_column_method: dict[str, str] = field(default_factory=dict)
    per_column_threshold: dict[str, float] = field(default_factory=dict)
    selected: Sequence[str] | None = None
    dataset_share: float = DATASET_SHARE
    text_method: str | None = None  # text columns are compared when a method is named
    text_threshold: float | None = None  # none: what random labels reach

    @staticmethod
    def from_config(conf: dict) -> "DriftOptions":
        """Options from a configuration with the blocks numerical, categorical and text (method, threshold) and the maps per column."""
        blocks = {name: conf.get(name) or {} for name in ("numerical", "categorical", "text")}
        return DriftOptions(
            num_method=blocks["numerical"].get("method") or conf.get("default_method") or "wasserstein",
            cat_method=blocks["categorical"].get("method") or "jensenshannon",
            num_threshold=blocks["numerical"].get("threshold"), cat_threshold=blocks["categorical"].get("threshold"),
            per_column_method=dict(conf.get("per_feature_stattest") or {}),
            per_column_threshold=dict(conf.get("per_column_stattest_threshold") or {}),
            selected=list(conf.get("columns_to_check_drift") or ()) or None,
            dataset_share=conf.get("dataset_drift_share", DATASET_SHARE),
            text_method=blocks["text"].get("method"), text_threshold=blocks["text"].get("threshold"))


# --- numeric columns ---------------------------------------------------------------------------

def _two_sided(reference: DataFrame, current: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    """(column, value, r, c): how often each value occurs on either side. Hot values combine map-side."""
    sides = [long_form(df, list(columns), [F.lit(s).alias("side")], cast) for s, df in ((0, reference), (1, current))]
    both = sides[0].unionByName(sides[1]).where(F.col("value").isNotNull())
    if cast == "double":
        both = both.where(~F.isnan("value"))
    return both.groupBy("column", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))


def _column_stats(df: DataFrame, columns: Sequence[str], stats: dict, prefix: str = "") -> DataFrame:
    """One row per column with the given aggregates, from one pass over the table."""
    def clean(c):
        x = F.col(quoted(c)).cast("double")
        return F.when(~F.isnan(x), x)
    one = df.agg(*[fn(clean(c)).alias(f"{s}{i}") for i, c in enumerate(columns) for s, fn in stats.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}{i}").alias(prefix + s) for s in stats])
        for i, c in enumerate(columns)])))


def ecdf_distances(reference: DataFrame, current: DataFrame, columns: Sequence[str], normalize: bool = True) -> DataFrame:
    """Exact Wasserstein-1 distance and Kolmogorov-Smirnov gap of every column in one pass.

    With `normalize` the distance is divided by the reference's population deviation.
    """
    placed = running_counts(_two_sided(reference, current, columns, "double"), ["column"], "value", ["r", "c"])
    gap = F.abs(ratio(F.col("r_before") + F.col("r"), F.col("r_total"))
                - ratio(F.col("c_before") + F.col("c"), F.col("c_total")))
    area = placed.groupBy("column").agg(
        F.sum(gap * (F.coalesce(F.col("next_value"), F.col("value")) - F.col("value"))).alias("distance"),
        F.max(gap).alias("ks"), F.max("r_total").alias("n_reference"), F.max("c_total").alias("n_current"))
    if normalize:
        std = _column_stats(reference, columns, {"std": F.stddev_pop})
        area = area.join(F.broadcast(std), "column").withColumn(
            "distance", F.col("distance") / F.greatest("std", F.lit(SMALLEST_STD))).drop("std")
    return area.select("column", F.col("distance").alias("wasserstein"), "ks", "n_reference", "n_current")


def welch_t(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Welch statistic and degrees of freedom per column."""
    stats = {"n": F.count, "mean": F.avg, "var": F.var_samp}
    both = _column_stats(reference, columns, stats, "r_").join(
        F.broadcast(_column_stats(current, columns, stats, "c_")), "column")
    a, b = F.col("r_var") / F.col("r_n"), F.col("c_var") / F.col("c_n")
    return both.select("column", F.try_divide(F.col("r_mean") - F.col("c_mean"), F.sqrt(a + b)).alias("t"),
                       F.try_divide((a + b) * (a + b), a * a / (F.col("r_n") - 1) + b * b / (F.col("c_n") - 1)).alias("dof"))


def quantile_bins(reference: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> dict[str, list[float]]:
    probs = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(reference, list(columns), probs)
    return {c: sorted({v for v in edges[c].values() if v is not None}) for c in columns}


def binned(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Replace numeric columns by the text of their bin number; bin i holds values above edge i-1 up to edge i."""
    def bin_of(c):
        number, x = F.lit(0), F.col(quoted(c)).cast("double")
        for e in edges[c]:
            number = number + (F.when(~F.isnan(x), x) > e).cast("int")
        return number.cast("string").alias(c)
    return df.select(*[bin_of(c) for c in edges])


# --- category columns ----------------------------------------------------------------------------

def category_distances(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance, PSI, chi-square and two-proportion z of every column from one count table.

    Chi-square expects the current counts to follow the reference shares; z compares the share of the
    last category in text order.
    """
    counts = _two_sided(reference, current, columns, "string")
    totals = counts.groupBy("column").agg(F.sum("r").alias("rn"), F.sum("c").alias("cn"),
                                          F.count(F.lit(1)).alias("k"), F.max("value").alias("last"))
    both = counts.join(F.broadcast(totals), "column")
    p, q = ratio(F.col("r"), F.col("rn")), ratio(F.col("c"), F.col("cn"))
    m = (p + q) / 2
    entropy = lambda a: F.when(a > 0, a * F.ln(a / m)).otherwise(0.0)
    pf = F.when(p > 0, p).otherwise(EMPTY_SHARE)
    qf = F.when(q > 0, q).otherwise(EMPTY_SHARE)
    expected = p * F.col("cn")
    chi = F.when(expected > 0, (F.col("c") - expected) * (F.col("c") - expected) / expected).otherwise(
        F.when(F.col("c") > 0, F.lit(float("inf"))).otherwise(0.0))
    last = F.col("value") == F.col("last")
    one = both.groupBy("column").agg(
        F.sum((entropy(p) + entropy(q)) / 2).alias("jsd"), F.sum((qf - pf) * F.ln(qf / pf)).alias("psi"),
        F.sum(chi).alias("chisquare"), F.max("k").alias("k"), F.max("rn").alias("n_reference"),
        F.max("cn").alias("n_current"), F.max(F.when(last, F.col("r"))).alias("lr"),
        F.max(F.when(last, F.col("c"))).alias("lc"))
    pr, pc = ratio(F.col("lr"), F.col("n_reference")), ratio(F.col("lc"), F.col("n_current"))
    pool = ratio(F.col("lr") + F.col("lc"), F.col("n_reference") + F.col("n_current"))
    z = F.try_divide(pr - pc, F.sqrt(pool * (1 - pool) * (ratio(F.lit(1), F.col("n_reference"))
                                                          + ratio(F.lit(1), F.col("n_current")))))
    return one.select("column", F.sqrt(F.greatest("jsd", F.lit(0.0))).alias("jensenshannon"), "psi", "chisquare",
                      (F.col("k") - 1).alias("dof"), z.alias("z"), "n_reference", "n_current")


def psi_level(psi: Column) -> Column:
    return F.when(psi >= PSI_CRITICAL, "critical").when(psi >= PSI_WARNING, "warning").otherwise("ok")


# --- per-column methods and the table verdict --------------------------------------------------------

def plan_columns(reference: DataFrame, current: DataFrame, roles: ColumnRoles, options: DriftOptions
                 ) -> dict[str, tuple[str, str, float]]:
    """column -> (kind, method, threshold). Options that name a column nobody has are an error."""
    shared = set(reference.columns) & set(current.columns)
    numeric, category = list(roles.numerical), list(roles.categorical)
    for role in ("target", "prediction"):
        name = getattr(roles, role)
        if name and name not in shared:
            log.warning("%s column %s is not in both tables, it is left out", role, name)
        elif name and name not in numeric and (role == "target" or roles.task == "regression"):
            numeric.append(name)
    absent = sorted((set(numeric) | set(category)) - shared)
    if absent:
        log.warning("columns %s are not in both tables, they are left out", absent)
    kinds = {c: "num" for c in numeric if c in shared} | {c: "cat" for c in category if c in shared}
    if options.text_method:
        kinds |= {c: "text" for c in roles.text if c in shared}
    asked = set(options.per_column_method) | set(options.per_column_threshold) | set(options.selected or ())
    unknown = sorted(asked - set(kinds))
    if unknown:
        raise ValueError(f"drift options name unknown columns: {unknown}")
    plan = {}
    for c, kind in kinds.items():
        if options.selected and c not in options.selected:
            continue
        usual, limit, methods = {"num": (options.num_method, options.num_threshold, NUMERIC_METHODS),
                                 "cat": (options.cat_method, options.cat_threshold, CATEGORY_METHODS),
                                 "text": (options.text_method, options.text_threshold, TEXT_METHODS)}[kind]
        method = options.per_column_method.get(c, usual)
        if method not in methods:
            raise ValueError(f"method {method!r} does not apply to the {kind} column {c!r}")
        if kind != "text" and (c in options.per_column_method or limit is None):
            limit = DISTANCE_LIMIT if method in DISTANCES else ALPHA
        plan[c] = (kind, method, options.per_column_threshold.get(c, limit))
    return plan


def value_drift(reference: DataFrame, current: DataFrame, roles: ColumnRoles,
                options: DriftOptions | None = None) -> DataFrame:
    """(column, kind, method, score, threshold, drifted); columns of one method family share a pass."""
    plan = plan_columns(reference, current, roles, options or DriftOptions())
    by = lambda kind, *methods: [c for c, (k, m, _) in plan.items() if k == kind and m in methods]
    parts = []

    def add(scores: DataFrame, columns: list[str], stat: dict[str, Column], parameter: Column | None = None):
        chosen = F.create_map(*[F.lit(x) for c in columns for x in (c, plan[c][1])])[F.col("column")]
        score = F.coalesce(*[F.when(chosen == m, v) for m, v in stat.items()])
        parts.append(scores.select("column", chosen.alias("method"), score.alias("stat"),
                                   (F.lit(0.0) if parameter is None else parameter.cast("double")).alias("parameter")))

    ecdf = by("num", "wasserstein", "ks")
    if ecdf:
        n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
        add(ecdf_distances(reference, current, ecdf), ecdf,
            {"wasserstein": F.col("wasserstein"), "ks": F.col("ks")}, F.sqrt(n * m / (n + m)))
    means = by("num", "t_test")
    if means:
        add(welch_t(reference, current, means), means, {"t_test": F.col("t")}, F.col("dof"))
    bins = by("num", "psi")
    if bins:
        edges = quantile_bins(reference, bins)
        add(category_distances(binned(reference, edges), binned(current, edges), bins), bins, {"psi": F.col("psi")})
    cats = by("cat", *CATEGORY_METHODS)
    if cats:
        add(category_distances(reference, current, cats), cats,
            {m: F.col(m) for m in CATEGORY_METHODS}, F.col("dof"))
    texts = by("text", "domain")
    if texts and roles.id is None:
        raise ValueError("text columns are compared by the rows' key: name it as role id")
    judged = [content_drift(reference, current, [c], roles.id, plan[c][2]).select(
        "column", F.lit("text").alias("kind"), F.lit("domain").alias("method"), F.col("roc_auc").alias("score"), "threshold", "drifted")
        for c in texts]
    if not parts and not judged:
        raise ValueError("no column to compare")
    if not parts:
        return reduce(DataFrame.unionByName, judged)
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    per = lambda i: F.create_map(*[F.lit(x) for c, v in plan.items() for x in (c, v[i])])[F.col("column")]
    is_test = F.col("method").isin(*TESTS)
    score = F.col("stat")
    if any(m in TESTS for _, m, _ in plan.values()):
        # KS passes its scale to the tail; distances skip the tail altogether.
        tail = F.when(is_test, F.col("method")).otherwise("z")
        score = F.when(is_test, p_value(tail, F.col("stat"), F.col("parameter"))).otherwise(F.col("stat"))
    scored = scores.select("column", per(0).alias("kind"), "method", score.alias("score"),
                           per(2).cast("double").alias("threshold"))
    drifted = F.when(is_test, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    return reduce(DataFrame.unionByName, judged, scored.withColumn("drifted", F.coalesce(drifted, F.lit(False))))


def dataset_drift(scores: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """Number and share of drifted columns; a share of `share` or more is dataset drift."""
    if not 0 <= share <= 1:
        raise ValueError("the drift share must lie between 0 and 1")
    one = scores.agg(F.count(F.lit(1)).alias("number_of_columns"), F.count_if("drifted").alias("number_of_drifted_columns"))
    found = F.coalesce(ratio(F.col("number_of_drifted_columns"), F.col("number_of_columns")), F.lit(0.0))
    return one.select("*", found.alias("drift_share"), F.lit(float(share)).alias("threshold"),
                      (found >= share).alias("dataset_drift"))


def gate(validation: DataFrame, drift_summary: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """One row that says whether data may go on; anything missing or out of range closes the gate.

    `validation` is the split gate's table, `drift_summary` holds exactly one dataset verdict.
    """
    checks = validation.agg(
        *[F.count_if((F.col("split") == s) & (F.col("status") == "PASSED") & (F.col("error_count") == 0)
                     & (F.col("overall_status") == "PASSED")).alias(f"s{i}") for i, s in enumerate(splits)],
        F.count_if((F.col("status") != "PASSED") | (F.col("error_count") != 0)).alias("failed"))
    passed = F.col("failed") == 0
    for i, _ in enumerate(splits):
        passed = passed & (F.col(f"s{i}") == 1)
    share, limit = F.col("drift_share"), F.col("threshold")
    sound = is_finite(share) & is_finite(limit) & share.between(0, 1) & limit.between(0, 1)
    drift = drift_summary.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(sound & (share < limit), F.lit(False))).alias("calm"),
        F.max(share).alias("drift_share"))
    left = checks.select(F.lit(0).alias("k"), passed.alias("validation_passed"))
    right = drift.select(F.lit(0).alias("k"), ((F.col("n") == 1) & (F.col("calm") == 1)).alias("drift_passed"), "drift_share")
    return left.join(right, "k").select("validation_passed", "drift_passed", "drift_share",
                                        (F.col("validation_passed") & F.col("drift_passed")).alias("passed"))


# --- embeddings ---------------------------------------------------------------------------------------

def embedding_width(df: DataFrame, column: str) -> int:
    return df.agg(F.max(F.size(column))).first()[0]


def _spread(df: DataFrame, column: str, width: int) -> DataFrame:
    return df.select(*[F.get(column, i).cast("double").alias(f"d{i}") for i in range(width)])


def embedding_distance(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Euclidean and cosine distance of the two centroids; one aggregate per side, no exploded rows."""
    width = embedding_width(reference, column)
    sides = []
    for name, df in (("r", reference), ("c", current)):
        means = _spread(df, column, width).agg(*[F.avg(f"d{i}").alias(f"d{i}") for i in range(width)])
        sides.append(means.select(F.lit(0).alias("k"), F.array(*[f"d{i}" for i in range(width)]).alias(name)))
    both = sides[0].join(sides[1], "k")
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    dot = lambda a, b: total(F.zip_with(a, b, lambda x, y: x * y))
    return both.select(
        F.sqrt(total(F.zip_with("r", "c", lambda x, y: (x - y) * (x - y)))).alias("euclidean"),
        (1 - dot("r", "c") / F.sqrt(dot("r", "r") * dot("c", "c"))).alias("cosine"))


def embedding_drift_ratio(reference: DataFrame, current: DataFrame, column: str, limit: float = DISTANCE_LIMIT,
                          share: float = 0.2) -> DataFrame:
    """Share of dimensions whose normalised Wasserstein distance reaches `limit`; drift above `share`."""
    width = embedding_width(reference, column)
    dims = [f"d{i}" for i in range(width)]
    scores = ecdf_distances(_spread(reference, column, width), _spread(current, column, width), dims)
    one = scores.agg(F.count(F.lit(1)).alias("dimensions"), F.count_if(F.col("wasserstein") >= limit).alias("drifted"))
    return one.select("*", ratio(F.col("drifted"), F.col("dimensions")).alias("drift_ratio"),
                      (ratio(F.col("drifted"), F.col("dimensions")) > share).alias("embedding_drift"))


def embedding_drift_model(reference: DataFrame, current: DataFrame, column: str, key: str, limit: float = 0.55,
                          seed: int = 42) -> DataFrame:
    """ROC-AUC of a linear model that tells the sides apart, fitted on one half and scored on the other."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from tallyforge.operators.quality import roc_auc
    from tallyforge.operators.split import hashed_split
    sides = [df.select(key, F.col(column).cast("array<double>").alias("e"), F.lit(s).alias("label"))
             for s, df in ((0.0, reference), (1.0, current))]
    both = hashed_split(sides[0].unionByName(sides[1]), key, {"train": 0.5, "test": 0.5}, seed)
    train = both.where(F.col("split") == "train").select("label", array_to_vector("e").alias("features"))
    model = LogisticRegression(maxIter=50, regParam=0.01).fit(train)
    # the margin ranks rows as the probability does, and needs no model object inside the tasks
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients])
    margin = F.aggregate(F.zip_with("e", weights, lambda x, w: x * w), F.lit(0.0), lambda total, x: total + x)
    scored = both.where(F.col("split") == "test").select(F.col("label").cast("int").alias("target"), margin.alias("score"))
    return roc_auc(scored, "target", "score").select("roc_auc", (F.col("roc_auc") > limit).alias("embedding_drift"))


def embedding_mmd(reference: DataFrame, current: DataFrame, column: str, features: int = 512, gamma: float | None = None,
                  seed: int = 42, draws: int = 100, alpha: float = ALPHA) -> DataFrame:
    """Squared maximum mean discrepancy under a Gaussian kernel by random Fourier features, and how rare it is by chance.

    Linear in rows, in one pass: every task sums the feature map over its rows and, for each draw, over its rows with
    random signs; the signed sums around each side's mean are what the gap of the means looks like without drift. A row's signs
    come from the hash of the row, so a task that runs again gives the same sums.
    """
    width = embedding_width(reference, column)
    gamma = gamma or 1.0 / width
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2 * gamma), size=(width, features))
    phase = rng.uniform(0, 2 * np.pi, size=features)
    salts = rng.integers(1, 2 ** 63, size=draws, dtype=np.uint64)

    def signs(key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.int64).view(np.uint64)[:, None] ^ salts[None, :]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return 1.0 - 2.0 * (mixed >> np.uint64(63)).astype(float)

    def sums(batches):
        total, weight = np.zeros((draws + 1, features)), np.zeros(draws + 1)
        for b in batches:
            for at in range(0, len(b), 2048):
                part = b.iloc[at:at + 2048]
                mapped = np.cos(np.asarray(part["e"].tolist(), dtype=float) @ weights + phase)
                sign = np.hstack([np.ones((len(part), 1)), signs(part["key"].to_numpy())])
                total += sign.T @ mapped
                weight += sign.sum(axis=0)
        yield pd.DataFrame({"draw": np.arange(draws + 1), "weight": weight, "total": list(total)})
    sides = [df.select(F.col(column).cast("array<double>").alias("e"), F.xxhash64(*[F.col(quoted(c)) for c in df.columns]).alias("key"))
             .mapInPandas(sums, "draw int, weight double, total array<double>")
             .select("draw", F.lit(name).alias("side"), "weight", F.posexplode("total").alias("dim", "total"))
             for name, df in (("r", reference), ("c", current))]
    of = lambda side, value: F.sum(F.when(F.col("side") == side, F.col(value)))
    summed = sides[0].unionByName(sides[1]).groupBy("dim", "draw").agg(
        of("r", "total").alias("r"), of("r", "weight").alias("rw"), of("c", "total").alias("c"), of("c", "weight").alias("cw"))
    per_dim = summed.groupBy("dim").agg(F.collect_list(F.struct("draw", "r", "rw", "c", "cw")).alias("all"))
    true = F.filter("all", lambda s: s["draw"] == 0)[0]

    def side_gap(s: Column, value: str, weight: str) -> Column:
        mean = true[value] / true[weight]
        return F.when(s["draw"] == 0, mean).otherwise((s[value] - s[weight] * mean) / true[weight])
    gaps = per_dim.select(F.inline(F.transform("all", lambda s: F.struct(
        s["draw"].alias("draw"), (side_gap(s, "r", "rw") - side_gap(s, "c", "cw")).alias("gap")))))
    stats = gaps.groupBy("draw").agg((F.sum(F.col("gap") * F.col("gap")) * (2.0 / features)).alias("stat"))
    one = stats.agg(F.max(F.when(F.col("draw") == 0, F.col("stat"))).alias("mmd"),
                    F.collect_list(F.when(F.col("draw") > 0, F.col("stat"))).alias("chance"))
    reached = F.size(F.filter("chance", lambda v: v >= F.col("mmd")))
    return one.select("mmd", ((reached + 1) / F.lit(draws + 1.0)).alias("p_value")).withColumn("embedding_drift", F.col("p_value") < alpha)
