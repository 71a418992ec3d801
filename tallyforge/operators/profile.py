"""Table, numeric, categorical and datetime profiles, and correlation matrices."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import finite_or_null, is_missing, long_form, numeric_columns, quoted, ratio
from tallyforge.operators.ranks import average_ranks, exact_quantiles, range_count, running_counts


def missing_by_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percent of the columns that have nulls; one pass for all columns."""
    return _counted(df, columns or df.columns, lambda c: is_missing(df, c), "missing")


def zero_by_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _counted(df, columns or numeric_columns(df), lambda c: F.col(quoted(c)) == 0, "zero")


def _counted(df, columns, test, name):
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(test(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias(f"n_{name}"),
                              (ratio(F.col(f"c{i}"), F.col("n")) * 100).alias(f"percent_{name}"))
                     for i, c in enumerate(columns)])
    return one.select(F.inline(rows)).where(F.col(f"n_{name}") > 0)


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, fully repeated rows and share of missing cells, in one grouped pass.

    Grouping whole rows combines copies on the map side, so many copies of one row cost one.
    """
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + is_missing(df, c).cast("int")
    width = len(df.columns)
    # Equal rows meet by a digest of 128 bits, so that no whole row is shuffled; the mask tells apart where the nulls are.
    cells = [F.col(quoted(c)) for c in df.columns]
    mask = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    distinct = df.select(F.xxhash64(F.lit(1), mask, *cells).alias("h1"), F.xxhash64(F.lit(2), mask, *cells).alias("h2"),
                         nulls.alias("nulls")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum("nulls").alias("nulls"))
    one = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("kinds"),
                       F.coalesce(F.sum("nulls"), F.lit(0)).alias("missing"))
    return one.select(
        "total_rows", F.lit(width).cast("long").alias("total_columns"),
        (F.col("total_rows") - F.col("kinds")).alias("duplicate_rows_count"),
        ratio(F.col("total_rows") - F.col("kinds"), F.col("total_rows")).alias("duplicate_rows_ratio"),
        ratio(F.col("missing"), F.col("total_rows") * width).alias("missing_cells_ratio"))


def numeric_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per numeric column: null and zero share, range, moments and quartiles.

    Standard deviation is the sample one; skewness and excess kurtosis are bias-corrected.
    `exact=False` takes the quartiles from sketches.
    """
    columns = columns or numeric_columns(df)
    x = F.when(~F.isnan("value"), F.col("value"))
    # long form: the aggregate's code stays small however many columns there are
    per = long_form(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count(x).alias("known"), F.count_if(x == 0).alias("zeros"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std_dev"),
        F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"),
        *([] if exact else [F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias("quartiles")]))
    if exact:
        found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        quartiles = F.create_map(*[v for c in columns for v in (
            F.lit(c), F.array(*[F.lit(found[c][p]).cast("double") for p in (0.25, 0.5, 0.75)]))])[F.col("column")]
    else:
        quartiles = F.col("quartiles")
    n, flat = F.col("known").cast("double"), F.col("std_dev") == 0
    skew = F.when(n >= 3, F.when(flat, 0.0).otherwise(F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)))
    kurt = F.when(n >= 4, F.when(flat, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)))
    return per.select(
        "column", ratio(F.col("rows") - F.col("known"), F.col("rows")).alias("missing_null_ratio"),
        ratio(F.col("zeros"), F.col("rows")).alias("zero_ratio"),
        *[finite_or_null(v).alias(name) for v, name in (
            (F.col("min"), "min"), (F.col("max"), "max"), (F.col("mean"), "mean"),
            (F.get(quartiles, 1), "median_50"), (F.col("std_dev"), "std_dev"),
            (F.get(quartiles, 2) - F.get(quartiles, 0), "iqr_25_75"), (skew, "skewness"), (kurt, "kurtosis"))])


def _category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) over all columns as text, nulls included."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(cells)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null share, distinct values, mode (smallest on a tie) and its frequency; hot values combine map-side."""
    counts = _category_counts(df, columns)
    known = F.col("value").isNotNull()
    best = F.min(F.when(known, F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))))
    return (counts.groupBy("column")
            .agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
                 F.count_if(known).alias("distinct_unique_count"), best.alias("best"))
            .select("column", ratio(F.col("nulls"), F.col("rows")).alias("missing_null_ratio"),
                    "distinct_unique_count", F.col("best.value").alias("mode"), (-F.col("best.neg")).alias("frequency")))


def datetime_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("timestamp_ntz").alias("value"))
                      for c in columns])
    counts = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    best = F.min(F.when(known, F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))))
    return (counts.groupBy("column")
            .agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
                 F.count_if(known).alias("distinct_unique_count"), best.alias("best"),
                 F.min("value").alias("min_date"), F.max("value").alias("max_date"))
            .select("column", ratio(F.col("nulls"), F.col("rows")).alias("missing_null_ratio"),
                    "distinct_unique_count", F.col("best.value").alias("mode"), "min_date", "max_date"))


def almost_constant(df: DataFrame, columns: list[str], share: float = 0.95) -> DataFrame:
    """Share of the most frequent value per column, and whether it reaches `share`."""
    counts = _category_counts(df, columns)
    return (counts.groupBy("column").agg(F.max("n").alias("top"), F.sum("n").alias("rows"))
            .select("column", ratio(F.col("top"), F.col("rows")).alias("top_share"),
                    (ratio(F.col("top"), F.col("rows")) >= share).alias("almost_constant")))


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return list(itertools.combinations(columns, 2))


def pearson_matrix(df: DataFrame, columns: list[str] | None = None, digits: int | None = 4) -> DataFrame:
    """(column_a, column_b, correlation) for every pair, all pairs in one aggregate."""
    columns = columns or numeric_columns(df)
    return _corr_rows(df, [(a, b, F.corr(F.col(quoted(a)).cast("double"), F.col(quoted(b)).cast("double")))
                           for a, b in _pairs(columns)], digits)


def _corr_rows(df, pairs, digits):
    one = df.agg(*[corr.alias(f"r{i}") for i, (_, _, corr) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                     finite_or_null(F.col(f"r{i}") if digits is None else F.round(F.col(f"r{i}"), digits))
                     .alias("correlation")) for i, (a, b, _) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows)))


def spearman_matrix(df: DataFrame, columns: list[str] | None = None, digits: int | None = 4) -> DataFrame:
    """Rank correlation with tied ranks averaged, each pair over the rows where both are known."""
    columns = columns or numeric_columns(df)
    nulls = df.agg(*[F.count_if(is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    full = [c for i, c in enumerate(columns) if nulls[f"c{i}"] == 0]
    parts = []
    if len(full) > 1:
        parts.append(_spearman_complete(df, full, digits))
    for a, b in _pairs(columns):
        if a not in full or b not in full:
            both = df.where(~is_missing(df, a) & ~is_missing(df, b))
            parts.append(_spearman_complete(both, [a, b], digits))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _spearman_complete(df, columns, digits):
    """Ranks of distinct values joined back by value.

    Spark broadcasts the rank table of a column when its measured size allows it; otherwise
    the join is a shuffle whose hot values the adaptive skew join splits.
    """
    ranks = average_ranks(df, columns)
    ranked = df.select(*[F.col(quoted(c)).cast("double").alias(c) for c in columns])
    for i, c in enumerate(columns):
        one = ranks.where(F.col("column") == c).select(F.col("value").alias(c), F.col("avg_rank").alias(f"__r{i}"))
        ranked = ranked.join(one, c)
    at = {c: f"__r{i}" for i, c in enumerate(columns)}
    return _corr_rows(ranked, [(a, b, F.corr(at[a], at[b])) for a, b in _pairs(columns)], digits)


def kendall_matrix(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    out = None
    for a, b in _pairs(columns):
        one = kendall_tau(df, a, b, digits)
        out = one if out is None else out.unionByName(one)
    return out


def _places(cells: DataFrame, name: str) -> DataFrame:
    """Dense 0-based place of every distinct value of a column, and how many values there are."""
    values = cells.groupBy(name).agg(F.lit(1).cast("long").alias("one")).withColumn("column", F.lit(name))
    return running_counts(values, ["column"], name, ["one"]).select(
        name, F.col("one_before").alias(f"{name}r"), F.col("one_total").alias(f"{name}n"))


def kendall_tau(df: DataFrame, a: str, b: str, digits: int | None = 6) -> DataFrame:
    """Exact tau-b without comparing all pairs of rows.

    Two rows with different `a` part at exactly one bit of its dense rank. For every bit the
    rows meet in the node of the higher bits; there the zero side is counted by running
    totals over `b`, range by range. Work grows with rows x log(distinct a).
    """
    known = df.select(F.col(quoted(a)).cast("double").alias("x"), F.col(quoted(b)).cast("double").alias("y"))
    known = known.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    cells = known.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    levels = F.ceil(F.log2(F.greatest("xn", F.lit(2)))).cast("int")
    y_range = F.floor(F.col("yr") * range_count(df) / F.col("yn")).alias("yr")
    placed = cells.join(_places(cells, "x"), "x").join(_places(cells, "y"), "y")
    split = placed.select("y", "c", y_range, "xr", F.explode(F.sequence(F.lit(0), levels - 1)).alias("level"))
    node = F.floor(F.col("xr") / F.pow(F.lit(2.0), F.col("level") + 1)).alias("node")
    side = F.floor(F.col("xr") / F.pow(F.lit(2.0), F.col("level"))) % 2
    sides = (split.groupBy("level", node, "yr", "y")
             .agg(F.sum(F.when(side == 0, F.col("c")).otherwise(0)).alias("zero"),
                  F.sum(F.when(side == 1, F.col("c")).otherwise(0)).alias("one")))
    node = Window.partitionBy("level", "node")
    offsets = (sides.groupBy("level", "node", "yr").agg(F.sum("zero").alias("z"))
               .select("level", "node", "yr", F.sum("z").over(node).alias("zero_all"),
                       (F.sum("z").over(node.orderBy("yr")) - F.col("z")).alias("zero_base")))
    in_range = Window.partitionBy("level", "node", "yr").orderBy("y")
    placed = sides.join(offsets, ["level", "node", "yr"]).withColumn(
        "below", F.col("zero_base") + F.sum("zero").over(in_range) - F.col("zero"))
    dbl = lambda e: e.cast("double")
    apart = placed.agg(
        F.sum(dbl(F.col("one")) * dbl(F.col("below"))).alias("p"),
        F.sum(dbl(F.col("one")) * dbl(F.col("zero_all") - F.col("below") - F.col("zero"))).alias("q"))

    def tied(name):
        n = dbl(F.col("n"))
        return (cells.groupBy(name).agg(F.sum("c").alias("n"))
                .agg(F.sum(n * (n - 1) / 2).alias("t"), F.sum("n").alias("n")))
    parts = (apart.select(F.lit(0).alias("k"), "p", "q")
             .join(tied("x").select(F.lit(0).alias("k"), F.col("t").alias("tx"), "n"), "k")
             .join(tied("y").select(F.lit(0).alias("k"), F.col("t").alias("ty")), "k"))
    total = dbl(F.col("n")) * (F.col("n") - 1) / 2
    tau = F.try_divide(F.col("p") - F.col("q"), F.sqrt((total - F.col("tx")) * (total - F.col("ty"))))
    return parts.select(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                        (tau if digits is None else F.round(tau, digits)).alias("correlation"))


def cramer_v_matrix(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Association of category columns from their contingency counts; pairs share one pass over the rows."""
    cells = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                               F.col(quoted(a)).cast("string").alias("va"), F.col(quoted(b)).cast("string").alias("vb"))
                      for a, b in _pairs(columns)])
    counts = (df.select(F.inline(cells)).where(F.col("va").isNotNull() & F.col("vb").isNotNull())
              .groupBy("column_a", "column_b", "va", "vb").agg(F.count(F.lit(1)).alias("o")))
    pair = ["column_a", "column_b"]
    row = counts.groupBy(*pair, "va").agg(F.sum("o").alias("ra"))
    col = counts.groupBy(*pair, "vb").agg(F.sum("o").alias("cb"))
    whole = row.groupBy(*pair).agg(F.sum("ra").alias("n"), F.count(F.lit(1)).alias("r"))
    cols = col.groupBy(*pair).agg(F.count(F.lit(1)).alias("k"))
    # sum over cells of o^2 / (ra * cb) needs only the cells that occur
    fit = (counts.join(row, [*pair, "va"]).join(col, [*pair, "vb"])
           .groupBy(*pair).agg(F.sum(F.col("o").cast("double") * F.col("o") / F.col("ra") / F.col("cb")).alias("s")))
    v = F.sqrt(F.try_divide(F.greatest(F.col("s") - 1, F.lit(0.0)),
                            (F.least("r", "k") - 1).cast("double")))
    return (fit.join(whole, pair).join(cols, pair)
            .select(*pair, (v if digits is None else F.round(v, digits)).alias("correlation")))


def flatten_metric_list(df: DataFrame, column: str) -> DataFrame:
    """Explode an array of nested metric structs into one flat row each, names joined by dots."""
    exploded = df.select(F.explode(column).alias("m"))

    def leaves(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype:
                yield from leaves(f.dataType, [*path, f.name])
        else:
            yield path
    return exploded.select(*[F.col(".".join(["m", *map(quoted, p)])).alias(".".join(p))
                             for p in leaves(exploded.schema["m"].dataType, [])])


def infer_contract(df: DataFrame, max_values: int = 50) -> DataFrame:
    """Draft rules from the data: type, nullability, numeric range, and the value set of small text columns.

    Value sets are gathered only for columns whose distinct count is at most `max_values`; they are JSON lists.
    """
    nums = numeric_columns(df)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        x = F.col(quoted(c))
        aggs.append(F.count_if(is_missing(df, c)).alias(f"null{i}"))
        if c in nums:
            aggs += [F.min(x).cast("double").alias(f"lo{i}"), F.max(x).cast("double").alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit("double" if c in nums else "string").alias("dtype"),
                     (F.col(f"null{i}") > 0).alias("nullable"),
                     (F.col(f"lo{i}") if c in nums else F.lit(None).cast("double")).alias("min_value"),
                     (F.col(f"hi{i}") if c in nums else F.lit(None).cast("double")).alias("max_value"))
            for i, c in enumerate(df.columns)]
    base = one.select(F.inline(F.array(*rows)))
    if not texts:
        return base.withColumn("allowed_values", F.lit(None).cast("string"))
    sizes = df.agg(*[F.approx_count_distinct(F.col(quoted(c))).alias(c) for c in texts]).first()
    likely = [c for c in texts if sizes[c] <= 2 * max_values]  # the sketch is within a few percent
    if not likely:
        return base.withColumn("allowed_values", F.lit(None).cast("string"))
    counts = _category_counts(df, likely).where(F.col("value").isNotNull())
    sets = (counts.groupBy("column")
            .agg(F.count(F.lit(1)).alias("n"), F.to_json(F.sort_array(F.collect_list("value"))).alias("allowed_values"))
            .where(F.col("n") <= max_values).drop("n"))
    return base.join(sets, "column", "left")
