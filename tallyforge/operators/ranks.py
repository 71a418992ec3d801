"""Order statistics that never sort a whole column in one task.

`running_counts` turns a table of distinct values into running totals by cutting each
group into value ranges; `exact_quantiles` narrows down to the wanted ranks with
counting passes, so that only a thin slice of the rows is ever shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import quoted
from tallyforge.session import scratch_path

SLICE_ROWS = 100_000
SKETCH_ACCURACY = 2_000


def range_count(df: DataFrame) -> int:
    """How many value ranges a group is cut into: as many as the session shuffles into, so that they grow with the cluster."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def last_at_most(edges: str, start: Callable[[Column], Column]) -> Column:
    """The last element of a sorted array of arrays whose `start` is true; blocks are searched first, then inside one."""
    block = F.element_at(F.filter(edges, lambda part: start(part[0])), -1)
    return F.element_at(F.filter(block, start), -1)


def running_counts(counts: DataFrame, by: list[str], value: str, measures: list[str], ranges: int | None = None) -> DataFrame:
    """Add `<m>_before`, `<m>_total` and `next_<value>` to a table of distinct (by, value) rows.

    `<m>_before` sums the measure over all smaller values of the group. The number of
    groups must be small (columns, slots, metrics): one row of range edges per group is
    broadcast. The result does not depend on where the edges fall, only the balance does.
    The edge table carries its own offsets, so a recomputed stage cannot mix two sets of edges.
    """
    val, ranges = F.col(value), ranges or range_count(counts)
    occurs = F.lit(0)
    for m in measures:
        occurs = occurs + F.col(m)
    probs = [i / ranges for i in range(1, ranges)]
    cuts = counts.where(occurs > 0).groupBy(*by).agg(
        F.array_distinct(F.percentile_approx(val, probs, max(1000, 10 * ranges))).alias("__cuts"))
    step = max(1, math.isqrt(ranges))

    def blocked(array: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / step).cast("int")),
                           lambda i: F.slice(array, i * step + 1, F.lit(step)))

    # A first edge without a value stands for the lowest range.
    lowest = F.array(F.lit(None).cast(counts.schema[value].dataType))
    cuts = cuts.select(*by, blocked(F.concat(lowest, F.filter("__cuts", lambda c: c.isNotNull()))).alias("__cuts"))
    lower = last_at_most("__cuts", lambda c: c.isNull() | (c < val)).alias("lower")

    totals = (counts.join(F.broadcast(cuts), by)
              .groupBy(*by, lower)
              .agg(*[F.sum(m).alias(m) for m in measures], F.min(val).alias("first")))
    group = Window.partitionBy(*by)
    ordered = group.orderBy(F.col("lower").asc_nulls_first())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    edge = F.struct(
        F.col("lower"), F.lead("first").over(ordered).alias("next_first"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_before") for m in measures])
    edges = (totals.select(*by, edge.alias("edge"),
                           *[F.sum(m).over(group).alias(f"{m}_total") for m in measures])
             .groupBy(*by)
             .agg(blocked(F.sort_array(F.collect_list("edge"))).alias("__edges"),
                  *[F.max(f"{m}_total").alias(f"{m}_total") for m in measures]))

    inside = last_at_most("__edges", lambda e: e["lower"].isNull() | (e["lower"] < val))
    placed = counts.join(F.broadcast(edges), by).withColumn("__edge", inside).drop("__edges")
    in_range = Window.partitionBy(*by, "__edge.lower").orderBy(val)
    upto = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        *[F.col(c) for c in counts.columns],
        *[(F.col(f"__edge.{m}_before") + F.sum(m).over(upto) - F.col(m)).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total") for m in measures],
        F.coalesce(F.lead(val).over(in_range), F.col("__edge.next_first")).alias(f"next_{value}"))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the place (from 0) of every row in the given order over the whole table.

    The rows are sorted range by range and written once to the scratch folder, so that a lost executor cannot deal them
    anew; the table of offsets has one row per written range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "order")
    ranged.write.parquet(path)
    back = df.sparkSession.read.schema(ranged.schema).parquet(path).withColumn("__range", F.shiftright("__id", 33))
    sizes = back.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    place = F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1)
    return back.join(F.broadcast(offsets), "__range").withColumn(name, place).drop("__range", "__id", "__before")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-missing numeric values of each column with their counts (column, value, n)."""
    from tallyforge.functions.columns import long_form
    return (long_form(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def average_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, avg_rank): 1-based ranks, ties share their mean rank."""
    ranked = running_counts(value_counts(df, columns), ["column"], "value", ["n"])
    return ranked.select("column", "value", "n",
                         (F.col("n_before") + (F.col("n") + 1) / 2.0).alias("avg_rank"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    slice_rows: int = SLICE_ROWS, accuracy: int = SKETCH_ACCURACY) -> dict[str, dict[float, float | None]]:
    """Linear-interpolated quantiles of several columns, exact at any size.

    Every wanted rank is bracketed with a sketch, the rows under each bracket are counted, and
    only the rows inside it are sorted; brackets that are still too wide are narrowed again.
    Only scalars reach the driver.
    """
    clean = df.select(*[F.when(~F.isnan(F.col(quoted(c)).cast("double")),
                               F.col(quoted(c)).cast("double")).alias(c) for c in columns])
    sizes = clean.agg(*[F.count(F.col(quoted(c))).alias(c) for c in columns]).first()
    out: dict[str, dict[float, float | None]] = {c: {p: None for p in probs} for c in columns}
    filled = [c for c in columns if sizes[c]]
    if not filled:
        return out
    wanted = {}
    for c in filled:
        for p in probs:
            pos = (sizes[c] - 1) * p
            for rank in {math.floor(pos), math.ceil(pos)}:
                wanted[(c, rank)] = None
    found = _select_ranks(clean, list(wanted), sizes, slice_rows, accuracy)
    for c in filled:
        for p in probs:
            pos = (sizes[c] - 1) * p
            lo, hi = found[(c, math.floor(pos))], found[(c, math.ceil(pos))]
            out[c][p] = lo + (hi - lo) * (pos - math.floor(pos))
    return out


def _select_ranks(clean: DataFrame, wanted: list[tuple[str, int]], sizes, slice_rows: int,
                  accuracy: int) -> dict[tuple[str, int], float]:
    inf = float("inf")
    spans = {w: (-inf, inf, 0, sizes[w[0]]) for w in wanted}  # low, high, rows below, rows inside
    settled: set[tuple[str, int]] = set()  # answered by one value, or no longer shrinking
    for _ in range(6):
        wide = [w for w in wanted if spans[w][3] > slice_rows and w not in settled]
        if not wide:
            break
        # one sketch per column and span serves all ranks asked of it
        groups: dict[tuple, list[tuple[str, int]]] = {}
        for w in wide:
            groups.setdefault((w[0], *spans[w]), []).append(w)
        slack = 2.0 / accuracy
        ask = []
        for i, ((name, low, high, below, inside), ranks) in enumerate(groups.items()):
            col = F.col(quoted(name))
            shares = [(w[1] - below) / inside for w in ranks]
            ask.append(F.percentile_approx(
                col if (low, high) == (-inf, inf) else F.when(col.between(low, high), col),
                [min(1.0, max(0.0, s + d)) for s in shares for d in (-slack, slack)], accuracy).alias(f"s{i}"))
        near = clean.agg(*ask).first()
        found = {w: tuple(near[f"s{i}"][2 * j:2 * j + 2]) for i, ranks in enumerate(groups.values())
                 for j, w in enumerate(ranks)}
        brackets = sorted({(w[0], *found[w]) for w in wide})
        counts = []
        for i, (name, low, high) in enumerate(brackets):
            col = F.col(quoted(name))
            counts += [F.count_if(col < low).alias(f"b{i}"), F.count_if(col.between(low, high)).alias(f"m{i}"),
                       F.count_if(col == low).alias(f"lo{i}"), F.count_if(col == high).alias(f"hi{i}")]
        got = clean.agg(*counts).first()
        for w in wide:
            i = brackets.index((w[0], *found[w]))
            low, high = found[w]
            start, inside = got[f"b{i}"], got[f"m{i}"]
            if not start <= w[1] < start + inside:
                settled.add(w)  # the sketch missed: keep the span that is known to hold the rank
            elif w[1] < start + got[f"lo{i}"]:
                spans[w] = (low, low, start, got[f"lo{i}"])
                settled.add(w)
            elif w[1] >= start + inside - got[f"hi{i}"]:
                spans[w] = (high, high, start + inside - got[f"hi{i}"], got[f"hi{i}"])
                settled.add(w)
            elif inside < spans[w][3]:
                spans[w] = (low, high, start, inside)
            else:
                settled.add(w)

    out = {w: spans[w][0] for w in wanted if spans[w][0] == spans[w][1]}
    wanted = [w for w in wanted if w not in out]
    if not wanted:
        return out
    # ranks that share a span share its rows
    slots_of = sorted({(w[0], *spans[w]) for w in wanted})
    slots = [F.when(F.col(quoted(name)).between(low, high),
                    F.struct(F.lit(i).alias("slot"), F.col(quoted(name)).alias("value")))
             for i, (name, low, high, _, _) in enumerate(slots_of)]
    inside = (clean.select(F.inline(F.array_compact(F.array(*slots))))
              .groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")))
    if max(span[4] for span in slots_of) <= slice_rows:
        # The narrowing leaves no more than a slice of rows per slot, which one task sorts.
        upto = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = inside.withColumn("n_before", F.sum("n").over(upto) - F.col("n"))
    else:
        placed = running_counts(inside, ["slot"], "value", ["n"])
    asked = [(slots_of.index((w[0], *spans[w])), w[1] - spans[w][2], w) for w in wanted]
    test = F.lit(False)
    for slot, rank, _ in asked:
        test = test | ((F.col("slot") == slot) & (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")))
    hits = placed.where(test).select("slot", "value", "n_before", "n").collect()
    for slot, rank, w in asked:
        out[w] = next(h["value"] for h in hits if h["slot"] == slot and h["n_before"] <= rank < h["n_before"] + h["n"])
    return out
