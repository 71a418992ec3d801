"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import as_rows, pick, stored

#: Draws are told apart by this many leading bits, as many at a time, before single documents are put in order.
STEP, STEPS = 10, 2


def word_count(text: str | Column) -> Column:
    """Runs of characters other than space and 9 to 13; null counts 0."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def numbered(df: DataFrame, by: str) -> DataFrame:
    """Adds `place`, the rank from 1 by one column (nulls last) of a table without repeats, range by range.

    Ranges come from a sort by range, written once, so that a lost executor cannot deal them anew.
    """
    ranged = stored(df.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "offset", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col(by).asc_nulls_last()))
    return ranged.withColumn("within", within).join(offsets.select("part", "offset"), "part").withColumn(
        "place", F.col("offset") + F.col("within")).drop("part", "offset", "within")


def water_level(sources: DataFrame, total: float) -> float:
    """The amount each unit of weight gets once no source is above its limit; `sources` has weight and limit.

    Each pass clamps the sources that the level so far fills, and shares what they leave by weight. The level only rises, so a
    pass that clamps nothing new ends it. Only sums reach the driver.
    """
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * level
        left = sources.agg(F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)).alias("held"),
                           F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if not left["open"]:
            return level
        risen = (total - left["held"]) / left["open"]
        if risen <= level:
            return level
        level = risen


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: float, source: str) -> DataFrame:
    """Per source: source_size and target. Sources take the weights in turn by code point, null last."""
    totals = numbered(sizes.groupBy(source).agg(F.sum("size").alias("source_size")), source)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = stored(totals.select(
        source, "source_size", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(max_epochs)).alias("limit")), "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(weighed, float(total))
    return weighed.select(source, "source_size", F.least("limit", F.col("weight") * level).alias("target"))


def narrowed(rows: DataFrame, plan: DataFrame, source: str, step: int) -> DataFrame:
    """The plan with `prefix` and `short` one step finer: the leading bits of the draws where a source's missing words are reached.

    `short` is what is still missing before that prefix. Each source adds up at most 2^STEP sums per step. A source whose
    documents do not reach the mark has a null prefix.
    """
    own = F.col(source).eqNullSafe(F.col("of"))
    digit = F.shiftrightunsigned("draw", 64 - STEP * (step + 1))
    inside = rows.select(source, "size", digit.alias("digit"))
    if step:
        inside = inside.join(plan.select("of", "prefix"), own & (F.shiftrightunsigned("digit", STEP) == F.col("prefix"))).drop("of", "prefix")
    sums = inside.groupBy(source, "digit").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(Window.partitionBy(source).orderBy("digit")) - F.col("words"))
    reached = sums.join(plan.select("of", "short"), own).where("before <= short and short < before + words")
    marks = reached.groupBy("of").agg(F.min("digit").alias("next"), F.min("before").alias("before"))
    return stored(plan.alias("p").join(marks.alias("m"), F.col("p.of").eqNullSafe(F.col("m.of")), "left").select(
        "p.of", "source_size", "target", "whole", "missing", (F.col("short") - F.col("before")).alias("short"),
        F.col("next").alias("prefix")), "plan")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3.0, seed: int = 11,
                key: str = "doc_id", text: str = "text", source: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: key, source, size (words), source_size, target, copies, taken = size * copies; and the `carry` columns.

    A source whose target is f times its size takes floor(f) copies of each document, and one more of those whose seeded hash is
    lowest, up to the words still missing. The place of that mark among the hashes is found digit by digit from sums per source;
    only the documents that share all its digits are put in order. The last document is taken if that brings the sum nearer to
    the target. Equal rows are told apart by their order alone, so the rows returned are the same in every run.

    Null texts and texts without words have size 0 and never change a sum; null sources form one source; a table without words
    has targets of 0. Every row of the input is returned once.
    """
    kept = list(dict.fromkeys([key, source, *carry]))
    rows = pick(docs, *dict.fromkeys([*kept, text])).select(
        *kept, word_count(text).alias("size"), F.xxhash64(F.lit(seed), F.col(key), F.hash(text)).alias("draw"))
    if not carry:
        rows = stored(rows, "sizes")
    narrow = stored(rows.select(source, "size", "draw"), "draws") if carry else rows.select(source, "size", "draw")
    targets = source_targets(narrow.select(source, "size"), weights, max_epochs, source).select(
        F.col(source).alias("of"), "source_size", "target", F.floor(F.try_divide("target", "source_size")).alias("whole"))
    missing = F.col("target") - F.col("whole") * F.col("source_size")
    plan = stored(targets.select("*", missing.alias("missing"), missing.alias("short"), F.lit(None).cast("long").alias("prefix")), "plan")
    for step in range(STEPS):
        plan = narrowed(narrow, plan, source, step)

    placed = rows.join(plan, F.col(source).eqNullSafe(F.col("of"))).drop("of").withColumn(
        "lead", F.shiftrightunsigned("draw", 64 - STEP * STEPS))
    crossing = F.coalesce(F.col("lead") == F.col("prefix"), F.lit(False))
    upto = F.sum("size").over(Window.partitionBy(source).orderBy("draw", key, "size").rowsBetween(Window.unboundedPreceding, 0))
    settled = placed.where(crossing).withColumn("extra", (upto - F.col("size") / 2 <= F.col("short")).cast("int"))
    # Without a mark a source is either taken up to its last word or, having no words, not at all.
    plain = placed.where(~crossing).withColumn(
        "extra", F.when(F.col("prefix").isNull(), (F.col("missing") > 0).cast("int")).otherwise((F.col("lead") < F.col("prefix")).cast("int")))
    # Where nothing is missing the whole copies are all there are, for documents without words, too.
    extra = F.when(F.col("missing") > 0, F.col("extra"))
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(extra, F.lit(0))
    return plain.unionByName(settled).select(
        *kept, "size", "source_size", "target", copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken."""
    whole = as_rows(docs, key, text, source)
    marked = mix_sources(whole, key=key, text=text, source=source, carry=["row"], **options)
    repeated = marked.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*").toDF(*docs.columns)
