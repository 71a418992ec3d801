"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import as_rows, pick, stored

SLOTS = 1 << 12
#: Documents of an arc, on average at most: their keys and sizes fit a task many times.
ARC_BYTES = 8 << 30
PIECE = T.StructType([T.StructField("arc", T.IntegerType()), T.StructField("piece", T.IntegerType()),
                      T.StructField("low", T.LongType()), T.StructField("high", T.LongType()),
                      T.StructField("shard", T.IntegerType())])


def document_size(text: str | Column) -> Column:
    """UTF-8 bytes (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def ring_slot(position: Column) -> Column:
    """The equal slice of the 64-bit circle that a position lies in."""
    return F.shiftrightunsigned(position, 52).cast("int")


def ring(spark, shards: int, vnodes: int) -> DataFrame:
    """Arcs (arc, shard, after, upto): keys in (after, upto] of the signed 64-bit circle; the first arc also takes what wraps."""
    # A shard's points depend on its own number alone, so a further shard leaves all others where they are.
    shard, node = F.floor(F.col("id") / vnodes).cast("int"), (F.col("id") % vnodes).cast("int")
    points = spark.range(shards * vnodes).select(shard.alias("shard"), F.xxhash64(F.lit("node"), shard, node).alias("upto"))
    order = Window.orderBy("upto", "shard")
    return points.select("shard", "upto", (F.row_number().over(order) - 1).cast("int").alias("arc"),
                         F.lag("upto").over(order).alias("after"))


def arc_of(rows: DataFrame, arcs: DataFrame) -> DataFrame:
    """Adds the arc of each `position`: arcs are listed for every slice they touch, and the slice is joined."""
    last = arcs.agg(F.max("upto").alias("top")).first()["top"]
    # Positions past the last point belong to the first arc.
    at = F.when(F.col("position") > last, F.lit(-(1 << 63)).cast("long")).otherwise(F.col("position"))
    order = F.col("after").isNull()
    span = arcs.select("arc", "upto", F.coalesce("after", F.lit(-(1 << 63)).cast("long")).alias("after"), order.alias("first"))
    # Slices count up from the most negative position.
    first, final = (ring_slot(F.col(c)).bitwiseXOR(SLOTS >> 1) for c in ("after", "upto"))
    slices = F.broadcast(span.withColumn("slice", F.explode(F.sequence(first, final))))
    fits = (F.col("at") > F.col("after")) | (F.col("first") & (F.col("at") == F.col("after")))
    placed = rows.withColumn("at", at).withColumn("slice", ring_slot(F.col("at")).bitwiseXOR(SLOTS >> 1))
    return placed.join(slices, "slice").where(fits & (F.col("at") <= F.col("upto"))).drop("slice", "upto", "after", "first", "at")


def bounded_loads(arcs: Sequence[tuple[int, int, int]], shards: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """Cuts arcs (arc, shard, bytes), in ring order, into pieces (arc, piece, low, high, shard) so that no shard exceeds its bound.

    A shard takes its own arcs up to the bound; what flows over goes clockwise to the next shards with room. The bounds sum to at
    least all bytes, so everything finds a place. The list is as long as the ring, whatever the number of keys.
    """
    bound = ceil(sum(load for _, _, load in arcs) / shards * (1 + slack))
    room, pieces, over = [bound] * shards, [], []
    for place, (arc, shard, load) in enumerate(arcs):
        own = min(load, room[shard])
        room[shard] -= own
        pieces.append((arc, 0, own, shard))
        if load > own:
            over.append((place, arc, own, load))
    for place, arc, low, load in over:
        step = place
        while low < load:
            step = (step + 1) % len(arcs)
            shard = arcs[step][1]
            part = min(load - low, room[shard])
            if part:
                room[shard] -= part
                pieces.append((arc, low, low + part, shard))
                low += part
    return [(arc, k, low, high, shard) for k, (arc, low, high, shard) in enumerate(pieces) if high > low]


def ring_nodes(total: int, shards: int) -> int:
    """Virtual nodes of a shard: a power of two, 64 at least, so that an arc holds `ARC_BYTES` of documents on average at most."""
    nodes = 64
    while total > nodes * shards * ARC_BYTES:
        nodes *= 2
    return nodes


def shard_documents(docs: DataFrame, shards: int = 40, vnodes: int | None = None, slack: float = 0.001, key: str = "doc_id",
                    text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot; and the `carry` columns, which should be narrow.

    A document's place on the ring is the hash of its key and text checksum. Walking clockwise, each shard takes the documents of
    its arcs until `slack` over the mean number of bytes; a document that starts beyond the bound goes on to the next shard with
    room. So no shard exceeds the bound by more than one document, and a new shard moves only what its arcs and the shifted
    bounds take. Slots count from 0 without gaps, in ring order.

    Arcs are the unit of work, and only keys and sizes are walked; unless `vnodes` says otherwise there are as many arcs as keep
    them short (see `ring_nodes`). Nulls: a null text has no bytes and checksum 0, null keys are placed by their text. Equal texts
    under different keys spread like any others. Rows that are equal in full share a place and take consecutive slots. An empty
    table gives no rows; every row of the input is returned once.
    """
    spark = docs.sparkSession
    kept = list(dict.fromkeys([key, *carry]))
    sized = stored(pick(docs, *dict.fromkeys([*kept, text])).select(
        *kept, document_size(text).alias("size"),
        F.coalesce(F.crc32(F.encode(F.col(text), "UTF-8")), F.lit(0)).cast("long").alias("text_crc32")), "sizes")
    if vnodes is None:
        vnodes = ring_nodes(sized.agg(F.sum("size")).first()[0] or 0, shards)
    arcs = stored(ring(spark, shards, vnodes), "ring")
    placed = arc_of(sized.withColumn("position", F.xxhash64(key, "text_crc32")), arcs)
    loads = placed.groupBy("arc").agg(F.sum("size").alias("bytes"))
    summary = arcs.join(loads, "arc", "left").select("arc", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")).orderBy("arc")
    cuts = bounded_loads([tuple(r) for r in summary.collect()], shards, slack)  # one row per arc
    pieces = F.broadcast(spark.createDataFrame(cuts, PIECE))
    order = Window.partitionBy("arc").orderBy("position", key, "size", "text_crc32", *carry)
    walked = placed.withColumn("begin", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    walked = walked.withColumn("nth", F.row_number().over(order))
    dealt = stored(walked.join(pieces, "arc").where((F.col("low") <= F.col("begin")) & (F.col("begin") < F.col("high"))), "dealt")
    counts = dealt.groupBy("piece", "shard").agg(F.count("*").alias("n"), F.min("nth").alias("from_nth"))
    base = F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")
    bases = F.broadcast(counts.select("piece", (base - F.col("from_nth")).alias("base")))
    return dealt.join(bases, "piece").select(*kept, "size", "text_crc32", "shard", (F.col("base") + F.col("nth")).cast("long").alias("slot"))


def sharded_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with their own columns, and shard_bytes, shard and slot, which replace columns of those names.

    Whole rows are written once under a number; keys, sizes and numbers are sharded, and the rows meet their places by number.
    """
    numbered = stored(as_rows(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    place = {n: F.col(f"row.c{docs.columns.index(n)}").alias(n) for n in (key, text)}
    dealt = shard_documents(numbered.select(*place.values(), "number"), key=key, text=text, carry=["number"], **options)
    rows = numbered.join(dealt.select("number", "size", "shard", "slot"), "number")
    own = [(i, c) for i, c in enumerate(docs.columns) if c not in ("shard_bytes", "shard", "slot")]
    out = rows.select(*[F.col(f"row.c{i}").alias(f"c{i}") for i, _ in own], "size", "shard", "slot")
    return out.toDF(*[c for _, c in own], "shard_bytes", "shard", "slot")
