"""Merkle manifest of a table: a tree of hashes per group and one over the groups, with a proof for every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import pick, stored
from tallyforge.operators.ranks import numbered

#: Hex digits of a digest.
DIGITS = 64


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts end to end."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of one row: each value as `-` if null, else its UTF-8 byte count, a colon and the value as text."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(*[framed(v) for v in values])


def sibling_indices(index: Column, fanout: int) -> Column:
    """The other places of the run that a place belongs to: its XOR neighbour in a binary tree, slot offsets otherwise."""
    if fanout == 2:
        return F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    first = index - index % fanout
    return F.array_except(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda slot: first + slot), F.array(index))


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Adds `siblings` to nodes (tree, index, hash, ...): the other digests of the node's run as bytes, from left to right.

    Every node asks for the computed places of its siblings and meets them in an equijoin, whatever the size of its tree; a node
    has fanout - 1 siblings at most. A run of one has no siblings.
    """
    asked = nodes.select("tree", "index", F.explode(sibling_indices(F.col("index"), fanout)).alias("place"))
    there = nodes.select("tree", F.col("index").alias("place"), F.unhex("hash").alias("code"))
    met = asked.join(there, ["tree", "place"]).groupBy("tree", "index").agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("run"))
    none = F.lit("").cast("binary")
    whole = F.aggregate("run", none, lambda left, s: F.concat(left, s["code"]))
    return nodes.join(met.select("tree", "index", whole.alias("siblings")), ["tree", "index"], "left").withColumn(
        "siblings", F.coalesce("siblings", none))


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """The next level up: the node in slot zero of each run emits the digest of the run."""
    return level.where(F.col("index") % fanout == 0).select(
        "tree", (F.col("index") / fanout).cast("long").alias("index"), digest(F.col("hash"), hexed("siblings")).alias("hash"),
        F.ceil(F.col("n") / fanout).alias("n"))


def hexed(code: str | Column) -> Column:
    return F.lower(F.hex(code))


def climb(leaves: DataFrame, most: int, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The written levels of all trees from the leaves upwards, and the tops (tree, hash).

    `leaves` has tree, index, hash, n (the size of the tree) and other columns that only the lowest level keeps; `most` is the
    largest n. A level holds the nodes of the trees that have several nodes there.
    """
    levels, nodes, tops = [], leaves, []
    while most > 1:
        tops.append(nodes.where("n = 1").select("tree", "hash"))
        level = stored(with_siblings(nodes.where("n > 1"), fanout), f"{name}-level")
        levels.append(level)
        nodes, most = parents(level, fanout), -(-most // fanout)
    out = nodes.select("tree", "hash")
    for done in tops:
        out = out.union(done)
    return levels, out


def descend(leaves: DataFrame, levels: list[DataFrame], ends: DataFrame, fanout: int, keep: Sequence[str]) -> DataFrame:
    """The leaves with `path` and `top`: each run takes the path of its parent, each top run what `ends` has for its tree.

    `ends` has tree, path and top. A path is an array, from the leaf upwards, of the siblings and the slot of a level. Only parents'
    paths are shuffled, one for each run.
    """
    handed = None
    for i, level in reversed(list(enumerate(levels))):
        step = F.array(F.struct("siblings", (F.col("index") % fanout).cast("int").alias("slot")))
        kept = ["tree", "index", *(keep if i == 0 else [])]
        here = level.select(*kept, step.alias("step"), (F.col("index") / fanout).cast("long").alias("up"), "n")
        found = here.where(F.col("n") <= fanout).join(ends, "tree").select(*kept, F.concat("step", "path").alias("path"), "top")
        if handed is not None:
            above = handed.select("tree", F.col("index").alias("up"), "path", "top")
            found = found.union(here.where(F.col("n") > fanout).join(above, ["tree", "up"]).select(
                *kept, F.concat("step", "path").alias("path"), "top"))
        handed = found
    alone = leaves.where("n = 1").join(ends, "tree").select("tree", "index", *keep, "path", "top")
    return alone if handed is None else alone.union(handed)


def fold_path(leaf: Column, path: Column) -> Column:
    """The top that a leaf leads to by the siblings of its path."""
    def up(low: Column, step: Column) -> Column:
        cut = step["slot"] * DIGITS
        return digest(F.substr(step["siblings"], F.lit(1), cut), low, F.substr(step["siblings"], cut + 1))
    return F.aggregate(path, leaf, up)


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, each level from left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: step["siblings"])), 256)


def merkle_manifest(docs: DataFrame, columns: Sequence[str], group: str = "source", key: str = "doc_id", fanout: int = 16,
                    extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of the table: key, leaf, group, index, subroot, root, path, and the columns of `extra`.

    A leaf is the digest of the row's `columns` (see `leaf_digest`). The leaves of a group, ascending by key (nulls first), are
    joined by runs of `fanout` until one digest remains, the group's subroot; a group of one leaf has that leaf. Subroots, by group
    in the order of its UTF-8 bytes with null first, are joined likewise to the root. `path` holds the siblings and the slot of
    every level from the leaf to the root; `fold_path(leaf, path)` equals the root. Rows that share a key stand by leaf digest;
    repeated rows are leaves of their own. An empty table has no rows. `extra` maps names to expressions over the table's columns,
    computed in the same read and handed through, so that a digest of other values can be held against the path. Of several
    columns of one name the first is taken; others may be called anything.

    A group of any size is spread: places come from a range sort of the whole table, siblings meet in equijoins by place, and
    every level is a sixteenth of the one below at the default fanout. Only counts and the number of levels reach the driver.
    """
    wanted = list(dict.fromkeys([key, group, *columns]))
    named = pick(docs, *wanted)
    rows = named.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf_digest([F.col(c) for c in columns]).alias("leaf"),
                        F.struct(*[c.alias(n) for n, c in (extra or {"none": F.lit(0)}).items()]).alias("extra"))
    placed = numbered(rows, [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")], "place")
    groups = placed.groupBy("group").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    starts = stored(numbered(groups, [F.col("start")], "tree"), "groups")
    size = starts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("trees")).first()
    seats = stored(placed.join(starts, placed["group"].eqNullSafe(starts["group"])).select(
        "tree", (F.col("place") - F.col("start")).alias("index"), F.col("leaf").alias("hash"), "n",
        F.struct("key", placed["group"], "leaf", "extra").alias("row")), "seats")
    levels, tops = climb(seats, size["most"], fanout, "leaf")
    tops = stored(tops, "subroots")
    crown = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), "hash", F.lit(size["trees"]).alias("n"))
    rings, peak = climb(crown, size["trees"], fanout, "root")
    root = peak.select("tree", F.array().cast("array<struct<siblings:binary,slot:int>>").alias("path"), F.col("hash").alias("top"))
    ends = descend(crown, rings, root, fanout, ["hash"]).select(
        F.col("index").alias("tree"), "path", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"))
    path = F.transform("path", lambda step: F.struct(hexed(step["siblings"]).alias("siblings"), step["slot"].alias("slot")))
    return descend(seats, levels, ends, fanout, ["row"]).select(
        F.col("row.key").alias(key), F.col("row.group").alias("group"), "index", F.col("row.leaf").alias("leaf"), F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"), path.alias("path"), *[F.col(f"row.extra.{n}").alias(n) for n in (extra or {})])
