"""Seeded splits with exact sizes, decided by a hash of the key instead of by row order."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}
DIGITS_PER_PASS = 3
LAST_PASS_ROWS = 1000


def split_sizes(n: int, shares: dict[str, float]) -> dict[str, int]:
    """Row counts per split; every cut rounds the remaining part up, so the first split rounds down."""
    if abs(sum(shares.values()) - 1.0) > 1e-9 or min(shares.values()) < 0:
        raise ValueError("split shares must be non-negative and add up to 1")
    sizes, left, left_share = {}, n, 1.0
    names = list(shares)
    for name in names[:-1]:
        rest = math.ceil(round(left * (left_share - shares[name]) / left_share, 9)) if left_share else 0
        sizes[name] = left - rest
        left, left_share = rest, left_share - shares[name]
    sizes[names[-1]] = left
    return sizes


def key_hash(key: list[str] | str, seed: int) -> Column:
    keys = [key] if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hashes_at(hashes: DataFrame, ranks: list[int]) -> dict[int, str | None]:
    """The hash at each 0-based rank, found digit by digit with counting passes.

    Each pass returns at most 4096 counts per rank to the driver, and no rows are shuffled.
    """
    found: dict[int, str | None] = {}
    open_ = {r: ("", r) for r in ranks}
    while open_:
        prefixes = sorted({p for p, _ in open_.values()})
        depth = len(prefixes[0]) + DIGITS_PER_PASS
        rows = (hashes.where(_starts(prefixes)).groupBy(F.substring("h", 1, depth).alias("p"))
                .count().collect())
        counts = sorted((r["p"], r["count"]) for r in rows)
        narrowed = {}
        for rank, (prefix, left) in open_.items():
            for p, n in counts:
                if not p.startswith(prefix):
                    continue
                if left < n:
                    narrowed[rank] = (p, left, n)
                    break
                left -= n
            else:
                found[rank] = None  # past the last row
        small = {r: v for r, v in narrowed.items() if v[2] <= LAST_PASS_ROWS or depth >= 32}
        if small:
            ends = sorted({v[0] for v in small.values()})
            tail = [r["h"] for r in hashes.where(_starts(ends)).groupBy("h").count()
                    .select(F.explode(F.array_repeat("h", F.least("count", F.lit(LAST_PASS_ROWS)).cast("int")))
                            .alias("h")).collect()] if depth < 32 else []
            for rank, (p, left, _) in small.items():
                found[rank] = p if depth >= 32 else sorted(h for h in tail if h.startswith(p))[left]
        open_ = {r: v[:2] for r, v in narrowed.items() if r not in small}
    return found


def _starts(prefixes: list[str]) -> Column:
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col("h").startswith(p)
    return test


def exact_split(df: DataFrame, key: list[str] | str, shares: dict[str, float] | None = None,
                seed: int = 42) -> DataFrame:
    """Add a `split` column whose sizes are exact for a unique key.

    The cut hashes are literals in the plan, so the split itself is a narrow projection and
    gives the same rows whatever the partitioning. Equal keys always share a split. Rows are
    hashed once for all counting passes and once for the projection.
    """
    shares = shares or DEFAULT_SHARES
    hashes = df.select(key_hash(key, seed).alias("h")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = split_sizes(hashes.count(), shares)
        edges, at = [], 0
        for name in list(shares)[:-1]:
            at += sizes[name]
            edges.append((name, at))
        cuts = hashes_at(hashes, sorted({e for _, e in edges}))
    finally:
        hashes.unpersist()
    label = F.lit(list(shares)[-1])
    for name, edge in reversed(edges):
        label = F.lit(name) if cuts[edge] is None else F.when(F.col("__hash") < cuts[edge], name).otherwise(label)
    return df.withColumn("__hash", key_hash(key, seed)).withColumn("split", label).drop("__hash")


def hashed_split(df: DataFrame, key: list[str] | str, shares: dict[str, float] | None = None,
                 seed: int = 42) -> DataFrame:
    """Split by hash fraction: no pass over the data at all, sizes right only on average."""
    shares = shares or DEFAULT_SHARES
    unit = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    label, upper = F.lit(list(shares)[-1]), 1.0
    for name in reversed(list(shares)[:-1]):
        upper = sum(shares[n] for n in list(shares)[:list(shares).index(name) + 1])
        label = F.when(unit < upper, name).otherwise(label)
    return df.withColumn("split", label)
