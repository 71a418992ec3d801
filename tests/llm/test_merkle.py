import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def grow(nodes, fanout):
    """All levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def proof(levels, place, fanout):
    out = []
    for nodes in levels[:-1]:
        low = place - place % fanout
        out.append(("".join(nodes[low:place] + nodes[place + 1:low + fanout]), place - low))
        place //= fanout
    return out


def brute(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((ordered, grow([leaf(r) for r in ordered], fanout)))
    crown = grow([levels[-1][0] for _, levels in trees], fanout)
    out = []
    for i, (ordered, levels) in enumerate(trees):
        for place, row in enumerate(ordered):
            out.append((row[0], row[1], place, leaf(row), levels[-1][0], crown[-1][0], proof(levels, place, fanout) + proof(crown, i, fanout)))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def sample(n):
    rng = random.Random(n)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "é", "Z", None, "日本", *(f"s{j}" for j in range(20))]), "en" if i % 5 else None, i % 7 or None,
             rng.choice([None, "", "Text é 日本", "x" * 300])) for i in range(n)]
    return rows + [(5, "hot", "en", 1, "other"), (5, "hot", "en", 1, "other"), (None, "hot", None, None, None), (None, None, None, None, None), (7, "alone", "fr", 1, "y")]


@pytest.mark.parametrize("fanout, n", [(16, 700), (2, 90), (3, 60)])
def test_manifest_equals_brute_force(spark, fanout, n):
    rows = sample(n)
    docs = table(spark, rows).selectExpr("*", "'x' as leaf", "1 as tree", "'z' as Text").repartition(5)
    made = merkle.merkle_manifest(docs, COLUMNS, fanout=fanout)
    got = sorted(((r.doc_id, r.group, r["index"], r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in made.collect()), key=str)
    assert got == brute(rows, fanout)


def test_folding_finds_tampered_rows(spark):
    rows = sample(200)
    other = merkle.leaf_digest([F.col(c) if c != "text" else F.lower("text") for c in COLUMNS])
    made = merkle.merkle_manifest(table(spark, rows), COLUMNS, extra={"tampered": other, "was": F.col("text")})
    folded = made.select("*", merkle.fold_path(F.col("leaf"), F.col("path")).alias("own"), merkle.fold_path(F.col("tampered"), F.col("path")).alias("new"),
                         merkle.path_digest(F.col("path")).alias("digest")).collect()
    assert all(r.own == r.root for r in folded)
    assert all((r.new == r.root) == (r.was is None or not re.search("[A-Z]", r.was)) for r in folded) and any(r.new != r.root for r in folded)
    assert all(r.digest == h(*[s.siblings for s in r.path]) for r in folded)


def test_small_tables(spark):
    none = table(spark, [])
    assert merkle.merkle_manifest(none, COLUMNS).count() == 0
    one = merkle.merkle_manifest(table(spark, [(1, None, None, None, "a")]), COLUMNS).first()
    assert one.leaf == one.subroot == one.root == leaf((1, None, None, None, "a")) and one.path == []
    two = merkle.merkle_manifest(table(spark, [(1, "a", None, None, "x"), (2, "b", None, None, "x")]), COLUMNS).orderBy("doc_id").collect()
    assert two[0].root == h(two[0].leaf, two[1].leaf) and two[0].subroot == two[0].leaf
