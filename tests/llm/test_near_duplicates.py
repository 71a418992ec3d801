import random
import re
from itertools import combinations

import numpy as np
import pytest

from tallyforge.llm import minmax_dedup as md


def shingle_set(text, k=5):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows, percent=75):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[top(a)] = top(b)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        least = key if not sets[i] else min(keys, default=None)
        out.append((key, len(sets[i]), least, key == least))
    return sorted(out, key=str)


def varied(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("klmnop") + str(rng.randrange(1000))
    return " ".join(words)


def crowd(seed, size):
    """One base with copies of every closeness, chains of drifting copies, exact copies and strangers that share a passage."""
    rng = random.Random(seed)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(120))
    rows = [(i, varied(rng, base, rng.randint(0, 9))) for i in range(size)]
    text = " ".join(f"v{rng.randrange(400)}" for _ in range(60))
    for i in range(size // 4):
        text = varied(rng, text, 1)
        rows.append((10_000 + i, text))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(20_000 + i, passage + " " + " ".join(f"s{rng.randrange(9999)}" for _ in range(rng.randint(10, 60)))) for i in range(size // 2)]
    rows += [(30_000 + i, base.upper()) for i in range(size // 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rounds", [4, 1])
def test_components_equal_brute_force(documents, rounds):
    rows = crowd(rounds + 1, 120)
    got = md.near_duplicates(documents(rows, extra=["nid", "component"]), settings=md.Settings(rounds=rounds)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("block", [256, 4])
def test_open_buckets_keep_every_join(spark, monkeypatch, block):
    monkeypatch.setattr(md, "BLOCK_SETS", block)
    rng = random.Random(9)
    sets = [sorted(rng.sample(range(24), rng.randint(3, 20))) for _ in range(60)]
    keys = [[rng.randrange(4) * 3 + band for band in range(3)] for _ in sets]
    component = [i // 3 for i in range(60)]
    entries = spark.createDataFrame([(k, i, len(s), component[i]) for i, s in enumerate(sets) for k in keys[i]],
                                    "bucket long, nid long, n long, component long")
    items = spark.createDataFrame(list(enumerate(sets)), "nid long, items array<long>")
    got = {tuple(sorted((r.a, r.b))) for r in md.open_links(entries, items, md.Settings()).collect()}
    want = set()
    for a, b in combinations(range(60), 2):
        both = len(set(sets[a]) & set(sets[b]))
        near = 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)
        if near and component[a] != component[b] and any(x == y for x, y in zip(keys[a], keys[b])):
            want.add((a, b))
    assert got <= want
    assert {tuple(sorted((component[a], component[b]))) for a, b in got} == {tuple(sorted((component[a], component[b]))) for a, b in want}


def test_bits_reject_the_unlike_and_keep_the_alike(spark):
    """Of pairs at the least similarity none is rejected, of those at a third nearly all are."""
    rng, s = np.random.default_rng(6), md.Settings()
    for shared, low, high in ((600, 0, 0), (350, 0.9, 1)):
        hashes, pairs = [], 300
        for _ in range(pairs):
            both = rng.integers(0, 1 << 63, 1400 - shared).astype(np.uint64)
            hashes += [np.sort(both[:700]), np.sort(both[700 - shared:])]
        bounds = np.append(0, np.cumsum([len(h) for h in hashes]))
        _, bits = md.band_keys(np.concatenate(hashes), bounds, s)
        df = spark.createDataFrame([(bits[2 * i].tolist(), bits[2 * i + 1].tolist()) for i in range(pairs)], "a array<long>, b array<long>")
        rejected = df.where(~md.plausible(df.a, df.b, s)).count() / pairs
        assert low <= rejected <= high


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 120)] + [(200, 201), (200, 201)]
    got = {r.id: r.component for r in md.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 120)} == {100} and got[201] == 200


def test_odd_rows(documents):
    long_text = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t "), (4, "one two"), (5, "One  two"), (6, "one two three"), (7, long_text), (8, long_text + " end"),
            (9, "a b c d e"), (9, "a b c d e"), (None, "a b c d e"), (None, "lone null key text here now")]
    docs = documents(rows, extra=["id", "bucket"])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in md.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)
    stay = md.without_near_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["1", "2", "3", "4", "6", "7", "9", "None"]
    twins = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, "z")]).selectExpr("*", "'y' as Text", "1 as Nid")
    assert sorted(tuple(r)[:2] + tuple(r)[5:] for r in md.without_near_duplicates(twins).collect()) == [(1, "a b c d e f", "y", 1), (3, "z", "y", 1)]
    assert md.near_duplicates(docs.limit(0)).count() == 0
    assert md.without_near_duplicates(docs.limit(0)).count() == 0
