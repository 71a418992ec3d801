import re
import zlib
from collections import defaultdict
from math import ceil

import pytest
from pyspark.sql import functions as F

from tallyforge.llm.hash_ring import bounded_loads, ring, ring_nodes, shard_documents, sharded_documents
from tallyforge.llm.mixing import mix_sources, mixed_documents


def water_filled(sizes, weights, cap):
    """Targets by repeated sharing of what is left."""
    names = sorted(sizes, key=lambda n: (n is None, n))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_names, target = float(sum(sizes.values())), set(names), {}
    while open_names:
        level = left / sum(weight[n] for n in open_names)
        over = [n for n in open_names if weight[n] * level > cap * sizes[n]]
        if not over:
            target.update({n: weight[n] * level for n in open_names})
            break
        for n in over:
            target[n] = cap * sizes[n]
            left -= target[n]
            open_names.remove(n)
    return target


def rows_of(n):
    source = lambda i: None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 5}"
    return [(i, " ".join(["w"] * (i * 7919 % 40)), source(i)) for i in range(n)]


def test_targets_and_words_taken(documents):
    docs = documents(rows_of(3000), extra=["size", "bin"])
    got = mix_sources(docs).collect()
    again = {(r.doc_id, r.taken) for r in mix_sources(docs.repartition(7)).collect()}
    assert len(got) == 3000 and {(r.doc_id, r.taken) for r in got} == again
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    want = water_filled(sizes, (5, 2, 1), 3)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for name, words in taken.items():
        assert abs(words - want[name]) <= 40


def test_mix_of_odd_rows(documents):
    docs = documents([(1, None, "a"), (2, "", "b"), (3, "x y z", "b"), (3, "x y z", "b"), (None, "p q", None), (4, "l " * 30_000, "c")])
    got = {(r.doc_id, r.size, r.source_size) for r in mix_sources(docs).collect()}
    assert got == {(1, 0, 0), (2, 0, 6), (3, 3, 6), (None, 2, 2), (4, 30_000, 30_000)}
    assert mix_sources(docs.limit(0)).count() == 0
    wordless = mix_sources(docs.where("doc_id = 1")).collect()
    assert [(r.target, r.taken) for r in wordless] == [(0.0, 0)]


def test_mixed_documents_repeat_rows(documents):
    docs = documents(rows_of(300), extra=["copies"])
    plan = {r.doc_id: r.copies for r in mix_sources(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.doc_id] += 1
    assert dict(counts) == {k: v for k, v in plan.items() if v}


def test_ring_keeps_loads_bounded_and_slots_gapless(documents):
    docs = documents([(i, "t" * (i * 31 % 500), "a") for i in range(4000)], extra=["shard", "slot"])
    got = shard_documents(docs, shards=10).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000))
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        text = "t" * (r.doc_id * 31 % 500)
        assert r.size == len(text) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(load.values()) / 10
    assert all(load[s] <= mean * 1.001 + 516 + 1 and load[s] >= mean * 0.9 for s in range(10))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_a_new_shard_moves_few_rows(documents):
    docs = documents([(i, "t" * (i * 31 % 500), "a") for i in range(6000)])
    before = {r.doc_id: r.shard for r in shard_documents(docs, shards=10, vnodes=128).collect()}
    after = {r.doc_id: r.shard for r in shard_documents(docs, shards=11, vnodes=128).collect()}
    assert sum(before[k] != after[k] for k in before) < 0.5 * len(before)


def test_ring_of_odd_rows(documents):
    docs = documents([(1, None), (None, "é"), (None, None), (2, ""), (3, "same"), (3, "same"), (4, "x" * 300_000)])
    got = shard_documents(docs, shards=3).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 16), (0, 18), (1, 16), (2, 16), (3, 20), (3, 20), (4, 300_016)]
    assert len({(r.shard, r.slot) for r in got}) == 7
    assert shard_documents(docs.limit(0), shards=3).count() == 0
    hot = documents([(7, "same text")] * 500)
    assert len({(r.shard, r.slot) for r in shard_documents(hot, shards=5).collect()}) == 500


def test_overflow_walks_clockwise():
    pieces = bounded_loads([(0, 0, 100), (1, 1, 10), (2, 2, 10)], 3, 0.0)
    assert pieces == [(0, 0, 0, 40, 0), (1, 1, 0, 10, 1), (2, 2, 0, 10, 2), (0, 3, 40, 70, 1), (0, 4, 70, 100, 2)]


def test_word_pattern_matches_python(documents, spark):
    text = "a b\x0bc\x1cd \t\n e f"
    got = mix_sources(documents([(1, text, "a")])).first()
    assert got.size == len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_wordless_documents_stay_below_the_cap(documents):
    """In a source at three times its size nothing is missing, so nobody gets a fourth copy."""
    docs = documents([(i, "w " * 50, "big") for i in range(40)] + [(100 + i, ["", None, "x"][i % 3], "small") for i in range(30)])
    got = mix_sources(docs, weights=(1, 1)).collect()
    assert {r.copies for r in got if r.doc_id >= 100} == {3}
    assert mixed_documents(docs, weights=(1, 1)).where("doc_id >= 100").count() == 90


def test_stage_forms_with_names_that_differ_in_case(spark, documents):
    docs = documents([(i, f"some words {i}", "a") for i in range(30)]).selectExpr("*", "upper(text) as Text", "-doc_id as DOC_ID")
    mixed = mixed_documents(docs).collect()
    assert mixed and all(r[1] == f"some words {r[0]}" and r[5] == r[1].upper() and r[6] == -r[0] for r in mixed)
    sharded = sharded_documents(docs, shards=4)
    assert sharded.columns == [*docs.columns, "shard_bytes", "shard", "slot"]
    rows = sharded.collect()
    assert sorted(r[0] for r in rows) == list(range(30)) and all(r[5] == f"SOME WORDS {r[0]}" and r[6] == -r[0] for r in rows)
    assert {(r[0], r[-2], r[-1]) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in shard_documents(docs, shards=4).collect()}


def brute_ring(rows, arcs, shards, slack):
    """The whole ring walked document by document: every arc's keys in order, against the bounds of all arcs before."""
    bound = ceil(sum(size for _, _, size, _ in rows) / shards * (1 + slack))
    by_arc = defaultdict(list)
    for row in rows:
        at = next((a for a in arcs if row[3] <= a[2]), arcs[0])
        by_arc[at[0]].append(row)
    loads = [(arc, shard, sum(r[2] for r in by_arc[arc])) for arc, shard, _ in arcs]
    room, spans, over = [bound] * shards, defaultdict(list), []
    for place, (arc, shard, load) in enumerate(loads):
        own = min(load, room[shard])
        room[shard] -= own
        spans[arc].append((0, own, shard))
        over += [(place, arc, own, load)] if load > own else []
    for place, arc, low, load in over:
        while low < load:
            place = (place + 1) % len(loads)
            part = min(load - low, room[loads[place][1]])
            room[loads[place][1]] -= part
            spans[arc].append((low, low + part, loads[place][1]))
            low += part
    out = {}
    for arc, inside in by_arc.items():
        begin = 0
        for key, _, size, position in sorted(inside, key=lambda r: (r[3], r[0])):
            out[key] = next(shard for low, high, shard in spans[arc] if low <= begin < high)
            begin += size
    return out


def test_shards_equal_a_walk_of_the_whole_ring(spark, documents):
    docs = documents([(i, "x" * (i * 37 % 500)) for i in range(400)])
    shards, vnodes, slack = 7, 16, 0.02
    arcs = [(r.arc, r["shard"], r.upto) for r in ring(spark, shards, vnodes).orderBy("arc").collect()]
    places = docs.select("doc_id", F.xxhash64("doc_id", F.crc32(F.encode("text", "UTF-8")).cast("long"))).collect()
    rows = [(d[0], None, len("x" * (d[0] * 37 % 500)) + 16, d[1]) for d in places]
    got = {r.doc_id: r["shard"] for r in shard_documents(docs, shards, vnodes, slack).collect()}
    assert got == brute_ring(rows, arcs, shards, slack)
    assert ring_nodes(0, 40) == 64 and ring_nodes(10**14, 40) * 40 * (8 << 30) >= 10**14


def test_a_further_shard_moves_little(documents):
    docs = documents([(i, f"text {i}") for i in range(4000)])
    before, after = ({r.doc_id: r["shard"] for r in shard_documents(docs, n).collect()} for n in (40, 41))
    assert sum(before[k] != after[k] for k in before) < 0.12 * len(before)
