import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import importance
from tallyforge.llm.importance import Settings, crc32_spans, cutoff, features, importance_resample


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs(words, longest):
    return [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, s):
    """Scores with sorting instead of selection; None keys come last."""
    def bucket(f):
        return zlib.crc32(f.encode()) % s.buckets

    of = [runs(words_of(t), s.longest) for _, t in docs]
    have = Counter(bucket(f) for fs in of for f in fs)
    want = Counter(bucket(f) for t in target for f in runs(words_of(t), s.longest))
    big, goal = sum(have.values()), sum(want.values())

    def gain(b):
        return math.floor(1000 * math.log((want[b] + 1) * (big + s.buckets) / ((have[b] + 1) * (goal + s.buckets))))

    rows = []
    for (key, text), fs in zip(docs, of):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(fs), weight, score, None, len(words_of(text)) >= s.min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, row in enumerate(able[:len(able) * s.percent // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def prose(rng, words):
    return " ".join(rng.choice(["Wald", "über", "x1", "the", "日本", "É", "q" * 70]) + str(rng.randrange(30)) + rng.choice(["", ".", ", -"])
                    for _ in range(words))


@pytest.mark.parametrize("s", [Settings(min_words=5, percent=30), Settings(longest=3, buckets=97, min_words=2, percent=50, seed=7)])
def test_resampling_equals_brute_force(spark, documents, s):
    rng = random.Random(s.longest)
    rows = [(i, prose(rng, rng.choice([0, 1, 4, 5, 30]))) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, "a b c d e f"), (None, "a b c d e f"), (200, None), (201, ""), (202, prose(rng, 9000))]
    target = [prose(rng, 20) for _ in range(9)] + [None, ""]
    docs = documents(rows, extra=["id", "Text2", "score", "bucket"])
    bench = spark.createDataFrame([(t,) for t in target], "text string").selectExpr("*", "1 as bucket")
    got = importance_resample(docs, bench, settings=s).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, target, s)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, sum(r["rank"] is not None for r in got) + 1))


def test_empty_tables(spark, documents):
    docs = documents([(1, "one two " * 20), (2, None)])
    none = docs.select("text").limit(0)
    s = Settings(percent=100)
    assert sorted(map(tuple, importance_resample(docs, none, settings=s).collect())) == brute([(1, "one two " * 20), (2, None)], [], s)
    assert importance_resample(docs.limit(0), none).count() == 0
    assert [r["rank"] for r in importance_resample(docs.where("doc_id = 2"), none).collect()] == [None]


def test_equal_rows_at_the_cut(spark, documents):
    docs = documents([(1, "w " * 25)] * 20)
    ranks = [r["rank"] for r in importance_resample(docs, docs, settings=Settings(percent=35)).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("rows", [[(i % 7, i % 3, i) for i in range(300)], [(1, 1, 1)] * 50, [(5, 0, 0)]])
def test_weighted_medians_find_every_place(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5).cache()
    for wanted in {1, 2, len(rows) // 3 + 1, len(rows)}:
        expected = sorted(rows)[wanted - 1] if wanted <= len(rows) else None
        assert cutoff(df, wanted) == expected
    assert cutoff(df, len(rows) + 1) is None
    df.unpersist()


def test_each_pass_discards_a_quarter(spark, monkeypatch):
    df = spark.range(4000).selectExpr("hash(id) % 100000 as a", "id as b").selectExpr("cast(a as long) a", "b").repartition(6).cache()
    passes = []
    real = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: passes.append(1) or real(self, *a, **k))
    cutoff(df, 1234)
    assert len(passes) <= 2 + math.log(4000) / math.log(4 / 3)


def test_span_checksums():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4800, 400)
    ends = starts + rng.integers(1, 199, 400)
    assert crc32_spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert not len(crc32_spans(data, starts[:0], ends[:0]))
    bucket, row, words = features(np.frombuffer(b"a b", np.uint8), np.array([0, 0, 3, 3]), importance.Settings(longest=2))
    assert row.tolist() == [1, 1, 1] and words.tolist() == [0, 2, 0]
    assert bucket.tolist() == [zlib.crc32(w) % 10_000 for w in (b"a", b"b", b"a b")]
