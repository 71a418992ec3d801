import random
import zlib

import math
import re
from collections import Counter

import numpy as np

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyforge.llm import quality_vote, toxicity_pu
from tallyforge.llm.common import SpanHasher, mix, fold


def area(labels, scores):
    """Share of (1, 0) pairs in the right order, ties half."""
    one, zero = scores[labels == 1], scores[labels == 0]
    return ((one[:, None] > zero) + 0.5 * (one[:, None] == zero)).mean()


def held_out_area(spark, sf, name, label, folds, rest):
    scored = entry.queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == rest) for r in scored)
    held = [r for r in scored if r.held_out]
    return area(np.array([r[label] for r in held]), np.array([r.score for r in held]))


def test_quality_on_held_out_rows(spark):
    assert held_out_area(spark, "/root/testdata/sf0.01", "op1_quality", "quality", 4, 2) > 0.97


def test_toxicity_on_held_out_rows(spark):
    assert held_out_area(spark, "/root/testdata/sf0.1", "op7_toxicity", "toxic", 5, 0) > 0.97


def test_votes_are_the_exact_nearest_neighbours():
    rng = np.random.default_rng(0)
    s = quality_vote.Settings(neighbours=5)
    texts = [("THE CAT!! " if i % 3 else "the cat sat. ") * (i % 7 + 1) for i in range(60)]
    raw = [t.encode() for t in texts]
    terms = quality_vote.weighed(quality_vote.term_counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), SpanHasher()))
    labels = rng.integers(0, 2, 60).astype(float)
    voters = quality_vote.fit_voters(terms.astype(np.float64), labels, s)
    got = voters.score(terms, s)
    for row, latent in enumerate(voters.latent(terms)):
        cosine = voters.vectors @ latent
        best = sorted(range(60), key=lambda i: -cosine[i])[:5]
        if cosine[best[-1]] - sorted(cosine)[-6] < 1e-6:  # copies at the fifth place: any of them may vote
            least, most = (sorted((labels[i] for i in range(60) if abs(cosine[i] - cosine[best[-1]]) < 1e-6), reverse=r) for r in (False, True))
            firm = [i for i in best if cosine[i] - cosine[best[-1]] >= 1e-6]
            choices = [[*(labels[i] for i in firm), *side[:5 - len(firm)]] for side in (least, most)]
        else:
            choices = [[labels[i] for i in best]] * 2
        weight = np.maximum(cosine[best], 0) ** s.sharpness
        votes = [(weight @ np.array(c) + s.shrink * voters.prior) / (weight.sum() + s.shrink) for c in choices]
        assert votes[0] - 1e-5 <= got[row] <= votes[1] + 1e-5


def test_toxicity_equals_a_plain_computation(spark, documents):
    """Word beginnings, chosen features, sample and score from plain Python sets; only the fit itself is shared."""
    rng, s = np.random.default_rng(3), toxicity_pu.Settings(features=20, support=2, epochs=5)
    stems = ["vile", "scum", "garden", "window", "paper", "river", "été", "Haus"]
    rows = []
    for i in range(240):
        mean = i % 4 == 0
        words = rng.choice(stems if mean else stems[2:], 12)
        rows.append((i, " ".join(w + rng.choice(["", "s", "ing"]) for w in words) + "."))
    docs, held = documents(rows), F.col("doc_id") % 5 == 0
    confirmed, prior = spark.range(240).where("id % 8 = 0 and id % 5 <> 0").withColumnRenamed("id", "doc_id"), 0.25
    got = {r.doc_id: r.score for r in toxicity_pu.score_toxicity(docs, confirmed, prior, held, settings=s).collect()}

    def buckets(text):
        out = set()
        for word in re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower()):
            for size in range(toxicity_pu.SHORTEST, min(len(word), toxicity_pu.LONGEST) + 1):
                code = np.array([int.from_bytes(word[:size], "little") + size - 1], np.uint64)
                out.add(int(mix(code)[0] >> np.uint64(64 - toxicity_pu.BITS)))
        return out

    draw = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    kept = {side: {} for side in (True, False)}
    for key, text in rows:
        if key % 5:
            kept[False][text] = draw[key]
            if key % 8 == 0:
                kept[True][text] = draw[key]
    n_pos, n_all = len(kept[True]), len(kept[False])
    count = {side: Counter(b for text in kept[side] for b in buckets(text)) for side in kept}
    contrast = {}
    for b, n in count[True].items():
        a = count[False][b] / n_all
        if n >= s.support and n / n_pos > a and n / n_pos * prior >= s.purity * a:
            contrast[b] = (n / n_pos - a) / math.sqrt(a + 1 / n_all)
    chosen = sorted(contrast, key=lambda b: (-contrast[b], b))[:s.features]
    seen = {side: np.array([[b in buckets(t) for b in chosen] for t in sorted(kept[side], key=kept[side].get)]) for side in kept}
    weights, bias = toxicity_pu.fit_nnpu(seen[True], seen[False], prior, s)
    for key, text in rows:
        z = sum(w for b, w in zip(chosen, weights) if b in buckets(text)) + bias
        assert got[key] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_quality_of_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "a b c " * 50_000), (3, "x"), (None, "some text here"), (4, "X!! Y!! Z!!")], extra=["score", "mark"])
    labels = spark.createDataFrame([(4, 0), (3, 1), (None, 1), (99, None)], "doc_id long, quality int")
    got = quality_vote.vote_quality(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    blank = quality_vote.vote_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in blank} == {0.5}
    assert quality_vote.vote_quality(docs.limit(0), labels).count() == 0


def test_risk_with_a_prior_beats_plain_labels():
    """Positives carry one mark, unlabelled rows are a mix: the fit must not learn to call unlabelled positives negative."""
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    noise = rng.random((4000, 40)) < 0.2
    marks = (rng.random((4000, 5)) < 0.5) & truth[:, None]
    unlabelled = np.hstack([marks, noise])
    positive = np.hstack([rng.random((500, 5)) < 0.5, rng.random((500, 40)) < 0.2])
    weights, bias = toxicity_pu.fit_nnpu(positive, unlabelled, 0.3, toxicity_pu.Settings())
    says = unlabelled @ weights + bias > 0
    assert (says == truth).mean() > 0.93


def test_word_beginnings_stay_in_their_row():
    raw = [b"Abcd, ab", b"c abcd", b""]
    rows, buckets = toxicity_pu.prefix_buckets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, 8, 6, 0]))
    assert sorted(rows.tolist()) == [0, 0, 1, 1]
    assert set(buckets[rows == 0]) == set(buckets[rows == 1])


def test_toxicity_of_odd_rows(spark, documents):
    random.seed(3)
    words = ["alder", "birch", "cedar", "maple", "spruce", "willow"]
    rows = [(i, " ".join(random.choices(words, k=12)) + (" nasty nastier" if i % 4 == 0 else "")) for i in range(400)]
    docs = documents([*rows, (400, None), (401, ""), (402, "alder " * 60_000 + "nasty"), (402, "alder"), (None, "nasty")], extra=["predicted"])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    held = fold("doc_id", 5) == 0
    confirmed, prior = toxicity_pu.confirmed_toxic(labels, held)
    got = toxicity_pu.score_toxicity(docs, confirmed, prior, held).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.predicted for r in got if r.doc_id is not None and r.doc_id < 402}
    assert sum(by[i] != (i % 4 == 0) for i in range(400)) <= 4 and by[400] == by[401] == 0
    assert {r.predicted for r in got if r.doc_id is None} == {1}
    kept = toxicity_pu.score_toxicity(docs, confirmed, prior, held, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity_pu.score_toxicity(docs.limit(0), confirmed, prior, held).count() == 0
    alone = toxicity_pu.score_toxicity(docs, confirmed.limit(0), 0.25, held).collect()
    assert {round(r.score, 6) for r in alone} == {0.25}
