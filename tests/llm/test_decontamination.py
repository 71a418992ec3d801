import random

import numpy as np

from tallyforge.llm import decontaminate as dc


def distance_inside(pattern, text):
    """Fewest edits of the pattern against any stretch of the text, cell by cell."""
    before = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (p != t)))
        before = now
    return min(before)


def prose(rng, words):
    stems = ["".join(rng.choices("etaoinshr", k=rng.randint(1, 7))) for _ in range(60)]
    return " ".join(rng.choices(stems, k=words))


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + "z" + text[at:], text[:at] + "q" + text[at + 1:]])
    return text


def normal(text):
    codes, _, _ = dc.normal_codes([text])
    return "".join(map(chr, codes)).strip()


def test_every_passage_within_its_budget_is_found_and_nothing_else():
    rng = random.Random(5)
    s = dc.Settings()
    items = [(i, prose(rng, rng.randint(8, 18))) for i in range(12)]
    passages = dc.Passages(items, s)
    texts, planted = [], []
    for n in range(60):
        text = prose(rng, rng.randint(5, 80))
        if n % 2:
            item, body = rng.choice(items)
            passage = edited(rng, body, rng.randint(0, 9))
            text = text + ". " + passage.upper().replace(" ", "\n", 1) + " " + prose(rng, 10)
            planted.append((n, item))
        texts.append(text)
    got = {(t, i) for t, i, *_ in dc.find_in_texts(texts, passages)}
    for n, text in enumerate(texts):
        line = normal(text)
        for item in {i for i, _ in items}:
            windows = [k for k in range(len(passages.item)) if passages.item[k] == item]
            near = any(distance_inside("".join(map(chr, passages.codes[k])), line) <= passages.budget[k] for k in windows)
            assert near == ((n, item) in got), (n, item)
    # Up to nine edits: some planted passages are within their budget, some are not.
    assert 0 < len(got & set(planted)) < len(planted)


def stretches(item, s):
    """Every stretch of the item that the settings promise to find, each with its edits."""
    line = normal(item)
    width = min(len(line), s.window)
    return [(line[i:i + width], min(width // s.per_edit, (width - s.q + 1 - s.floor) // s.q)) for i in range(len(line) - width + 1)]


def test_a_verbatim_stretch_is_found_from_every_start():
    rng = random.Random(11)
    s = dc.Settings()
    item = prose(rng, 90)[:300].strip()
    passages = dc.Passages([(1, item)], s)
    line = normal(item)
    texts = [prose(rng, 30) + " " + line[at:at + s.window] + " " + prose(rng, 30) for at in range(len(line) - s.window + 1)]
    assert {t for t, *_ in dc.find_in_texts(texts, passages)} == set(range(len(texts)))


def test_stretches_of_long_items_are_found_like_by_brute_force():
    rng = random.Random(12)
    s = dc.Settings(window=40, per_edit=10, q=4, floor=5)
    items = [(i, prose(rng, rng.randint(12, 30))) for i in range(4)]
    texts = []
    for n in range(50):
        item = normal(rng.choice(items)[1])
        at = rng.randrange(max(1, len(item) - 36))
        passage = edited(rng, item[at:at + rng.randint(36, 60)], rng.randint(0, 6))
        texts.append(prose(rng, rng.randint(0, 8)) + " " + passage + " " + prose(rng, rng.randint(0, 8)))
    got = {(t, i) for t, i, *_ in dc.find_in_texts(texts, dc.Passages(items, s))}
    want = {(n, i) for n, text in enumerate(texts) for i, body in items
            if any(distance_inside(part, normal(text)) <= k for part, k in stretches(body, s))}
    assert got == want and 10 < len(want) < 50


def test_spans_and_edits_are_those_of_the_text():
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    passages = dc.Passages([(7, item)], dc.Settings())
    text = "é Before it: The quick brown fox jumpz over the lazy dog, near the river bank! After."
    (found,) = dc.find_in_texts(["nothing", text], passages)
    assert found[:2] == (1, 7) and found[4] == 1
    assert text[found[2]:found[3]] == "The quick brown fox jumpz over the lazy dog, near the river bank"


def test_long_texts_are_searched_in_pieces():
    rng = random.Random(6)
    item = prose(rng, 25)
    s = dc.Settings(piece=5000)
    filler = prose(rng, 4000)
    cut = filler[:4950]
    text = cut + " " + item + " " + filler
    found = dc.find_in_texts([text], dc.Passages([(1, item)], s))
    assert len(found) == 1 and found[0][:2] == (0, 1) and text[found[0][2]:found[0][3]] == item
    assert found == dc.find_in_texts([text], dc.Passages([(1, item)], dc.Settings()))


def test_pieces_are_cut_by_normalised_characters():
    rng = random.Random(9)
    item = prose(rng, 30)
    passages, small = dc.Passages([(1, item)], dc.Settings()), dc.Passages([(1, item)], dc.Settings(piece=1000))
    for gap in (1, 30, 700, 2500):
        for before in range(0, 1000, 83):
            text = prose(rng, 400)[:before] + " # " + item.replace(" ", " " + "-" * gap + " ") + " # " + prose(rng, 300)
            found = dc.find_in_texts([text], small)
            assert len(found) == 1 and found == dc.find_in_texts([text], passages), (gap, before)
    text = "".join(rng.choices("ab -.", k=3000))
    codes, _, origin = dc.normal_codes([text])
    for size in (1, 7, 500):
        parts = list(dc.pieces_of(text, size, 5000))
        assert (parts[-1][0] == codes).all() and (parts[-1][1] == origin).all() and not parts[-1][2]


def test_band_alignment_equals_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pattern, letters = rng.integers(0, 3, (4, 12)), rng.integers(0, 3, (4, 12 + 12))
        cost, stop = dc.band_align(pattern, letters, 12)
        for k in range(4):
            assert cost[k] >= distance_inside(pattern[k].tolist(), letters[k].tolist())
            assert cost[k] == distance_inside(pattern[k].tolist(), letters[k].tolist()) or stop[k] > 0


def test_odd_rows(spark, documents):
    rng = random.Random(8)
    item = prose(rng, 20)
    docs = documents([(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, prose(rng, 60_000)), (5, item[:30])], extra=["item_id", "edits"])
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "too short"), (None, item)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in dc.find_passages(docs, bench).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (3, 0), (3, 0), (3, 1), (3, 1), (3, 2), (3, 2)]
    small = dc.Settings(block_chars=100)
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in dc.find_passages(docs, bench, settings=small).collect()) == got
    kept = dc.without_passages(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    assert dc.find_passages(docs.limit(0), bench).count() == 0 and dc.find_passages(docs, bench.limit(0)).count() == 0


def test_items_without_an_id_and_short_items(spark, documents):
    rng = random.Random(8)
    passage = prose(rng, 30)
    bench = spark.createDataFrame([(None, passage), (7, "Short one!"), (8, "short  ONE"), (None, "tiny"), (9, "?!"), (10, None)], "item_id long, text string")
    rows = [(1, prose(rng, 20) + " " + passage + " end"), (2, " -short one. "), (3, "a short one here"), (4, "Tiny"), (5, "!"), (6, None), (7, ""),
            (8, " " * 90 + "short" + "." * 200 + "one" + "\n" * 300)]
    docs = documents(rows).selectExpr("*", "'x' as TEXT")
    for piece in (1 << 20, 256):
        s = dc.Settings(piece=piece)
        got = dc.find_passages(docs, bench, settings=s).collect()
        assert sorted((r.doc_id, r.item_id or 0) for r in got) == [(1, 0), (2, 7), (2, 8), (4, 0), (8, 7), (8, 8)]
        assert {(r.start, r.end) for r in got if r.doc_id == 2} == {(2, 11)} and {(r.start, r.end) for r in got if r.doc_id == 8} == {(90, 298)}
        left = dc.without_passages(docs, bench, settings=s)
        assert left.columns == docs.columns and sorted(r[0] for r in left.collect()) == [3, 5, 6, 7]
