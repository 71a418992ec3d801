import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm.token_count import TokenCounter, count_tokens, parts_of
from tallyforge.llm.url_automaton import Rule, ShiftAnd, judge_urls

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", glob=".*spam-*"), Rule("block", glob=".*spam-*/**")]


def as_regex(pattern):
    out = re.escape(pattern).replace(r"\*\*", ".*").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return re.compile(out, re.S)


@given(st.lists(st.text("ab/*?.", min_size=1, max_size=9), min_size=1, max_size=20), st.lists(st.text("ab/.", max_size=12), max_size=12))
def test_automaton_agrees_with_regular_expressions(patterns, texts):
    patterns = [re.sub(r"\*{3,}", "**", p) for p in patterns]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    hits = ShiftAnd(patterns).matches(data, np.cumsum([0, *map(len, raw)]))
    for i, text in enumerate(texts):
        for j, pattern in enumerate(patterns):
            assert hits[i, j] == bool(as_regex(pattern).fullmatch(text)), (text, pattern)


def test_verdicts_of_odd_urls(spark):
    rows = [(1, "HTTP://A.Example.NET/en/1?x=/de/"), (2, "http://example.net/fr/"), (3, "http://net/"), (4, "http://xnet/"), (5, None), (6, "no scheme"),
            (7, "http://a.org?q=http://b.net/"), (8, "http://spam-x.org/p"), (9, "http://" + "a" * 70_000 + ".net/x"), (1, "http://b.net"),
            (None, "http://b.net/é"), (10, "://net/"), (11, "http://org/x.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as verdict", "1 as host")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, RULES).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g for g in got if g[0] not in (1, None)}
    assert (1, "a.example.net", "/en/1", "example.net/en/", "allow") in got
    assert (1, "b.net", "", None, "allow") in got
    assert (None, "b.net", "/é", "net/", "block") in got
    assert by[2][3:] == ("net/", "block") and by[3][3:] == ("net/", "block") and by[4][3:] == (None, "allow")
    assert by[5] == (5, "", "", None, "allow") and by[6] == (6, "", "", None, "allow")
    assert by[7][1:] == ("a.org", "", None, "allow") and by[8][3:] == (None, "block") and by[9][3:] == ("net/", "block")
    assert by[10][1:] == ("net", "/", "net/", "block") and by[11][3:] == (None, "allow")
    assert judge_urls(pages.limit(0), RULES).count() == 0


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' \n\t\x1c é1!<|endoftext|>"), max_size=40), max_size=10))
def test_parts_add_up_to_whole_texts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = [*texts, "a <|endoftext|> b<|endoftext|>", "x" * 3000 + " " + " y" * 2000, "é  日本 " * 500]
    want = [len(whole.encode(t, add_special_tokens=False)) for t in texts]
    for most in (7, 64, 1 << 18):
        assert TokenCounter(path, most)(texts).tolist() == want
        assert all("".join(p for p, _ in parts_of(t, most)) == t for t in texts if t)
        assert all(n == len(p.encode()) for t in texts for p, n in parts_of(t, most))


def test_long_texts(tokenizer_path):
    """A text of 5 MB without blanks stays whole; one with blanks is split into parts of about a batch."""
    from tokenizers import Tokenizer

    solid, loose = "ab1" * 1_700_000, "word é " * 300_000
    assert [n for _, n in parts_of(solid, 1 << 18)] == [len(solid)]
    assert max(n for _, n in parts_of(loose, 1 << 18)) < (1 << 18) * 1.01
    whole = Tokenizer.from_file(tokenizer_path)
    assert TokenCounter(tokenizer_path)([loose, None, solid]).tolist() == [
        len(whole.encode(loose, add_special_tokens=False)), 0, len(whole.encode(solid, add_special_tokens=False))]


def test_token_counts_of_odd_rows(documents, tokenizer_path):
    docs = documents([(1, None), (2, ""), (3, "word " * 600), (3, "word " * 600), (None, "é")], extra=["n_tokens", "Text2"])
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, tokenizer_path).collect())
    assert got == [(0, 2, 1, False), (1, 0, 0, False), (2, 0, 0, False), (3, 3000, 601, True), (3, 3000, 601, True)]
    assert count_tokens(docs.limit(0), tokenizer_path).count() == 0
