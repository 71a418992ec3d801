import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import chat_format as cf

NASTY = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "<\\s>", "[\\\\INST]", "<|endoftext|>", " ", "\n", "é", "日本", "😀", "ok", "assistant", "<<SYS>>"]


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@given(st.lists(st.sampled_from(NASTY), max_size=12).map("".join))
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert cf.unescape(cf.escape(text)) == text
    assert not any(c in cf.escape(text) for c in cf.CONTROL)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "[INST]", ""]), st.lists(st.sampled_from(NASTY), max_size=8).map("".join)),
                min_size=1, max_size=6))
def test_tokens_under_the_mask_are_the_learned_texts(turns):
    import public_tokenizers

    encode = cf.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text, spans = cf.render(turns, "assistant")
    ids, offsets = encode([text])[0]
    mask = cf.token_mask(spans, offsets)
    brute = [any(a <= s and e <= b for a, b in spans) for s, e in offsets]
    assert mask.tolist() == brute
    said = [cf.unescape(text[a:b]) for a, b in cf.masked_runs(mask, offsets[:, 0], offsets[:, 1])]
    assert said == [t for r, t in turns if r == "assistant" and t]
    assert [m.group(1, 2) for m in cf._TURN.finditer(text)] == [(cf.escape(r), cf.escape(t)) for r, t in turns]
    # The template's own strings are one token each, and no text gives such a token.
    own = {encode.tokenizer.token_to_id(c) for c in (cf.OPEN, cf.TEXT, cf.CLOSE)}
    assert sum(i in own for i in ids.tolist()) == 3 * len(turns)


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {conv: (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                   sum(len(t) for r, t in turns if r == "assistant"),
                   hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(),
                   sum(len(f"[INST]{cf.escape(r)}[/INST]{cf.escape(t)}</s>") for r, t in turns)) for conv, turns in out.items()}


@pytest.mark.parametrize("whole_bytes", [1 << 20, 400, 0])
def test_read_back_equals_brute_force(spark, path, whole_bytes):
    """Whole conversations, and long ones in pieces, one of which holds a third of all rows."""
    rng = random.Random(2)
    rows = [(rng.randrange(30), t, rng.choice(["user", "assistant", "system", None]), "".join(rng.choices(NASTY, k=rng.randint(0, 30)))) for t in range(300)]
    rows += [(500, t, "assistant" if t % 2 else "user", "word " * rng.randint(0, 60)) for t in range(150)]
    rows += [(7, None, "assistant", None), (7, 3, "assistant", "same"), (7, 3, "assistant", "same"), (None, 1, "user", "x"), (None, 0, "assistant", "y" * 5000),
             (900, 0, "user", ""), (901, 0, "assistant", ""), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as piece", "1 as conv", "'y' as TEXT")
    made = cf.format_conversations(turns, path, settings=cf.Settings(whole_bytes=whole_bytes, batch_chars=300)).cache()
    got = {r[0]: tuple(r)[1:] for r in cf.read_back(made).collect()}
    assert got == brute(rows)
    pieces = made.groupBy("conv_id").count().where("conv_id = 500").first()["count"]
    assert (pieces > 3) == (whole_bytes < 1 << 20)
    for r in made.collect():
        assert len(r.token_ids) == len(r.token_starts) == len(r.token_ends) == len(r.loss_mask)
        covered = np.zeros(len(r.formatted), bool)
        for a, b in zip(r.token_starts, r.token_ends):
            covered[a:b] = True
        assert covered.all()
    made.unpersist()


def test_empty_tables(spark, path):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.format_conversations(none, path).count() == 0 and cf.read_back(cf.format_conversations(none, path)).count() == 0
