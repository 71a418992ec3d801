"""Conversations rendered by a template and encoded once, with a loss mask aligned to the tokens by their offsets."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyforge.llm.common import pick, stored

#: Fixed strings of the template: a turn is OPEN role TEXT text CLOSE.
OPEN, TEXT, CLOSE = "[INST]", "[/INST]", "</s>"
#: Whatever a reader of the format could take for control: the template's strings and their relatives.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>")
_NAMES = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE, _UNESCAPE = re.compile(rf"([<\[])(\\*)({_NAMES})"), re.compile(rf"([<\[])\\(\\*)({_NAMES})")
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(TEXT)}(.*?){re.escape(CLOSE)}", re.S)


@dataclass(frozen=True)
class Settings:
    """Turns of `learned` are under the loss mask. Conversations of over `whole_bytes` are written in pieces of whole turns."""

    learned: str = "assistant"
    whole_bytes: int = 1 << 20
    batch_chars: int = 1 << 20


def escape(text: str) -> str:
    """Puts a backslash behind the first character of every control string, and one more where some stand there already."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    """Takes back what `escape` did."""
    return _UNESCAPE.sub(r"\1\2\3", text)


class Encoder:
    """Token ids and code point offsets of rendered text; the template's strings are tokens of their own, special strings are text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.add_tokens([AddedToken(mark, normalized=False, special=False) for mark in (OPEN, TEXT, CLOSE)])

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids, and start and end of each token as an n x 2 array."""
        return [(np.array(e.ids, np.int32), np.array(e.offsets, np.int32).reshape(-1, 2))
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


def render(turns: list[tuple[str, str]], learned: str) -> tuple[str, np.ndarray]:
    """The rendered turns, and the sorted spans (n x 2) of the texts of `learned` in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{TEXT}", escape(text)
        if role == learned and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def token_mask(spans: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the sorted spans: the first span that ends behind the token's start must begin at it or before."""
    if not len(spans):
        return np.zeros(len(offsets), bool)
    nearest = np.minimum(np.searchsorted(spans[:, 1], offsets[:, 0], side="right"), len(spans) - 1)
    return (spans[nearest, 0] <= offsets[:, 0]) & (offsets[:, 1] <= spans[nearest, 1])


def masked_runs(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Code point ranges under the mask, one for each run of tokens."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


#: So many conversations at most are named in a broadcast.
BROADCAST_ROWS = 100_000
FORMATTED = ("piece long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, "
             "loss_mask array<boolean>")


def ordered_turns(rows: DataFrame, whole_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The turns (conv, turn, role, text, ranges) of short and of long conversations, dealt out and sorted for one pass each.

    A short conversation stands in one task as a whole. Long ones are dealt by ranges of conversation and turn, so one that holds
    a large part of all rows is spread over many tasks; a row tells by `tie` where equal rows go.
    """
    sizes = rows.groupBy("conv").agg(F.sum(F.octet_length("text") + F.octet_length("role") + 32).alias("bytes"))
    long = stored(sizes.where(F.col("bytes") > whole_bytes).select(F.col("conv").alias("long_conv")), "long-conversations")
    if long.count() <= BROADCAST_ROWS:
        long = F.broadcast(long)
    is_long = F.col("conv").eqNullSafe(F.col("long_conv"))
    order = ["conv", "turn", "role", "text"]
    short = rows.join(long, is_long, "left_anti").repartition("conv").sortWithinPartitions(*order)
    tied = rows.join(long, is_long, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange("conv", "turn", "role", F.xxhash64("text"), "tie").sortWithinPartitions(*order, "tie").drop("tie")
    return short, spread


def format_conversations(turns: DataFrame, tokenizer: str, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per conversation, or per piece of a long one: key, piece, last, formatted, token_ids, token_starts, token_ends, loss_mask.

    Turns stand by `turn` (null first), then role, then text; repeated rows are turns of their own; null roles and texts count as
    empty. Every turn is rendered with its role, control strings inside roles and texts are escaped reversibly, the whole rendering
    is encoded once, and a token is under the loss mask if it lies in the span of a text of the learned role. Starts and ends are
    code points of `formatted`. A null key is a conversation like others. Empty tables give no rows. The first column of an exact
    name is taken; others may be called anything. `tokenizer` is the path of a byte-level tokenizer file for the `tokenizers` library.

    Conversations of up to `whole_bytes` are one row with piece 0. Longer ones are cut between turns, which no token crosses, into
    pieces of ascending `piece`; a task renders and encodes about `batch_chars` at a time. `last` is true for whole conversations.
    """
    s = settings
    rows = pick(turns, key, turn, role, text).select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    kind, key_type = rows.schema["conv"].dataType.simpleString(), to_arrow_type(rows.schema["conv"].dataType)
    short, long = ordered_turns(rows, s.whole_bytes)

    def formatted(whole: bool):
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            encode, number = Encoder(tokenizer), TaskContext.get().partitionId() << 40
            ready, size = [], 0
            for conv, said in runs(batches, None if whole else s.batch_chars):
                ready.append((conv, *render(said, s.learned)))
                size += len(ready[-1][1])
                if size >= s.batch_chars:
                    yield packed_rows(ready, encode, whole, number, key_type)
                    number, ready, size = number + len(ready), [], 0
            if ready:
                yield packed_rows(ready, encode, whole, number, key_type)
        return work

    schema = f"conv {kind}, {FORMATTED}"
    # `last` is a literal of either side, so that a filter by it reads that side only.
    pieces = short.mapInArrow(formatted(True), schema).withColumn("last", F.lit(True)).union(
        long.mapInArrow(formatted(False), schema).withColumn("last", F.lit(False)))
    return pieces.select(F.col("conv").alias(key), "piece", "last", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask")


def runs(batches: Iterable[pa.RecordBatch], most: int | None) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """Conversations of sorted rows with their turns; with `most` they are cut when so many characters are together."""
    conv, turns, size = None, [], 0
    for batch in batches:
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if turns and (key != conv or most is not None and size >= most):
                yield conv, turns
                turns, size = [], 0
            conv = key
            turns.append((role, text))
            size += len(text)
    if turns:
        yield conv, turns


def packed_rows(ready: list, encode: Encoder, whole: bool, number: int, key_type: pa.DataType) -> pa.RecordBatch:
    encoded = encode([text for _, text, _ in ready])
    masks = [token_mask(spans, offsets) for (_, _, spans), (_, offsets) in zip(ready, encoded)]
    ends = np.cumsum([0, *[len(ids) for ids, _ in encoded]]).astype(np.int32)
    offsets = np.concatenate([o for _, o in encoded])

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return pa.RecordBatch.from_arrays([
        pa.array([conv for conv, _, _ in ready], key_type), pa.array([0] * len(ready) if whole else range(number, number + len(ready)), pa.int64()),
        pa.array([text for _, text, _ in ready]), lists(np.concatenate([ids for ids, _ in encoded])),
        lists(np.ascontiguousarray(offsets[:, 0])), lists(np.ascontiguousarray(offsets[:, 1])), lists(np.concatenate(masks))],
        names=["conv", "piece", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"])


class Digest:
    """Running digests of a conversation that is read back piece by piece from what was written."""

    def __init__(self) -> None:
        self.turns, self.loss, self.n_turns, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> None:
        at = 0
        for turn in _TURN.finditer(formatted):
            if turn.start() != at:
                raise ValueError("text outside of turns")
            at = turn.end()
            self.turns.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            self.n_turns += 1
        if at != len(formatted):
            raise ValueError("text outside of turns")
        for a, b in masked_runs(mask, starts, ends):
            text = unescape(formatted[a:b])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted rows.

    turns_sha256 is the digest of role, line break, text, line break of every turn; loss_sha256 that of all text under the loss
    mask without its escapes. Rows that hold a whole conversation are read where they are; pieces of long ones are brought
    together in order and streamed through the digests, a batch at a time.
    """
    kind, key_type = formatted.schema[key].dataType.simpleString(), to_arrow_type(formatted.schema[key].dataType)
    schema = (f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        first, *rest = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(first, key_type), *map(pa.array, rest)], names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_digest, done = None, None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("formatted", "token_starts", "token_ends", "loss_mask")]
            for i, (now, last) in enumerate(zip(batch.column(key).to_pylist(), batch.column("last").to_pylist())):
                if open_digest is None or last or now != conv:
                    if open_digest is not None:
                        done.append((conv, *open_digest.row()))
                    conv, open_digest = now, Digest()
                text, starts, ends, mask = (c[i] for c in columns)
                open_digest.add(text.as_py(), *(x.values.to_numpy(zero_copy_only=False) for x in (starts, ends, mask)))
                if last:
                    done.append((conv, *open_digest.row()))
                    open_digest = None
            if done:
                yield rows_of(done)
                done = []
        if open_digest is not None:
            yield rows_of([(conv, *open_digest.row())])

    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    narrow = formatted.select(key, "piece", "last", "formatted", "token_starts", "token_ends", "loss_mask")
    together = narrow.where(~F.col("last")).repartition(key).sortWithinPartitions(key, "piece")
    return narrow.where("last").mapInArrow(work, schema).union(together.mapInArrow(work, schema))
