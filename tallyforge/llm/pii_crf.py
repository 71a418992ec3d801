"""Personal data in texts: exact base patterns, and spans that a linear-chain conditional random field adds from word shapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm.common import SpanHasher, blocks, packed, pick, word_spans

KINDS = ("email", "ip", "card", "phone")
#: O, then begin and inside of each kind.
LABELS = 1 + 2 * len(KINDS)
SHAPE_BITS = 13
COARSE = 8 * 2 * 2 * 2 * 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every `@` with a local part before it and a dotted domain after it, in one pass; a part is never used twice."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Start and end of the base matches per kind, in the order of KINDS; matches that fail their check are dropped."""
    ips = [m.span() for m in IP.finditer(text)
           if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.groups())]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return [emails(text), ips, cards, phones]


# Word shapes

CLASS = np.full(256, 1, np.uint8)
for _group, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "@", ".", "-", "+", "(", ")", ",;:!?", "/", "[]{}<>", "_%#*$&=~^'\"`|\\")):
    CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _group + 2
DIGIT, AT, DOT, PLUS, OPEN = 3, 4, 5, 7, 8
#: Digits are counted exactly up to four, then in ranges.
RUN = np.array([0, 1, 2, 3, 4, 5, 5, 5, 5, 5, 6, 6, 6, 6, 6, 6, 7], np.uint8)
DIGITS = np.array([0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5, 5, 5, 6, 6, 6, 6, 7], np.int64)
BREAKS = np.zeros(256, bool)
BREAKS[[ord("."), ord("!"), ord("?")]] = True


class Words:
    """The words of a block with their shape and coarse features, and the sequences they form.

    Words are runs without blanks. A sequence ends with its line, with its text, and after a word that ends in `.`, `!` or `?`.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> None:
        self.starts, self.ends, self.row = word_spans(data, offsets)
        n = len(self.starts)
        self.shape = self.coarse = np.zeros(n, np.int64)
        self.heads = np.empty(0, np.int64)
        if not n:
            return
        kind = CLASS[data]
        word_at = np.zeros(len(data), bool)
        word_at[self.starts] = True
        turns = word_at.copy()
        turns[1:] |= kind[1:] != kind[:-1]
        runs = np.flatnonzero(turns)
        length = np.diff(np.append(runs, len(data)))
        symbol = kind[runs] * np.uint8(8) + np.where(kind[runs] == DIGIT, RUN[np.minimum(length, 16)], 0).astype(np.uint8)
        first, last = np.searchsorted(runs, self.starts), np.searchsorted(runs, self.ends)
        self.shape = (hasher(symbol, first, last) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)

        def count(which: int) -> np.ndarray:
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(kind == which, out=total[1:])
            return total[self.ends] - total[self.starts]

        lead = kind[self.starts]
        coarse = DIGITS[np.minimum(count(DIGIT), 20)]
        coarse = coarse * 2 + (count(AT) > 0)
        coarse = coarse * 2 + (lead == PLUS)
        coarse = coarse * 2 + (lead == OPEN)
        self.coarse = coarse * 4 + np.minimum(count(DOT), 3)
        lines = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=lines[1:])
        fresh = np.ones(n, bool)
        fresh[1:] = (self.row[1:] != self.row[:-1]) | (lines[self.starts[1:]] != lines[self.starts[:-1]]) | BREAKS[data[self.ends[:-1] - 1]]
        self.heads = np.flatnonzero(fresh)

    def features(self) -> list[np.ndarray]:
        """Feature numbers per word: own shape, own coarse shape, and the coarse shapes before and after within the sequence."""
        n = len(self.starts)
        edge = COARSE
        before, after = np.full(n, edge), np.full(n, edge)
        before[1:], after[:-1] = self.coarse[:-1], self.coarse[1:]
        before[self.heads] = edge
        after[self.heads[1:] - 1] = edge
        return [self.shape, self.coarse, before, after]


class Field:
    """Weights of the chain: one table per feature, label transitions and start scores."""

    SIZES = (1 << SHAPE_BITS, COARSE, COARSE + 1, COARSE + 1)

    def __init__(self) -> None:
        self.tables = [np.zeros((size, LABELS), np.float32) for size in self.SIZES]
        self.steps = np.zeros((LABELS, LABELS), np.float32)
        self.start = np.zeros(LABELS, np.float32)
        # An inside label only follows its own kind.
        self.barred = np.zeros((LABELS, LABELS), bool)
        for inside in range(2, LABELS, 2):
            self.barred[:, inside] = True
            self.barred[[inside - 1, inside], inside] = False

    def emissions(self, features: list[np.ndarray]) -> np.ndarray:
        total = self.tables[0][features[0]]
        for table, numbers in zip(self.tables[1:], features[1:]):
            total += table[numbers]
        return total

    def moves(self) -> np.ndarray:
        return np.where(self.barred, np.float32(-1e4), self.steps)

    def opening(self) -> np.ndarray:
        return np.where(np.arange(LABELS) % 2 == (np.arange(LABELS) > 0), self.start, np.float32(-1e4))

    def fit(self, features: list[np.ndarray], heads: np.ndarray, labels: np.ndarray, rounds: int = 250, rate: float = 0.1,
            decay: float = 0.02) -> None:
        """Maximum likelihood with a quadratic penalty, by Adam; the expected counts come from forward and backward sums."""
        lengths = np.diff(np.append(heads, len(labels)))
        wide = lengths.max()
        at = heads[:, None] + np.minimum(np.arange(wide), lengths[:, None] - 1)
        live = np.arange(wide) < lengths[:, None]
        params = [*self.tables, self.steps, self.start]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        inner = np.ones(len(labels), bool)
        inner[heads] = False
        pair_to = np.flatnonzero(inner)
        for step in range(1, rounds + 1):
            e, moves = self.emissions(features)[at].astype(np.float64), self.moves().astype(np.float64)
            ahead, back = np.zeros(e.shape), np.zeros(e.shape)
            ahead[:, 0] = self.opening() + e[:, 0]
            for t in range(1, wide):
                grown = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + e[:, t]
                ahead[:, t] = np.where(live[:, t, None], grown, ahead[:, t - 1])
            for t in range(wide - 2, -1, -1):
                shrunk = np.logaddexp.reduce(moves + (e[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
                back[:, t] = np.where(live[:, t + 1, None], shrunk, 0)
            norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
            slopes = [np.zeros_like(p) for p in params]
            belief = np.exp(ahead + back - norm[:, None, None])[live]
            belief[np.arange(len(labels)), labels] -= 1
            for slope, numbers in zip(slopes, features):
                np.add.at(slope, numbers, belief.astype(np.float32))
            pairs = np.exp(ahead[:, :-1, :, None] + moves + (e[:, 1:] + back[:, 1:])[:, :, None, :] - norm[:, None, None, None])
            slopes[4] += pairs[live[:, 1:]].sum(axis=0).astype(np.float32)
            np.add.at(slopes[4], (labels[pair_to - 1], labels[pair_to]), -1)
            slopes[5] += belief[heads].sum(axis=0).astype(np.float32)
            for p, slope, (first, second) in zip(params, slopes, moments):
                slope += decay * p
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                p -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)

    def decode(self, features: list[np.ndarray], heads: np.ndarray) -> np.ndarray:
        """Best labels by Viterbi, all sequences side by side; the longest stay to the end."""
        n = len(features[0])
        labels = np.zeros(n, np.int64)
        if not n:
            return labels
        lengths = np.diff(np.append(heads, n))
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = heads[order], lengths[order]
        live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        e, moves = self.emissions(features), self.moves().T.copy()
        back = np.zeros((n, LABELS), np.int8)
        score = self.opening() + e[begin]
        for t in range(1, len(live)):
            at = begin[:live[t]] + t
            options = score[:live[t], None, :] + moves
            pick_from = options.argmax(axis=2)
            back[at] = pick_from
            score[:live[t]] = np.take_along_axis(options, pick_from[:, :, None], axis=2)[:, :, 0] + e[at]
        state = score.argmax(axis=1)
        for t in range(len(live) - 1, -1, -1):
            at = begin[:live[t]] + t
            labels[at] = state[:live[t]]
            if t:
                state[:live[t]] = back[at, state[:live[t]]]
        return labels


TAG = re.compile(r"<(email|ip|card|phone)>(.*?)</\1>")


def parse_tagged(lines: Iterable[str]) -> tuple[bytes, np.ndarray, list[tuple[int, int, int]]]:
    """Text of tagged lines as bytes, offsets of the lines, and the tagged spans (kind, start, end) in bytes."""
    text, offsets, spans = bytearray(), [0], []
    for line in lines:
        at = 0
        for m in TAG.finditer(line):
            text += line[at:m.start()].encode()
            start = len(text)
            text += m.group(2).encode()
            spans.append((KINDS.index(m.group(1)), start, len(text)))
            at = m.end()
        text += line[at:].encode()
        offsets.append(len(text))
    return bytes(text), np.array(offsets), spans


def fit_field(tagged: Iterable[str]) -> Field:
    """A field fitted to a small table of lines with tags such as `<phone>...</phone>` around the words of a span."""
    raw, offsets, spans = parse_tagged(tagged)
    words = Words(np.frombuffer(raw, np.uint8), offsets, SpanHasher())
    labels = np.zeros(len(words.starts), np.int64)
    for kind, start, end in spans:
        inside = np.flatnonzero((words.ends > start) & (words.starts < end))
        labels[inside] = 2 * kind + 2
        labels[inside[:1]] = 2 * kind + 1
    field = Field()
    if len(labels):
        field.fit(words.features(), words.heads, labels)
    else:
        field.start[0] = 1e3
    return field


#: Marks that may open or close a span; anything else at its ends is trimmed.
OPENS = frozenset(b"+(0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
CLOSES = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def added_spans(data: np.ndarray, offsets: np.ndarray, field: Field, hasher: SpanHasher) -> dict[int, list[tuple[int, int, int]]]:
    """Spans (kind, start, end) in code points by row, as the field labels the words, trimmed to their outer letters and digits."""
    words = Words(data, offsets, hasher)
    labels = field.decode(words.features(), words.heads) if len(words.starts) else np.zeros(0, np.int64)
    begins = np.flatnonzero(labels % 2 == 1)
    if not len(begins):
        return {}
    stops = np.flatnonzero((labels == 0) | (labels % 2 == 1))
    after = np.append(stops, len(labels))[np.searchsorted(stops, begins, side="right")]
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    out: dict[int, list[tuple[int, int, int]]] = {}
    for word, last in zip(begins.tolist(), (after - 1).tolist()):
        start, end, row = int(words.starts[word]), int(words.ends[last]), int(words.row[word])
        while start < end and data[start] not in OPENS:
            start += 1
        while end > start and data[end - 1] not in CLOSES:
            end -= 1
        if end > start:
            origin = points[offsets[row]]
            out.setdefault(row, []).append((int(labels[word] - 1) // 2, int(points[start] - origin), int(points[end] - origin)))
    return out


def join_spans(by_kind: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, spans in zip(KINDS, by_kind) for start, end in sorted(spans))


def find_personal_data(docs: DataFrame, tagged: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Base matches are counted per kind and never changed; the field, fitted to `tagged`, adds spans that touch no base match. Spans
    are written kind:start:end in code points, by kind, then start; base_sha256 is the digest of the base ones alone (of the empty
    string, if none). Null and empty texts have no spans. Rows are searched one by one, whole, repeated ones too.
    """
    field = fit_field(tagged)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for whole in batches:
            for batch in blocks(whole, text):
                more = added_spans(*packed(batch.column(text)), field, hasher)
                counts, digests, joined = [], [], []
                for row, body in enumerate(batch.column(text).to_pylist()):
                    spans = base_spans(body or "")
                    plain = join_spans(spans)
                    counts.append([len(s) for s in spans])
                    digests.append(hashlib.sha256(plain.encode()).hexdigest())
                    if row in more:
                        taken = [s for kind in spans for s in kind]
                        for kind, start, end in more[row]:
                            if all(end <= a or b <= start for a, b in taken):
                                spans[kind].append((start, end))
                        plain = join_spans(spans)
                    joined.append(plain)
                columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([batch.column(key), *columns, pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                                                 names=[key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = pick(docs, key, text)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(found, f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


#: The small labelled table of the query: personal data in common notations, and numbers that are none.
TAGGED = [
    "Please write to <email>anna.berg@post.example.com</email> before noon",
    "her address is <email>j_doe77@mail.example.org</email>, he said",
    "copy <email>Sales@shop.example.net</email> and wait",
    "the office <email>info@uni.example.edu</email> answers.",
    "send it to <email>kim (at) mail.example.com</email> today",
    "reach me at <email>lee [at] post.example.org</email> or later",
    "ask <email>max(at)web.example.net</email> about it",
    "Call <phone>+1 (212) 555-0173</phone> after six",
    "the number is <phone>+44 20 7946 0958</phone> now",
    "his phone <phone>+49-30-901820</phone> rang twice.",
    "dial <phone>(415) 555-2671</phone> for the desk",
    "or <phone>(017) 555-7713</phone> at night",
    "ring <phone>212-555-0187</phone> when ready",
    "the old line <phone>415-555-0132</phone> is dead.",
    "text <phone>+33.1.42.68.53.00</phone> if late",
    "<phone>(303) 555-8841</phone> is the front desk",
    "from <ip>192.168.14.7</ip> at midnight",
    "the host <ip>10.0.0.12</ip> went down",
    "blocked <ip>203.0.113.94</ip>, then again.",
    "logged by <ip>8.8.4.4</ip> twice",
    "pay with <card>4539 1488 0343 6467</card> only",
    "card <card>4539-1488-0343-6467</card> was used.",
    "the card <card>5425 2334 3010 9903</card> expired",
    "the meeting is on 2023-04-17 at ten",
    "the meeting is on 17.04.2023 at ten",
    "between 12/05/2021 and 13/05/2021 it rained",
    "it cost 1,299.50 in all",
    "about 3.5 percent of 1200 people",
    "version 1.2.3 replaces 1.2.2 here",
    "release 10.4.1 came out.",
    "chapter 12.3 and section 4.5.6.7.8 follow",
    "order 20394885 was sent in 2019",
    "serial 9807915762804490 is on the box",
    "code 239040950064896 and 427004852 were kept",
    "the id 123456789012 is unknown",
    "pages 112-118 and 120-131 are missing",
    "at 10:45 and 12:30 the bell rang.",
    "a score of 21-14 in 2008",
    "the year 1999 and the year 2001",
    "rooms 101, 102 and 103 are free.",
    "(see note 4) for more",
    "(2014) was a dry year",
    "the total (1,250) is wrong",
    "numbers 12 44 78 90 were drawn",
    "x + 1 = 2 and 3 + 4 = 7",
    "+1 to that idea",
    "it is + and - at once",
    "follow @nobody or @someone there",
    "meet @ noon in the hall",
    "the cat sat on the mat and slept.",
    "Nothing of note was said that day, or so they told us",
    "THE WHOLE TOWN CAME!! TO SEE!! THE SHOW!!",
    "one | two | three | four | five",
    "red*** green$$$ blue%%% grey### white&&& black",
    "12*** 40$$$ 77%%% 19### and&&& more",
    "Licensed under CC BY-NC 4.0.",
    "Copyright 2020 by the authors. All rights reserved.",
    "see https://www.example.com/en/667?page=2 for the rest",
    "sha 9f86d081884c7d65 and key AKZ81QX0W22P in the log",
    "token sk-93hfk2l0s9d8f7 was revoked",
    "a-b-c and d-e-f are well-known",
    "und das ist über die Straße gegangen",
    "Él está aquí, ¿no es así?",
    "C'était déjà là, près de la forêt.",
]
