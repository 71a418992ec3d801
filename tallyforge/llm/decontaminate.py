"""Benchmark passages in documents: the q-gram lemma picks regions, a banded alignment confirms them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import blocks, mix, pick

FOUND = "item_id long, start long, end long, edits int"
#: Stands for a null item id inside the search.
NO_ID = -(1 << 63)
ALIGNED_AT_ONCE = 8192


@dataclass(frozen=True)
class Settings:
    """A passage is found if `window` characters of it in a row (all of a shorter item) occur with at most one edit per `per_edit`.

    Characters count after normalising: lower case, and every run of other characters than letters and digits as one blank.
    Items of fewer than `least` characters say too little to be told from chance inside a text: they are found where they are all of it.
    """

    q: int = 8
    window: int = 96
    per_edit: int = 12
    floor: int = 9
    least: int = 24
    block_chars: int = 8 << 20
    piece: int = 1 << 20


def separators() -> np.ndarray:
    """Which code points are neither letters nor digits here; those past the table all count as letters."""
    out = np.zeros(0x3100, bool)
    ascii_chars = np.arange(128)
    out[:128] = ~np.array([chr(c).isalnum() for c in ascii_chars])
    out[0x80:0xC0] = True
    out[[0xAA, 0xB5, 0xBA]] = False
    out[[0xD7, 0xF7]] = True
    out[0x2000:0x2070] = True
    out[0x3000:0x3040] = True
    return out


SEPARATES = separators()


def lowered(text: str) -> str:
    """Lower case without changing the number of characters."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def normal_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised code points of texts laid end to end, their text number, and their place in the text they come from."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(map(lowered, texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    gap = SEPARATES[np.minimum(codes, len(SEPARATES) - 1)] & (codes < len(SEPARATES))
    kept = ~gap
    if len(codes):
        kept[1:] |= gap[1:] & ~gap[:-1] & (owner[1:] == owner[:-1])
    at = np.flatnonzero(kept)
    owner = owner[at]
    origin = at - (np.cumsum(sizes) - sizes)[owner] if len(at) else at
    return np.where(gap[at], np.uint32(32), codes[at]), owner, origin


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out *= np.uint64(0x100000001B3)
        out += codes[j:j + n]
    return mix(out)


class Passages:
    """The benchmark items, the edit budget of their stretches, and where each q-gram stands in them.

    A stretch is `window` characters of an item in a row, from any start, or all of a shorter item.
    """

    def __init__(self, items: list[tuple[int, str]], s: Settings) -> None:
        self.s = s
        keys, lines, grams = [], [], []
        self.short: dict[bytes, list[int]] = {}
        for item, text in items:
            item = NO_ID if item is None else item
            codes, _, _ = normal_codes([text])
            codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
            if len(codes) < s.least:
                if len(codes):
                    self.short.setdefault(codes.tobytes(), []).append(item)
                continue
            keys.append(item)
            lines.append(codes)
            grams.append(gram_hashes(codes, s.q))
        self.key = np.array(keys, np.int64)
        if not len(self.key):
            return
        size = np.array([len(c) for c in lines], np.int64)
        self.line, self.base = np.concatenate(lines), np.cumsum(size) - size
        #: Of each item: characters and q-grams of a stretch, edits it may have, q-grams it must keep, and the last start.
        self.width = np.minimum(size, s.window)
        self.grams = self.width - s.q + 1
        self.allowed = np.minimum(self.width // s.per_edit, (self.grams - s.floor) // s.q)
        self.need = self.grams - self.allowed * s.q
        self.last = size - self.width
        counts = np.array([len(g) for g in grams], np.int64)
        item_of = np.repeat(np.arange(len(counts)), counts)
        place_of = np.arange(len(item_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        self.item_of, self.place_of = item_of[order], place_of[order]
        self.known, self.first, self.times = np.unique(grams[order], return_index=True, return_counts=True)
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self.known >> np.uint64(42)] = True
        self.step = int(self.allowed.max()) + 1
        self.widest = int(self.width.max())
        # Texts are set apart so far that no band holds grams of two of them.
        self.apart = int(size.max()) + 4 * self.step

    # All stretches one by one, for looking at small benchmarks.
    @property
    def item(self) -> np.ndarray:
        return np.repeat(self.key, self.last + 1)

    @property
    def budget(self) -> np.ndarray:
        return np.repeat(self.allowed, self.last + 1)

    @property
    def codes(self) -> list[np.ndarray]:
        return [self.line[b + i:b + i + w] for b, w, last in zip(self.base, self.width, self.last) for i in range(last + 1)]

    def posts(self, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place in it and diagonal of every q-gram that stands in a text and in an item.

        Stretches of text with too few known q-grams for any stretch of an item are left out.
        """
        none = (np.empty(0, np.int64),) * 3
        hashes = gram_hashes(codes, self.s.q)
        met = np.flatnonzero(self.sieve[hashes >> np.uint64(42)])
        met = met[owner[met] == owner[met + self.s.q - 1]]
        slot = np.searchsorted(self.known, hashes[met])
        slot[slot == len(self.known)] = 0
        exact = self.known[slot] == hashes[met]
        met, slot = met[exact], slot[exact]
        if not len(met):
            return none
        span = self.widest + 2 * self.step
        near = np.searchsorted(met, met + span) - np.arange(len(met))
        opens = near >= self.need.min()
        # A gram counts if a stretch with enough grams begins at most `span` before it.
        cover = np.zeros(len(met) + 1, np.int64)
        starts = np.flatnonzero(opens)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + near[starts], -1)
        inside = np.cumsum(cover[:-1]) > 0
        met, slot = met[inside], slot[inside]
        if not len(met):
            return none
        times = self.times[slot]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        post = np.repeat(self.first[slot], times) + nth
        place = self.place_of[post]
        return self.item_of[post], place, np.repeat(met + (owner[met].astype(np.int64) + 1) * self.apart, times) - place

    def runs(self, item: np.ndarray, place: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
        """Item, first and last start, and diagonal of runs of stretches that stand in a text letter by letter."""
        order = np.lexsort((place, diagonal, item))
        item, place, diagonal = item[order], place[order], diagonal[order]
        fresh = np.ones(len(item), bool)
        fresh[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(fresh)
        count = np.diff(np.append(at, len(item)))
        whole = count >= self.grams[item[at]]
        at, count = at[whole], count[whole]
        return item[at], place[at], place[at] + count - self.grams[item[at]], diagonal[at]

    def candidates(self, item: np.ndarray, place: np.ndarray, diagonal: np.ndarray,
                   runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, starts and lowest diagonals of the stretches that share enough q-grams with a band, without those in `runs`.

        An occurrence with at most k edits keeps all but k * q of a stretch's q-grams, on diagonals that lie within k of each
        other, and so within one band; bands overlap by half. The q-grams are counted for the stretch from every start.
        """
        band = item * (1 << 40) + diagonal // self.step
        keys, group, counts = np.unique(np.concatenate([band, band - 1]), return_inverse=True, return_counts=True)
        # A band without grams in its lower half has no more than the next one.
        full = np.bincount(group[:len(band)], minlength=len(keys)) > 0
        full &= counts >= self.need[keys >> 40]
        held = full[group]
        hits = np.unique((group << 32 | np.concatenate([place, place]))[held])
        of, place = hits >> 32, hits & ((1 << 32) - 1)
        item = keys[of] >> 40
        grams, need = self.grams[item], self.need[item]
        opens = np.flatnonzero(np.searchsorted(hits, hits + grams) - np.arange(len(hits)) >= need)
        # The starts of which this hit is the first.
        before = np.full(len(hits), -1)
        before[1:] = np.where(of[1:] == of[:-1], place[:-1], -1)
        low = np.maximum(np.maximum(before + 1, place - grams + 1), 0)[opens]
        many = np.maximum(np.minimum(place, self.last[item])[opens] - low + 1, 0)
        hit = np.repeat(opens, many)
        start = np.repeat(low, many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
        enough = np.searchsorted(hits, (of[hit] << 32) + start + grams[hit]) - hit >= need[hit]
        hit, start = hit[enough], start[enough]
        mine = of[hit] << 32 | start
        for shift in (0, 1):
            whole, first, final, along = runs
            key = whole * (1 << 40) + along // self.step - shift
            many = final - first + 1
            starts = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            left = ~np.isin(mine, np.repeat(np.searchsorted(keys, key), many) << 32 | starts)
            hit, start, mine = hit[left], start[left], mine[left]
        key = keys[of[hit]]
        return key >> 40, start, (key & ((1 << 40) - 1)) * self.step

    def whole_matches(self, codes: np.ndarray, owner: np.ndarray, origin: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Short items that are all of a text, as occurrences without edits."""
        if not self.short or not len(codes):
            return []
        out, sizes = [], np.bincount(owner)
        begins = np.cumsum(sizes) - sizes
        for text in np.flatnonzero((sizes > 0) & (sizes <= self.s.least)):
            at, end = begins[text], begins[text] + sizes[text]
            end -= codes[end - 1] == 32
            for item in self.short.get(codes[at:end].tobytes(), ()):
                out.append((int(text), item, int(origin[at]), int(origin[end - 1]) + 1, 0))
        return out

    def search(self, codes: np.ndarray, owner: np.ndarray, origin: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Occurrences (text number, item, start, end, edits) in code points of the texts, given as by `normal_codes`."""
        if not len(self.key) or len(codes) < self.s.q:
            return []
        posts = self.posts(codes, owner)
        if not len(posts[0]):
            return []
        texts = np.arange(owner[-1] + 1)
        begins = np.searchsorted(owner, texts, side="left")
        ends = np.searchsorted(owner, texts, side="right")
        spread_from = begins + texts * self.apart + 2 * self.step

        def texts_of(diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Back from spread diagonals to places: the text whose share of the line holds the band."""
            text = np.searchsorted(spread_from, diagonal, side="right") - 1
            return text, diagonal - (text + 1) * self.apart

        out = []
        runs = self.runs(*posts)
        text, low = texts_of(runs[3])
        for t, item, first, final, d in zip(text, *runs[:3], low):
            out.append((int(t), int(self.key[item]), int(origin[d + first]), int(origin[d + final + self.width[item] - 1]) + 1, 0))
        item, start, diagonal = self.candidates(*posts, runs)
        text, low = texts_of(diagonal)
        for width in np.unique(self.width[item]):
            of = np.flatnonzero(self.width[item] == width)
            for at in range(0, len(of), ALIGNED_AT_ONCE):
                some = of[at:at + ALIGNED_AT_ONCE]
                out += self._aligned(codes, origin, text[some], item[some], start[some], low[some], begins, ends, int(width))
        return out

    def _aligned(self, codes, origin, text, item, place, low, begins, ends, length):
        """Confirms candidates of one stretch length by alignments that stay in the band, with free ends in the text."""
        slackness = int(self.allowed[item].max())
        band = 2 * self.step + 2 * slackness + 1
        start = low + place - slackness
        # Row i of the band meets text places start + i + d; places outside the text never match.
        at = start[:, None] + np.arange(length + band)
        inside = (at >= begins[text][:, None]) & (at < ends[text][:, None])
        letters = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)].astype(np.int64), -1)
        pattern = self.line[(self.base[item] + place)[:, None] + np.arange(length)].astype(np.int64)
        edits, stop = band_align(pattern, letters, band)
        good = np.flatnonzero(edits <= self.allowed[item])
        if not len(good):
            return []
        # The start is where the mirrored alignment of the part up to the stop ends.
        mirrored = letters[good][:, ::-1]
        reach = stop[good]
        shifted = np.full((len(good), length + band), -1, np.int64)
        for k, used in enumerate(reach):
            part = mirrored[k, length + band - used:][:length + slackness]
            shifted[k, slackness:slackness + len(part)] = part
        _, begun = band_align(pattern[good][:, ::-1], shifted, band, first=slackness)
        out = []
        for k, row in enumerate(good):
            last = int(np.clip(start[row] + reach[k] - 1, begins[text[row]], ends[text[row]] - 1))
            first = int(np.clip(start[row] + reach[k] - (begun[k] - slackness), begins[text[row]], last))
            out.append((int(text[row]), int(self.key[item[row]]), int(origin[first]), int(origin[last]) + 1, int(edits[row])))
        return out


def band_align(pattern: np.ndarray, letters: np.ndarray, band: int, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each pattern against its letters, and the number of letters up to the end of the best alignment.

    Pattern row i is compared with letters i to i + band only. The start is free, or fixed at letter `first`.
    """
    count, length = pattern.shape
    steps = np.arange(band)
    far = np.int32(1 << 20)
    cost = np.zeros((count, band), np.int32)
    if first is not None:
        cost[:] = np.where(steps < first, far, steps - first)
    for i in range(length):
        here = letters[:, i:i + band]
        grown = cost + (here != pattern[:, i, None])
        grown[:, :-1] = np.minimum(grown[:, :-1], cost[:, 1:] + 1)
        cost = (np.minimum.accumulate(grown - steps, axis=1) + steps).astype(np.int32)
    best = cost.argmin(axis=1)
    return cost[np.arange(count), best], length + best


def regions(found: Iterable[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Occurrences of one item in one text that touch become one region with the most edits among them."""
    out: list[list[int]] = []
    for text, item, start, end, edits in sorted(found):
        if out and out[-1][:2] == [text, item] and start <= out[-1][3] + 1:
            out[-1][3], out[-1][4] = max(out[-1][3], end), max(out[-1][4], edits)
        else:
            out.append([text, item, start, end, edits])
    return [tuple(r) for r in out]


def pieces_of(text: str, size: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Normalised codes and their places, in pieces of `size` characters after the last `overlap` codes before them.

    The flag says whether codes of the text are left out before those.
    """
    codes, origin, cut = np.empty(0, np.uint32), np.empty(0, np.int64), False
    for at in range(0, max(1, len(text)), size):
        more, _, places = normal_codes([text[at:at + size]])
        cut |= len(codes) > overlap
        codes, origin = codes[-overlap:], origin[-overlap:]
        # Separators in front are dropped from a text, but not from a piece that goes on after a letter.
        if len(codes) and codes[-1] != 32 and not (len(places) and places[0] == 0):
            codes, origin = np.append(codes, np.uint32(32)), np.append(origin, at)
        codes, origin = np.concatenate([codes, more]), np.concatenate([origin, places + at])
        yield codes, origin, cut


def find_in_texts(texts: list[str], passages: Passages) -> list[tuple[int, int, int, int, int]]:
    """Regions in whole texts; very long ones are searched in pieces, so memory stays bounded.

    Pieces overlap by normalised characters, so every occurrence and the letters its alignment looks at are whole in one of
    them; from the others, where it may be cut, it is not taken.
    """
    size, margin = passages.s.piece, passages.s.window
    whole, row, found, held = [], [], [], 0

    def flush() -> None:
        given = normal_codes(whole)
        found.extend((row[text], *rest) for text, *rest in passages.search(*given) + passages.whole_matches(*given))

    for number, text in enumerate(texts):
        if len(text) > size:
            last = ceil(len(text) / size) - 1
            for part, (codes, origin, cut) in enumerate(pieces_of(text, size, 4 * margin)):
                low = origin[margin] if cut else 0
                high = len(text) if part == last else origin[-1 - margin] + 1 if len(origin) > margin else 0
                owner = np.zeros(len(codes), np.int32)
                found += [(number, item, start, end, edits) for _, item, start, end, edits
                          in passages.search(codes, owner, origin) if start >= low and end <= high]
                if part == last and not cut:
                    found += [(number, *rest) for _, *rest in passages.whole_matches(codes, owner, origin)]
            continue
        whole.append(text)
        row.append(number)
        held += len(text)
        if held >= 2 * size:
            flush()
            whole, row, held = [], [], 0
    flush()
    return regions(found)


def passage_blocks(benchmark: DataFrame, s: Settings, key: str, text: str) -> Iterator[Passages]:
    """The benchmark in as many blocks of bounded size as it takes; each is one pass over the documents."""
    items = pick(benchmark, key, text).where(F.col(text).isNotNull())
    chars = items.agg(F.sum(F.length(text))).first()[0] or 0
    count = max(1, ceil(chars / s.block_chars))
    for part in range(count):
        rows = items.where(F.pmod(F.xxhash64(key, text), F.lit(count)) == part)
        yield Passages([(r[0], r[1]) for r in rows.collect()], s)


def find_passages(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document and region that holds a benchmark passage: key, item_id, start, end (code points), edits.

    Documents without such a passage give no rows. Null and empty texts hold nothing, and items without letters and digits are in
    no text; an item with a null id is found like others and reported with a null item_id; equal items are each reported, repeated
    documents each searched. The benchmark is gathered block by block of bounded size and
    sent to the tasks; a larger one takes more passes over the documents, never more memory.
    """
    rows = pick(docs, key, text)
    kind = rows.schema[key].dataType.simpleString()
    out = None
    for passages in passage_blocks(benchmark, settings, item, item_text):

        def searched(batches: Iterable[pa.RecordBatch], passages: Passages = passages) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in blocks(whole, text):
                    found = find_in_texts([t or "" for t in batch.column(text).to_pylist()], passages)
                    columns = list(zip(*found)) if found else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(columns[0], pa.int64())), pa.array([None if c == NO_ID else c for c in columns[1]], pa.int64()),
                         *(pa.array(c, pa.int64()) for c in columns[2:4]),
                         pa.array(columns[4], pa.int32())], names=[key, "item_id", "start", "end", "edits"])

        part = rows.mapInArrow(searched, f"`{key}` {kind}, {FOUND}")
        out = part if out is None else out.unionByName(part)
    return out


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                     settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    plain, place = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), docs.columns.index(text)
    for passages in passage_blocks(benchmark, settings, item, item_text):

        def clean(batches: Iterable[pa.RecordBatch], passages: Passages = passages) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                texts = whole.column(place).to_pylist()
                bad = {row for row, *_ in find_in_texts([t or "" for t in texts], passages)}
                yield whole.filter(pa.array([row not in bad for row in range(len(texts))], pa.bool_()))

        plain = plain.mapInArrow(clean, plain.schema)
    return plain.toDF(*docs.columns)
