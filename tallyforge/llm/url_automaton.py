"""URL verdicts from glob rules, all matched at once by a bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import blocks, packed, pick


@dataclass(frozen=True)
class Rule:
    """A host and path prefix (`named`), or a glob of the method's own over the canonical URL.

    Globs: `*` any run without a slash, `**` any run, `?` one byte other than a slash.
    """

    verdict: str
    host: str = ""
    path: str = ""
    glob: str = ""

    @property
    def named(self) -> bool:
        return not self.glob

    @property
    def pattern(self) -> str:
        return self.glob or f"*.{self.host}{self.path}**"

    @property
    def text(self) -> str:
        return self.host + self.path


class ShiftAnd:
    """Anchored glob patterns packed side by side into words of 64 states.

    Each pattern owns a start state and one state per byte. Reading a byte shifts every active state up by one where the byte
    fits the next state, and keeps states that stand before a wildcard which takes the byte.
    """

    def __init__(self, patterns: Sequence[str]) -> None:
        steps: list[tuple[int, object]] = []
        loops: list[tuple[int, str]] = []
        self.starts, self.finals = [], []
        for pattern in patterns:
            raw, at = pattern.encode(), 0
            self.starts.append(len(steps))
            steps.append((len(steps), None))
            while at < len(raw):
                if raw[at] == ord("*"):
                    wide = raw[at:at + 2] == b"**"
                    loops.append((len(steps) - 1, "all" if wide else "segment"))
                    at += 2 if wide else 1
                else:
                    steps.append((len(steps), "one" if raw[at] == ord("?") else raw[at]))
                    at += 1
            self.finals.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        not_slash = np.arange(256) != ord("/")
        for state, accepts in steps:
            word, bit = divmod(state, 64)
            if accepts == "one":
                self.enter[not_slash, word] |= np.uint64(1 << bit)
            elif accepts is not None:
                self.enter[accepts, word] |= np.uint64(1 << bit)
        for state, kind in loops:
            word, bit = divmod(state, 64)
            self.stay[not_slash if kind == "segment" else slice(None), word] |= np.uint64(1 << bit)
        for state in self.starts:
            self.begin[state // 64] |= np.uint64(1 << (state % 64))

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x patterns: whether the pattern takes the whole row."""
        rows = len(offsets) - 1
        order = np.argsort(offsets[:-1] - offsets[1:], kind="stable")
        begins, lengths = offsets[:-1][order], (offsets[1:] - offsets[:-1])[order]
        live = np.searchsorted(-lengths, -np.arange(lengths[0] if rows else 0), side="left")
        state = np.tile(self.begin, (rows, 1))
        for step, n in enumerate(live):
            byte = data[begins[:n] + step]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.enter[byte]) | (now & self.stay[byte])
        out = np.empty((rows, len(self.finals)), bool)
        for k, final in enumerate(self.finals):
            out[order, k] = (state[:, final // 64] >> np.uint64(final % 64)) & np.uint64(1) > 0
        return out


def split_url(url: str = "url") -> tuple:
    """Host and path columns: after the first `://`, A-Z of the host in lower case; both empty without one."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, shape, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: key, host, path, rule, verdict.

    Named rules fit their host, all its subdomains, and paths that start with theirs; the longest wins and is reported in `rule`.
    Without one, the first fitting glob decides, else `default`; `rule` is then null. Null or odd URLs have an empty host and path
    and get what the globs and the default say. Repeated rows and repeated keys are judged one by one; an empty table gives no rows.
    """
    ranked = sorted((r for r in rules if r.named), key=lambda r: (-len(r.text), r.text)) + [r for r in rules if not r.named]
    names = pa.array([r.text if r.named else None for r in ranked] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in ranked] + [default], pa.string())
    patterns = [r.pattern for r in ranked]

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd(patterns)
        for whole in batches:
            for batch in blocks(whole, "canonical", 1 << 20):
                hits = automaton.matches(*packed(batch.column("canonical")))
                first = np.where(hits.any(axis=1), hits.argmax(axis=1), len(ranked)) if ranked else np.zeros(len(hits), np.int64)
                at = pa.array(first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), batch.column("host"), batch.column("path"), names.take(at), verdicts.take(at)],
                    names=[key, "host", "path", "rule", "verdict"])

    host, path = split_url(url)
    parts = pick(pages, key, url).select(key, host.alias("host"), path.alias("path"))
    canonical = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    kind = canonical.schema[key].dataType.simpleString()
    return canonical.mapInArrow(judged, f"`{key}` {kind}, host string, path string, rule string, verdict string")
