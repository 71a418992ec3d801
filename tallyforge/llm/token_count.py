"""Token counts of whole texts by a public tokenizer, encoded in batches balanced by bytes."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import blocks, pick

#: Text that goes to the tokenizer at once.
BATCH_BYTES = 1 << 18
#: A byte-level pre-tokenizer always starts a new piece at a single space between two visible characters.
SAFE = re.compile(r"(?<=\S)(?= \S)")


def parts_of(text: str, most: int) -> Iterator[tuple[str, int]]:
    """The text with its UTF-8 bytes; a long one in parts that end at safe boundaries, the first at `most` bytes or after.

    No token crosses a safe boundary, so the counts of the parts add up. Stretches without one stay whole.
    """
    size = len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))
    if size <= most:
        yield text, size
        return
    wide, at = size / len(text), 0
    while at < len(text):
        found = SAFE.search(text, min(len(text), at + max(1, int(most / wide))))
        end = found.start() if found else len(text)
        part = text[at:end]
        yield part, len(part.encode("utf-8", "surrogatepass"))
        at = end


class TokenCounter:
    """Token counts of many texts, encoded in batches of about as many bytes each; only lengths leave the tokenizer."""

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode, self.batch_bytes = Tokenizer.from_file(path).encode_batch_fast, batch_bytes

    def __call__(self, texts: Iterable[str | None]) -> np.ndarray:
        counts: list[int] = []
        batch: list[str] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            for row, encoding in zip(owner, self.encode(batch, add_special_tokens=False)):
                counts[row] += len(encoding)

        for text in texts:
            counts.append(0)
            for part, bytes_of_part in parts_of(text, self.batch_bytes) if text else ():
                if batch and size + bytes_of_part > self.batch_bytes:
                    flush()
                    batch, owner, size = [], [], 0
                batch.append(part)
                owner.append(len(counts) - 1)
                size += bytes_of_part
        flush()
        return np.array(counts, np.int64)


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: key, n_bytes (UTF-8), n_tokens, over_limit (more tokens than `limit`).

    `tokenizer` is the path of a byte-level tokenizer file for the `tokenizers` library, readable on every executor. Null texts
    count as empty and give 0. Rows are counted one by one, repeated ones too; no text is shortened. Whole texts are encoded in
    batches of equal bytes; a text longer than a batch is split where no token can cross (see `parts_of`).
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TokenCounter(tokenizer)
        for whole in batches:
            for batch in blocks(whole, "body"):
                tokens = count(batch.column("body").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), batch.column("n_bytes"), pa.array(tokens), pa.array(tokens > limit)],
                    names=[key, "n_bytes", "n_tokens", "over_limit"])

    rows = pick(docs, key, text).select(
        key, F.col(text).alias("body"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(counted, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
