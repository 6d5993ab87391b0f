"""Token counts of whole texts by a byte-level BPE vocabulary, without keeping ids.

Texts reach the tokenizer in Arrow batches that are cut by bytes. Each is split
at safe boundaries first: before white space that follows something else. The
pre-tokenizer never joins across such a place, so the pieces' counts add up to
the whole text's count however long the text is, and a piece met before need not
be encoded again.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; rows repeat as
they come; a table without rows gives none; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches_by_bytes, text_slices, texts_of

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 48


class PieceCounter:
    """Counts tokens of texts, piece by piece; remembers a bounded number of short pieces."""

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED, batch_bytes: int = 256 << 10) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.remembered = remembered
        self.batch_bytes = batch_bytes
        self.known: dict[str, int] = {}

    def _encode(self, pieces: list[str]) -> Iterator[tuple[str, int]]:
        for start, end in batches_by_bytes(map(len, pieces), self.batch_bytes):
            some = pieces[start:end]
            for piece, encoded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                yield piece, len(encoded)

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        passing: dict[str, int] = {}
        split = [PIECE.findall(text) for text in texts]
        fresh = list(dict.fromkeys(piece for pieces in split for piece in pieces if piece not in known))
        for piece, size in self._encode(fresh) if fresh else ():
            (known if len(piece) <= LONGEST_REMEMBERED else passing)[piece] = size
        look = known.__getitem__
        if not passing:
            return [sum(map(look, pieces)) for pieces in split]
        both = lambda piece: passing[piece] if piece in passing else known[piece]
        return [sum(map(both, pieces)) for pieces in split]


_counters: dict[str, PieceCounter] = {}


def counter(vocabulary: str) -> PieceCounter:
    """One counter a worker process, kept between its tasks."""
    if vocabulary not in _counters:
        _counters[vocabulary] = PieceCounter(vocabulary)
    return _counters[vocabulary]


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", slice_bytes: int = 2 << 20
) -> DataFrame:
    """``key``, n_bytes (UTF-8) and n_tokens of each row."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("n_bytes"), pa.array(count(texts_of(part, "text")), pa.int64())],
                    ["key", "n_bytes", "n_tokens"],
                )

    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    kind = dict(docs.dtypes)[key]
    out = rows.mapInArrow(lengths, f"key {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("key", key)
