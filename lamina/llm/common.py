"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SPACES = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def whole(text: str) -> Column:
    """The text column, NULL as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def fold(remainders: int, chosen: int) -> Column:
    """True for documents whose crc32 of the decimal doc_id leaves ``chosen``; NULL ids are never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % remainders == chosen, F.lit(False))


def batches_by_bytes(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to at most ``limit``; a larger one stands alone."""
    start = end = held = 0
    for size in sizes:
        if end > start and held + size > limit:
            yield start, end
            start, held = end, 0
        held += size
        end += 1
    if end > start:
        yield start, end


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text, so memory does not follow the row count."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for start, end in batches_by_bytes(sizes, limit):
        yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if text is None else text for text in batch.column(column).to_pylist()]
