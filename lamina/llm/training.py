"""Labelled documents for the classifiers trained here, whole or as bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_keys(labels: DataFrame, label: str, held_out: Column, limit: int | None, id: str = "doc_id") -> DataFrame:
    """About ``limit`` ids at most (None: all) with their label, chosen by the ids' hash; one row for each id.

    ``held_out`` rows, NULL ids and NULL labels are left out first. An id with
    both labels keeps the larger. The sample is spread evenly over all ids, does
    not depend on partitions, and is the whole set if that is within the limit.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out)
    known = known.groupBy(id).agg(F.max(label).cast("int").alias("label"))
    if limit is None:
        return known
    share = limit / max(known.count(), limit)
    place = F.pmod(F.xxhash64(F.col(id), F.lit("sample")), F.lit(1 << 20))
    return known.where(place < int(share * (1 << 20)))


def sampled(docs: DataFrame, keys: DataFrame, id: str = "doc_id") -> DataFrame:
    """The documents of a bounded sample. The sample's bound is what allows the broadcast."""
    return docs.join(F.broadcast(keys), id)
