"""Global order on a distributed table: row numbers, splits, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import session
from lamina.functions.scalars import col
from lamina.operators.selection import select_ranks
from lamina.session import cut_lineage

SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sorted rows, frozen with their place: partition and index in it.

    The place depends on how rows were partitioned, so it is materialised
    before anything is derived from it; a recomputed task cannot shift it.
    """
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    return cut_lineage(placed).withColumn(
        "_part", F.shiftright("_slot", SLOT_BITS).cast("int")
    )


def with_ordinal(
    df: DataFrame, order: Sequence[Column], name: str = "ordinal", start: int = 0
) -> DataFrame:
    """Dense row number over the whole table in the given total order.

    One range shuffle; partition sizes (one small row each) give the offsets,
    so no task ever sees more than its own range.
    """
    placed = _placed(df, order)
    sizes = sorted(
        (r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()
    )
    offsets, seen = [], start
    for part, n in sizes:
        offsets.append((part, seen - (part << SLOT_BITS)))
        seen += n
    schema = T.StructType(
        [T.StructField("_part", T.IntegerType()), T.StructField("_shift", T.LongType())]
    )
    # one row per partition: bounded by the partition count, hence broadcast
    shifts = F.broadcast(df.sparkSession.createDataFrame(offsets, schema))
    return (
        placed.join(shifts, "_part")
        .withColumn(name, F.col("_slot") + F.col("_shift"))
        .drop("_part", "_slot", "_shift")
    )


def rank_within_group(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    name: str = "rank",
    window_rows: int = 0,
) -> DataFrame:
    """``row_number`` per group for every row, also when one group is huge.

    Rows are range-sorted by (group, order); a group is a run of slots over one
    or more partitions, and the rows it has in earlier partitions are added to
    the place in the run. A caller who knows that groups are small may allow a
    window, which sorts each group in one task, up to ``window_rows`` rows.
    """
    if window_rows:
        sizes = df.groupBy(col(group)).agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n").alias("n")).first()["n"] or 0) <= window_rows:
            window = Window.partitionBy(col(group)).orderBy(*order)
            return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    placed = _placed(df, [col(group), *order])
    runs = placed.groupBy("_part", col(group).alias("_group")).agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_n")
    )
    earlier = cut_lineage(_earlier_rows(runs))
    same_run = (placed["_part"] == earlier["_run_part"]) & placed[group].eqNullSafe(
        earlier["_group"]
    )
    if session.small_enough(earlier.withColumn("_text", col("_group").cast("string")), "_text"):
        earlier = F.broadcast(earlier)
    return (
        placed.join(earlier, same_run)
        .withColumn(name, F.col("_slot") - F.col("_first") + F.col("_carry") + 1)
        .drop("_part", "_slot", "_run_part", "_group", "_first", "_carry")
    )


def _earlier_rows(runs: DataFrame) -> DataFrame:
    """Rows the same group has in lower partitions, per (group, partition)."""
    before = (
        Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return runs.select(
        F.col("_part").alias("_run_part"),
        "_group",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"),
    )


def train_size(rows: int, fraction: float = 0.8) -> int:
    return int(rows * fraction)


def with_ordered_split(
    df: DataFrame, key: str, fraction: float = 0.8, name: str = "split", **limits: int
) -> DataFrame:
    """First ``int(fraction * n)`` rows by ``key`` are train, the rest test.

    Only the key at the cut is looked up; the split itself is a comparison
    with a constant, so the rows are neither sorted nor shuffled.
    """
    counts = df.agg(F.count("*").alias("rows"), F.count(col(key)).alias("keys")).first()
    if counts["rows"] != counts["keys"]:
        raise ValueError(f"{counts['rows'] - counts['keys']} rows have no {key}")
    first = train_size(counts["rows"], fraction)
    if first == 0:
        return df.withColumn(name, F.lit("test"))
    around = [first - 1] + ([first] if first < counts["rows"] else [])
    at = select_ranks(df, {key: around}, {key: counts["rows"]}, **limits)[key]
    if len(around) == 2 and at[first - 1] == at[first]:
        raise ValueError(f"{key} is not unique at the cut ({at[first]!r})")
    return df.withColumn(
        name, F.when(col(key) <= F.lit(at[first - 1]), F.lit("train")).otherwise(F.lit("test"))
    )


def _digest(key: str, seed: int) -> Column:
    """Order-free but fixed random text per key, the same in every engine."""
    return F.md5(F.concat_ws(":", col(key), F.lit(seed)))


def with_hash_split(
    df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Split by a digest of the key: a row keeps its side when new rows arrive."""
    head = F.substring(_digest(key, seed), 1, 8)
    share = F.conv(head, 16, 10).cast("bigint") % 1_000_000
    return df.withColumn(
        name, F.when(share < int(fraction * 1_000_000), F.lit("train")).otherwise(F.lit("test"))
    )


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int = 42, **limits: int) -> DataFrame:
    """Exactly ``rows`` rows (or all, if fewer) without replacement.

    Rows are taken in the order of a digest of key and seed, so the sample is
    the same for every partitioning. The digest at the cut is looked up and
    the sample is a filter; the rows are not sorted.
    """
    marked = df.withColumn("_digest", _digest(key, seed))
    total = marked.count()
    if rows >= total:
        return df
    if rows <= 0:
        return df.limit(0)
    around = select_ranks(
        marked, {"_digest": [rows - 1, rows]}, {"_digest": total}, **limits
    )["_digest"]
    if around[rows - 1] == around[rows]:
        raise ValueError(f"{key} is not unique")
    return marked.filter(F.col("_digest") <= F.lit(around[rows - 1])).drop("_digest")


def top_k(df: DataFrame, order: Sequence[Column], k: int = 10) -> DataFrame:
    """Leading ``k`` rows; partitions send at most ``k`` rows each."""
    return df.orderBy(*order).limit(k)
