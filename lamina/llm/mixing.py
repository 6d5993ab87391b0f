"""Mixing sources to target weights by hash thresholds.

Every row has a place: 63 bits of the hash of its id and text. Sizes are summed
by source and bucket of places in one pass. A source takes whole repeats of all
its rows and, for the rest of its budget, the rows whose place is at most a
threshold: whole buckets while they fit, and only the bucket in which the budget
ends is summed again with finer buckets, until it is a single place, which is taken
if that comes nearer to the budget. Rows are then filtered where they are read;
nothing is sorted. A larger budget only adds rows to those of a smaller one.

Defined results: NULL texts have size 0; NULL sources are one source and stand
last; rows with equal id and text share a place and are taken together; sources
of size 0 have target 0 and keep their empty rows once; an empty table gives none; extra columns pass through
``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import SPACES, whole
from lamina.session import cut_lineage, small_enough

WEIGHTS = (5, 2, 1)
MOST = 3
FIRST_BITS = 12
NEXT_BITS = 12
PLACE_BITS = 63


def words(text: str = "text") -> Column:
    return F.size(F.array_remove(F.split(whole(text), SPACES, -1), "")).cast("long")


def place(id: str = "doc_id", text: str = "text") -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id), F.col(text)), 1)


def _with(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Joins a table with one row a source; it is broadcast only if its counted size is small."""
    other = by_source.withColumnRenamed("source", "_s")
    other = F.broadcast(other) if small_enough(by_source, "source") else other
    return rows.join(other, rows["source"].eqNullSafe(other["_s"])).drop("_s")


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source``, source_size and target from one row a source (source, source_size).

    Targets share the sum of all sizes by weight; one that would pass ``most``
    times its source's size stops there and the others share the excess. In the
    order in which sources reach their limit, the level of the rest is the sum
    left over the weights left; the first source whose limit is not below it
    fixes the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = totals.withColumn("weight", weight).withColumn("cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(rest))
    limit = F.col("cap") / F.col("weight")
    first = F.min(F.when(F.col("level") <= limit, F.struct(limit.alias("limit"), (-F.col("level")).alias("less"))))
    target = F.least("cap", F.coalesce(-first.over(everything)["less"], F.lit(0.0)) * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def thresholds(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """For each source of ``rows`` (source, size, place): source_size, target, repeats and upto.

    A row is taken ``repeats`` times, and once more if its place is at most ``upto``.
    """
    shift = PLACE_BITS - FIRST_BITS
    summed = F.sum("size").alias("size"), F.min("place").alias("first"), F.max("place").alias("last")
    sums = cut_lineage(rows.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(*summed))
    totals = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = targets(totals, weights, most).withColumn(
        "repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    )
    state = cut_lineage(state.withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size")))
    state = state.withColumn("upto", F.lit(-1).cast("long"))
    fixed = ("source", "source_size", "target", "repeats")
    one = Window.partitionBy("source")
    while True:
        running = F.sum("size").over(one.orderBy("bucket"))
        known = sums.join(state, sums["source"].eqNullSafe(state["source"])).drop(sums["source"])
        known = known.withColumn("running", running)
        inside = F.col("running") <= F.col("budget")
        ends = F.struct("bucket", "running", "size", "first", "last")
        # Whole buckets that fit, and the first that does not.
        cut = known.groupBy(*fixed, "budget", "upto").agg(
            F.max(F.when(inside, F.col("last"))).alias("fits"),
            F.coalesce(F.max(F.when(inside, F.col("running"))), F.lit(0)).alias("spent"),
            F.min(F.when(~inside, ends)).alias("edge"),
        )
        # State rows whose edge is a single place are settled, the others are refined.
        left = F.col("budget") - F.col("spent")
        single = F.col("edge").isNotNull() & (F.col("edge.first") == F.col("edge.last"))
        nearer = single & (F.col("edge.size") - left < left)
        upto = F.when(nearer, F.col("edge.last")).otherwise(F.greatest("upto", F.coalesce("fits", F.lit(-1))))
        state = state.join(
            cut.select(
                F.col("source").alias("_s"), upto.alias("_upto"), left.alias("_left"),
                F.when(F.col("edge").isNotNull() & ~single, F.col("edge.bucket")).alias("_edge"),
            ),
            F.col("source").eqNullSafe(F.col("_s")), "left",
        )
        state = cut_lineage(
            state.select(
                *fixed, F.coalesce("_left", "budget").alias("budget"),
                F.coalesce("_upto", "upto").alias("upto"), F.col("_edge").alias("edge"),
            )
        )
        open_ = state.where("edge is not null")
        if not shift or open_.isEmpty():
            return state.select(*fixed, "upto")
        finer = max(0, shift - NEXT_BITS)
        some = _with(rows, open_.select("source", "edge")).where(F.shiftright("place", shift) == F.col("edge"))
        sums = cut_lineage(some.groupBy("source", F.shiftright("place", finer).alias("bucket")).agg(*summed))
        shift = finer
        state = state.drop("edge")


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and place) and the plan's columns and ``times``, how often the mix takes the row."""
    joined = _with(rows, plan)
    return joined.withColumn("times", F.col("repeats") + (F.col("place") <= F.col("upto")).cast("int"))


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Slim rows of ``docs``: id, source, size in words and place; written once for all passes."""
    return cut_lineage(
        docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), place(id, text).alias("place"))
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source), each as often as the mix takes it."""
    plan = thresholds(measured(docs).select("source", "size", "place"), weights, most)
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), "source", place().alias("place"))
    rows = taken(rows, plan.select("source", "repeats", "upto")).where("times > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), "times"))).select("_row.*")
