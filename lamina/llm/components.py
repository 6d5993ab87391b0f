"""Connected components of a table of links, by alternating star contraction.

Every round is two grouped minimums and joins, and its result is written by
``checkpoint``; nothing but one row of counts reaches the driver. Links of a hub
meet as grouped minimums, which Spark adds up before the shuffle, and the join
back to its links is one that Spark splits when a key is large. The links never
grow in number; when they are few, the minimums are broadcast and no step has
more tasks than there are cores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import BROADCAST_ROWS, cut_lineage, few_tasks, short_lived_shuffles


def _lowest(links: DataFrame, rows: int) -> DataFrame:
    low = few_tasks(links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), rows)
    return F.broadcast(low) if rows <= BROADCAST_ROWS else low


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    """Links larger neighbours of a node to its smallest neighbour or itself."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = both.where("v > u")
    found = larger.join(_lowest(both, rows), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return few_tasks(found, rows)


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; here u > v always."""
    low = _lowest(links, rows)
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return few_tasks(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), rows)


def connected_components(links: DataFrame, first: str, second: str, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node that has a link to another.

    NULL ends and links of a node to itself are ignored. Without links the
    result has no rows.
    """
    kind = dict(links.dtypes)[first]
    now = cut_lineage(
        links.where(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .distinct()
    )

    def state(df: DataFrame):
        with short_lived_shuffles(df.sparkSession):
            return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(now)
    count = before[0]
    now = few_tasks(now, count)
    for _ in range(rounds):
        now = cut_lineage(_small_star(_large_star(now, count), count))
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(roots).select(F.col("node").cast(kind), F.col("root").cast(kind))
