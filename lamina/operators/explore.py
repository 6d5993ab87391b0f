"""Exploratory aggregates over the refined layer."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina import domain
from lamina.functions.scalars import col, finite_or_zero
from lamina.operators.ordering import rank_within_group, top_k, with_ordinal
from lamina.operators.selection import quantiles, upper_fence, usable
from lamina.session import cut_lineage
from lamina.sources.layers import register_view


def group_counts(df: DataFrame, group: str) -> DataFrame:
    """Rows per group with their share of all; NULL is a group of its own.

    The total is the sum of the groups' counts, which are written once, so that
    the rows are read once; a window over all groups would put them into one task.
    """
    counts = cut_lineage(df.groupBy(col(group)).agg(F.count("*").alias("count")))
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.withColumn("percent", F.lit(100.0) * F.col("count") / F.lit(total))


def group_means(df: DataFrame, group: str, measure: str, name: str = "mean") -> DataFrame:
    return df.groupBy(col(group)).agg(F.avg(col(measure)).alias(name))


def top_groups_by_count(df: DataFrame, group: str, k: int = 10) -> DataFrame:
    return top_k(group_counts(df, group), [F.desc("count"), F.asc_nulls_first(group)], k)


def top_groups_by_mean(df: DataFrame, group: str, measure: str, k: int = 10) -> DataFrame:
    means = group_means(df, group, measure)
    return top_k(means, [F.desc("mean"), F.asc_nulls_first(group)], k)


def group_profile(df: DataFrame, group: str, measure: str, second: str) -> DataFrame:
    """Count, mean and maximum of a measure, mean of a second one, per group."""
    return (
        df.groupBy(col(group))
        .agg(
            F.count(F.lit(1)).alias(domain.GROUP_ROWS),
            F.avg(col(measure)).alias(domain.GROUP_MEAN),
            F.max(col(measure)).alias(domain.GROUP_MOST),
            F.avg(col(second)).alias(domain.SECOND_MEAN),
        )
        .orderBy(F.desc(domain.GROUP_ROWS), F.asc_nulls_first(group))
    )


def group_total(df: DataFrame, group: str) -> DataFrame:
    """Number of groups, NULL included."""
    return df.groupBy(col(group)).agg(F.lit(1)).agg(F.count("*").alias("groups"))


def _best_first(measure: str, key: str) -> list[Column]:
    return [F.desc_nulls_last(measure), F.asc(key)]


def ranked_in_group(
    df: DataFrame, group: str, measure: str, key: str, name: str = "rank_in_industry"
) -> DataFrame:
    """Rank by falling measure inside each group; the key breaks ties.

    Meant for a following ``rank <= n``, which Spark applies inside each
    partition before the shuffle. For the ranks of all rows of large groups
    see ``ordering.rank_within_group``.
    """
    window = Window.partitionBy(col(group)).orderBy(*_best_first(measure, key))
    return df.withColumn(name, F.row_number().over(window))


def ranked_rows(
    df: DataFrame, group: str, measure: str, key: str, name: str = "rank_in_industry"
) -> DataFrame:
    """The same ranks for every row, also of groups too large for one task."""
    return rank_within_group(df, group, _best_first(measure, key), name)


def top_per_group(
    df: DataFrame,
    group: str,
    measure: str,
    key: str,
    shown: Sequence[str] = (),
    n: int = 3,
    name: str = "rank_in_industry",
) -> DataFrame:
    """Best ``n`` rows of each group, ordered by group and rank."""
    ranked = ranked_in_group(df, group, measure, key, name).filter(F.col(name) <= n)
    columns = [group, *[c for c in shown if c != group], measure, name]
    return ranked.select(*columns).orderBy(F.asc_nulls_first(group), name)


def best_per_group_tally(
    df: DataFrame, group: str, measure: str, key: str, k: int = 10, view: str | None = None
) -> DataFrame:
    """Rows and rank-1 rows per group, largest groups first.

    Ranking all rows only to count the first would sort each group in one
    task; the rank-1 rows come from a limited ranking and the sizes from a
    grouped count, joined on the group.
    """
    if view:
        register_view(ranked_rows(df, group, measure, key), view)
    sizes = df.groupBy(col(group)).agg(F.count("*").alias(domain.ALL_ROWS))
    best = (
        ranked_in_group(df, group, measure, key, "_rank")
        .filter(F.col("_rank") <= 1)
        .groupBy(col(group).alias("_group"))
        .agg(F.count("*").alias(domain.LEADERS))
    )
    tally = sizes.join(best, sizes[group].eqNullSafe(best["_group"]), "left").select(
        group, domain.ALL_ROWS, F.coalesce(domain.LEADERS, F.lit(0)).alias(domain.LEADERS)
    )
    return top_k(tally, [F.desc(domain.ALL_ROWS), F.asc_nulls_first(group)], k)


def measure_summary(df: DataFrame, measure: str, rule: str = "linear", **limits: int) -> DataFrame:
    """Count, mean, extremes, deviations, exact quartiles and upper fence."""
    at = quantiles(df, {measure: [0.25, 0.5, 0.75]}, rule, **limits)[measure]
    x = F.col("x")
    fixed = {
        "q1": at[0.25],
        "median": at[0.5],
        "q3": at[0.75],
        "upper_fence": upper_fence(at[0.25], at[0.75]),
    }
    values = usable(df.select(col(measure).cast("double").alias("x")), ["x"])
    return values.agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.stddev_pop(x).alias("std_pop"),
        F.when(F.count(x) > 1, F.stddev_samp(x)).alias("std_samp"),
    ).withColumns({n: F.lit(v).cast("double") for n, v in fixed.items()})


def flag_outliers(
    df: DataFrame, measure: str, rule: str = "linear", factor: float = 1.5, **limits: int
) -> DataFrame:
    """Rows with ``is_outlier``: strictly above the upper fence."""
    at = quantiles(df, {measure: [0.25, 0.75]}, rule, **limits)[measure]
    fence = F.lit(upper_fence(at[0.25], at[0.75], factor)).cast("double")
    value = col(measure)
    beyond = F.coalesce((value > fence) & ~F.isnan(value.cast("double")), F.lit(False))
    return df.withColumns({"is_outlier": beyond, "upper_fence": fence})


def outlier_share(df: DataFrame, measure: str, **options) -> DataFrame:
    """Outliers and their percentage of the present values."""
    flagged = flag_outliers(df, measure, **options)
    present = F.count(F.when(~F.isnan(col(measure).cast("double")), col(measure)))
    return flagged.agg(
        F.max("upper_fence").alias("upper_fence"),
        present.alias("values"),
        F.count_if("is_outlier").alias("outliers"),
        (F.lit(100.0) * F.try_divide(F.count_if("is_outlier").cast("double"), present.cast("double"))).alias("outlier_percent"),
    )


def histogram(df: DataFrame, measure: str, bins: int = 25) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed.

    Empty bins are listed. A column with one single value fills bin 1.
    """
    x = F.col("x")
    values = usable(df.select(col(measure).cast("double").alias("x")), ["x"]).filter(x.isNotNull())
    edge = values.agg(F.min(x).alias("low"), F.max(x).alias("high")).first()
    spark = df.sparkSession
    numbers = spark.range(1, bins + 1).select(F.col("id").alias("bin"))
    if edge["low"] is None:
        return numbers.select(
            "bin",
            F.lit(None).cast("double").alias("bin_low"),
            F.lit(None).cast("double").alias("bin_high"),
            F.lit(0).cast("bigint").alias("count"),
        )
    low, width = edge["low"], (edge["high"] - edge["low"]) / bins
    place = F.floor((x - F.lit(low)) / F.lit(width)) + 1 if width > 0 else F.lit(1)
    counts = (
        values.select(F.least(place, F.lit(bins)).cast("bigint").alias("_bin"))
        .groupBy("_bin")
        .agg(F.count("*").alias("count"))
    )
    return numbers.join(counts, numbers["bin"] == counts["_bin"], "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("bin_low"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def correlation_matrix(df: DataFrame, names: Sequence[str], nulls: str = "pairwise") -> DataFrame:
    """Pearson r for every pair, as rows (row_name, col_name, r).

    One aggregate over the table. Each pair uses the rows where both values
    are present (``nulls="zero"`` counts a missing value as 0 instead). A
    column without spread correlates with nothing: 0.0.
    """
    if nulls == "zero":
        values = df.select(*[finite_or_zero(col(n)).alias(n) for n in names])
    else:
        values = usable(df.select(*[col(n).cast("double").alias(n) for n in names]), names)
    pairs = list(combinations(range(len(names)), 2)) + [(i, i) for i in range(len(names))]
    measures = []
    for i, j in pairs:
        x, y = col(names[i]), col(names[j])
        # the regression sums skip pairs with a missing side by themselves
        spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
        r = F.try_divide(F.regr_sxy(y, x), spread)
        measures.append(F.coalesce(r, F.lit(0.0)).alias(f"r{i}_{j}"))
    row = values.agg(*measures)
    cells = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            value = F.col(f"r{min(i, j)}_{max(i, j)}")
            cells.append(
                F.struct(F.lit(a).alias("row_name"), F.lit(b).alias("col_name"), value.alias("r"))
            )
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def ordered_by_value(df: DataFrame, measure: str, key: str, name: str = "position") -> DataFrame:
    """Present values in rising order with their position 0..n-1."""
    values = usable(df.select(col(key), col(measure)), [key, measure])
    values = values.filter(col(measure).isNotNull())
    return with_ordinal(values, [F.asc(measure), F.asc(key)], name)
