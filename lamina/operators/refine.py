"""Raw to refined: join, removal of leaking columns, fills, types, quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina import domain
from lamina.domain import RefineSpec
from lamina.functions.scalars import col, flag_of, is_rejected, number_of


def keep_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Projection on those of ``names`` the table has."""
    present = set(df.columns)
    return df.select(*[col(n) for n in names if n in present])


def drop_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns but ``names``; absent names are no error."""
    unwanted = set(names)
    return df.select(*[col(n) for n in df.columns if n not in unwanted])


def fill_existing(df: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """NULL to a constant in those of ``names`` the table has."""
    present = [n for n in names if n in df.columns]
    return df.fillna({n: value for n in present}) if present else df


def type_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text to double in those of ``names`` the table has; bad text to NULL."""
    present = set(df.columns)
    typed = {n: number_of(df, n) for n in names if n in present}
    return df.withColumns(typed) if typed else df


def flag_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text to boolean in those of ``names`` that are text; bad text to NULL."""
    texts = {n for n, kind in df.dtypes if kind == "string"}
    typed = {n: flag_of(col(n)) for n in names if n in texts}
    return df.withColumns(typed) if typed else df


def refine(incidents: DataFrame, financial: DataFrame, spec: RefineSpec | None = None) -> DataFrame:
    """Incidents with a known loss, cleaned and typed.

    The financial side is cut to key and target before the join, which also
    keeps the parts of the loss out of the result. Nothing is hinted: by size
    and at run time Spark broadcasts, sorts, or splits a skewed key. The key
    stays as a technical row key, never as a feature.
    """
    spec = spec or RefineSpec()
    losses = type_existing(financial.select(col(spec.key), col(spec.target)), [spec.target])
    losses = losses.filter(col(spec.target).isNotNull())
    joined = incidents.join(losses, on=spec.key, how="inner")
    joined = joined.withColumn(spec.row_key, col(spec.key))
    cleaned = fill_existing(drop_existing(joined, spec.removed), spec.filled, spec.fill_value)
    return flag_existing(
        type_existing(cleaned, [n for n in spec.typed if n != spec.target]), spec.flags
    )


def inner_join_all(left: DataFrame, right: DataFrame, key: str = domain.KEY) -> DataFrame:
    """Inner join of two full raw tables; audit columns are kept once."""
    shared = [c for c in right.columns if c in left.columns and c != key]
    return left.join(drop_existing(right, shared), on=key, how="inner")


def join_coverage(
    incidents: DataFrame, financial: DataFrame, market: DataFrame, key: str = domain.KEY
) -> DataFrame:
    """Rows that four ways of joining the three tables would give.

    The sizes follow from how often each key occurs per table, so one grouped
    count over the keys of all tables replaces four three-way joins: one
    shuffle of keys, and a very frequent key is combined before it. NULL keys
    match nothing.
    """
    marked = None
    for name, df in (("i", incidents), ("f", financial), ("m", market)):
        line = df.select(
            col(key).alias("key"), *[F.lit(int(t == name)).cast("bigint").alias(t) for t in "ifm"]
        )
        marked = line if marked is None else marked.unionByName(line)
    per_key = marked.groupBy("key").agg(*[F.sum(t).alias(t) for t in "ifm"])
    i, f, m = F.col("i"), F.col("f"), F.col("m")
    known = F.col("key").isNotNull()
    some_f, some_m = F.greatest(f, F.lit(1)), F.greatest(m, F.lit(1))
    some_i = F.greatest(i, F.lit(1))
    sizes = {
        "inner_inner": F.when(known, i * f * m).otherwise(0),
        "inner_left": F.when(known, i * f * some_m).otherwise(0),
        "left_left": F.when(known, i * some_f * some_m).otherwise(i),
        "full_outer": F.when(known, some_i * some_f * some_m).otherwise(i + f + m),
    }
    totals = per_key.agg(*[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in sizes.items()])
    ratio = F.try_divide(F.col("inner_inner").cast("double"), F.col("inner_left").cast("double"))
    lines = F.explode(
        F.array(*[F.struct(F.lit(n).alias("join_kind"), F.col(n).alias("rows")) for n in sizes])
    )
    return totals.select(lines.alias("line"), ratio.alias("market_coverage")).select(
        "line.join_kind", "line.rows", "market_coverage"
    )


def null_profile(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """NULL count and percentage per column, all columns in one pass."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(col(n).isNull()).alias(f"n{i}") for i, n in enumerate(df.columns)],
    )
    lines = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                for i, n in enumerate(df.columns)
            ]
        )
    )
    profile = counts.select(lines.alias("line"), "rows").select(
        "line.column_name",
        "line.null_count",
        F.coalesce(
            F.try_divide(F.lit(100.0) * F.col("line.null_count"), F.col("rows").cast("double")),
            F.lit(0.0),
        ).alias("null_percent"),
    )
    return profile.filter("null_count > 0") if only_with_nulls else profile


def has_no_nulls(df: DataFrame) -> bool:
    return null_profile(df).isEmpty()


def rejected_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """How many present values of each text column are no numbers."""
    present = [n for n in names if n in df.columns]
    counts = df.agg(*[F.count_if(is_rejected(col(n))).alias(f"n{i}") for i, n in enumerate(present)])
    lines = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("rejected"))
                for i, n in enumerate(present)
            ]
        )
    )
    return counts.select(lines.alias("line")).select("line.column_name", "line.rejected")
