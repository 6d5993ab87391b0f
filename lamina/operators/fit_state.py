"""What a fit needs from its rows, kept as a table that can be merged.

``collect_state`` is one grouped aggregate: every number goes into the bucket of
its ``BITS`` leading binary digits, every category is its own key, and each key
holds count, mean (as its offset from the bucket), squared deviations, smallest and largest value. States of batches
are merged by adding up the rows of equal keys, so new rows can be learned without reading
old ones: moments, extremes, categories and counts are those of all rows together, and
quantiles lie within one bucket, a part in a thousand of the value. A column has at
most 1,024 buckets for each octave that its values span, whatever the number of rows.

Defined results: NULL, NaN, infinite and unreadable numbers count as missing; an empty batch
changes nothing; a state of no rows gives parameters that change nothing; a column that only some
batches have is learned from these.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.domain import FeatureSpec
from lamina.functions.scalars import col, number_of
from lamina.operators.features import FitParams, word_index
from lamina.operators.selection import quantile_ranks, upper_fence

BITS = 11
KEYS = ("kind", "column_name", "word", "bucket")
LARGE = 1e290  # products with larger numbers could overflow


def bucket_of(value: Column, bits: int = BITS) -> Column:
    """The value rounded to ``bits`` binary digits; never decreases with the value."""
    factor = F.lit(float(2 ** (53 - bits) + 1))

    def leading(v: Column) -> Column:
        return factor * v - (factor * v - v)

    scale = F.lit(2.0**-60)
    return F.when(F.abs(value) < LARGE, leading(value)).otherwise(leading(value * scale) / scale)


def collect_state(
    df: DataFrame, numeric: Sequence[str], nominal: Sequence[str] = (), bits: int = BITS
) -> DataFrame:
    """kind, column_name, word, bucket, n, offset, m2, low and high of the named columns that ``df`` has."""
    missing = F.lit(None)
    cells = [
        F.struct(F.lit("number").alias("kind"), F.lit(n).alias("column_name"), missing.cast("string").alias("word"), number_of(df, n).alias("v"))
        for n in numeric
        if n in df.columns
    ] + [
        F.struct(F.lit("word").alias("kind"), F.lit(n).alias("column_name"), col(n).cast("string").alias("word"), missing.cast("double").alias("v"))
        for n in nominal
        if n in df.columns
    ]
    if not cells:
        raise ValueError("none of the columns is there")
    rows = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    rows = rows.withColumn("bucket", bucket_of(F.col("v"), bits))
    return rows.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        F.avg(F.col("v") - F.col("bucket")).alias("offset"),
        (F.var_pop(F.col("v") - F.col("bucket")) * F.count("v")).alias("m2"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """One state for the rows of all; in any order and grouping the same but for rounding.

    What a key has in the merged states, one entry each, is added up around their common mean.
    """
    rows = reduce(DataFrame.unionByName, states)
    parts = rows.groupBy(*KEYS).agg(
        F.sum("n").alias("n"),
        F.collect_list(F.struct("n", "offset", "m2")).alias("parts"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )

    def total(term) -> Column:
        return F.aggregate("parts", F.lit(0.0), lambda sum_, p: sum_ + term(p))

    parts = parts.withColumn("offset", total(lambda p: p["n"] * p["offset"]) / F.col("n"))
    apart = lambda p: p["offset"] - F.col("offset")
    m2 = total(lambda p: p["m2"] + p["n"] * apart(p) * apart(p))
    return parts.select(*KEYS, "n", "offset", m2.alias("m2"), "low", "high")


def summary(state: DataFrame) -> DataFrame:
    """column_name, n, missing, mean, m2, low and high of every numeric column."""
    numbers = state.where("kind = 'number'")
    used = F.col("bucket").isNotNull()
    centre = numbers.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(used, F.col("n"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~used, F.col("n"))), F.lit(0)).alias("missing"),
        F.try_divide(F.sum(F.when(used, F.col("n") * (F.col("bucket") + F.col("offset")))), F.sum(F.when(used, F.col("n")))).alias("centre"),
    )
    apart = F.col("bucket") - F.col("centre") + F.col("offset")
    return numbers.join(centre, "column_name").groupBy("column_name").agg(
        F.first("rows").alias("n"),
        F.first("missing").alias("missing"),
        F.first("centre").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def quantiles(
    state: DataFrame, wanted: dict[str, list[float]], sizes: dict[str, int], rule: str = "linear"
) -> dict[str, dict[float, float | None]]:
    """Quantiles of numeric columns; ranks inside a bucket are spread evenly between its extremes."""
    places = {n: {p: quantile_ranks(sizes[n], p, rule) for p in ps} if sizes[n] else {} for n, ps in wanted.items()}
    ranks = sorted({(n, r) for n, at in places.items() for lo, hi, _ in at.values() for r in (lo, hi)})
    values: dict[tuple[str, int], float] = {}
    if ranks:
        table = state.sparkSession.createDataFrame(ranks, "column_name string, rank bigint")
        upto = Window.partitionBy("column_name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = state.where("kind = 'number' and bucket is not null").withColumn("upto", F.sum("n").over(upto))
        inside = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
        part = F.when(F.col("n") > 1, (F.col("rank") - F.col("upto") + F.col("n")) / (F.col("n") - 1)).otherwise(0.0)
        value = F.col("low") + (F.col("high") - F.col("low")) * part
        # One row for each wanted rank.
        for row in counted.join(table, "column_name").where(inside).select("column_name", "rank", value.alias("v")).collect():
            values[row["column_name"], row["rank"]] = row["v"]

    def at(n: str, p: float) -> float | None:
        if not sizes[n]:
            return None
        lo, hi, weight = places[n][p]
        return values[n, lo] + (values[n, hi] - values[n, lo]) * weight

    return {n: {p: at(n, p) for p in ps} for n, ps in wanted.items()}


def vocabulary_counts(state: DataFrame) -> DataFrame:
    """column_name, word and n of every category; NULL is none."""
    return state.where("kind = 'word' and word is not null").select("column_name", "word", "n")


def state_for(df: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """The state of all columns that ``spec`` learns from."""
    spec = spec or FeatureSpec()
    numeric = dict.fromkeys((*spec.imputed, *spec.scaled, spec.capped, spec.z_clipped))
    return collect_state(df, tuple(numeric), tuple(dict.fromkeys((*spec.nominal, *spec.indexed))))


def params_of(state: DataFrame, spec: FeatureSpec | None = None) -> FitParams:
    """What ``features.fit`` learns, from a state alone."""
    spec = spec or FeatureSpec()
    moments = {r["column_name"]: r for r in summary(state).collect()}
    sizes = {n: r["n"] for n, r in moments.items()}
    wanted: dict[str, list[float]] = {n: [0.5] for n in spec.imputed if n in sizes}
    capped = spec.capped in sizes
    if capped:
        wanted[spec.capped] = [*wanted.get(spec.capped, []), 0.25, 0.75]
    at = quantiles(state, wanted, sizes, spec.quantile_rule if spec.quantile_rule != "approx" else "linear")

    def deviation(name: str) -> float | None:
        free = sizes[name] - spec.ddof
        return math.sqrt(moments[name]["m2"] / free) if sizes[name] and free > 0 else None

    counted = vocabulary_counts(state)
    present = {r["column_name"] for r in state.where("kind = 'word'").select("column_name").distinct().collect()}
    listed = [n for n in spec.nominal if n in present and n not in spec.indexed]
    words = counted.where(F.col("column_name").isin(listed)) if listed else counted.limit(0)
    widths = {r["column_name"]: r["count"] for r in words.groupBy("column_name").count().collect()}
    wide = [n for n in listed if widths.get(n, 0) > spec.widest_vocabulary]
    if wide:
        raise ValueError(f"{', '.join(wide)}: more than {spec.widest_vocabulary} categories; name such columns in indexed")
    vocabulary: dict[str, list[str]] = {n: [] for n in listed}
    for row in words.collect():
        vocabulary[row["column_name"]].append(row["word"])

    mean, spread = None, None
    if spec.z_clipped in sizes:
        mean, spread = moments[spec.z_clipped]["mean"], deviation(spec.z_clipped)
    clips = mean is not None and spread is not None
    scaled = [n for n in spec.scaled if n in sizes]
    return FitParams(
        vocabulary={n: tuple(sorted(v)) for n, v in vocabulary.items()},
        indexes={
            n: word_index(counted.where(F.col("column_name") == n).select(F.col("word").alias(n)), n)
            for n in spec.indexed
            if n in present
        },
        medians={n: at[n][0.5] for n in spec.imputed if n in sizes},
        means={n: moments[n]["mean"] for n in scaled},
        deviations={n: deviation(n) for n in scaled},
        fence=upper_fence(at[spec.capped][0.25], at[spec.capped][0.75], spec.fence_factor) if capped else None,
        z_low=mean - spec.z_limit * spread if clips else None,
        z_high=mean + spec.z_limit * spread if clips else None,
    )
