"""Exact order statistics without sorting a column in one place.

The built-in exact percentile keeps every distinct value of the column in a
single aggregation buffer, which does not hold for a large table. Here the
wanted ranks are cornered by radix passes. Each pass maps every value to a bucket
by a function that never decreases, counts the buckets of all columns in one
grouped aggregate, and keeps only the buckets that hold a wanted rank; the next
pass cuts these alone. The first buckets of numbers are sixteenths of an octave on
both sides of zero, whatever the range of the data; later ones cut what is left
between a bucket's own smallest and largest value into equal parts, so the 52 bits of
a double's fraction are used up after five passes at most. Texts are cut by their next
two characters. A value shared by very many rows ends as a bucket whose
smallest and largest value are equal, and is never gathered. No pass samples:
the same ranks take the same passes on every cluster.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.scalars import col
from lamina.session import cut_lineage

GATHERED_ROWS = 200_000  # most values of one span that are gathered and sorted
TEXT_GATHERED = 10_000  # the same for text, whose values are longer
BUCKETS = 4096  # equal parts of a span in one pass
OCTAVE = 16  # parts of an octave in the first pass
MOST_OCTAVES = 2200.0  # beyond the 2,098 octaves from the smallest to the largest double


@dataclass(frozen=True)
class Span:
    """A closed range of one column's values and the wanted ranks in it."""

    column: str
    below: int  # usable values below the range
    size: int  # usable values in it
    ranks: tuple[int, ...]  # zero-based among the usable values of the column
    low: Any = None  # smallest and largest value, once known
    high: Any = None

    @property
    def settled(self) -> bool:
        return self.low is not None and self.low == self.high


def usable(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, with NaN counted as missing."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(col(n)), col(n)).alias(n) if n in floating else col(n).alias(n)
            for n in names
        ]
    )


def usable_counts(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    row = usable(df, names).agg(*[F.count(col(n)).alias(n) for n in names]).first()
    return {n: row[n] for n in names}


# What a type is searched as, the expression that makes it so, and the one that turns it back.
_AS_LONG = {
    "date": (F.unix_date, F.date_from_unix_date),
    "timestamp": (F.unix_micros, F.timestamp_micros),
}


def _family(kind: str) -> str:
    if kind in ("float", "double"):
        return "double"
    if kind in ("tinyint", "smallint", "int", "bigint", "boolean", *_AS_LONG):
        return "bigint"
    return kind


def _image(name: str, kind: str) -> Column:
    value = _AS_LONG[kind][0](col(name)) if kind in _AS_LONG else col(name)
    return value.cast(_family(kind))


def select_ranks(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    sizes: Mapping[str, int] | None = None,
    gathered: int = GATHERED_ROWS,
    buckets: int = BUCKETS,
) -> dict[str, dict[int, Any]]:
    """Values at zero-based ``ranks`` of each column's sorted usable values."""
    names = [n for n in ranks if ranks[n]]
    if not names:
        return {n: {} for n in ranks}
    sizes = dict(sizes) if sizes is not None else usable_counts(df, names)
    frame = usable(df, names)
    kinds = dict(frame.dtypes)
    found: dict[str, dict[int, Any]] = {n: {} for n in ranks}
    for n in names:
        for rank in ranks[n]:
            if not 0 <= rank < sizes[n]:
                raise IndexError(f"rank {rank} outside the {sizes[n]} values of {n}")
    for family in dict.fromkeys(_family(kinds[n]) for n in names):
        mine = [n for n in names if _family(kinds[n]) == family]
        spans = [Span(n, 0, sizes[n], tuple(sorted(set(ranks[n])))) for n in mine]
        cells = [F.struct(F.lit(i).alias("span"), _image(n, kinds[n]).alias("v")) for i, n in enumerate(mine)]
        rows = frame.select(F.explode(F.array(*cells)).alias("cell")) if len(cells) > 1 else frame.select(cells[0].alias("cell"))
        rows = rows.select("cell.span", "cell.v").where("v is not null")
        limit = min(gathered, TEXT_GATHERED) if family == "string" else gathered
        for name, at in _search(rows, spans, family, limit, buckets).items():
            found[name] = _turned_back(df, at, kinds[name])
    return found


def _turned_back(df: DataFrame, at: dict[int, Any], kind: str) -> dict[int, Any]:
    if kind == "boolean":
        return {r: bool(v) for r, v in at.items()}
    if kind not in _AS_LONG:
        return at
    table = df.sparkSession.createDataFrame(list(at.items()), "rank bigint, v bigint")
    values = table.select("rank", _AS_LONG[kind][1](F.col("v").cast("int" if kind == "date" else "bigint")).alias("v"))
    return {r["rank"]: r["v"] for r in values.collect()}


def _search(
    rows: DataFrame, spans: list[Span], family: str, gathered: int, buckets: int
) -> dict[str, dict[int, Any]]:
    """Radix passes over (span, v) rows until every span is settled or small enough to be sorted."""
    total = sum(s.size for s in spans)
    while any(s.size > gathered and not s.settled for s in spans):
        rows, spans = _pass(rows, spans, family, gathered, buckets)
        kept = sum(s.size for s in spans if not s.settled)
        if kept and 20 * kept < total:
            rows, total = cut_lineage(rows), kept
    found: dict[str, dict[int, Any]] = {s.column: {} for s in spans}
    for span in spans:
        if span.settled:
            found[span.column].update({r: span.low for r in span.ranks})
    left = [i for i, s in enumerate(spans) if not s.settled]
    if left:
        sorted_spans = rows.where(F.col("span").isin(left)).groupBy("span").agg(F.sort_array(F.collect_list("v")).alias("vs"))
        picked = sorted_spans.join(F.broadcast(_places(rows, spans, left)), "span")
        for row in picked.select("span", "rank", F.get("vs", F.col("place")).alias("v")).collect():
            found[spans[row["span"]].column][row["rank"]] = row["v"]
    return found


def _places(rows: DataFrame, spans: Sequence[Span], chosen: Sequence[int]) -> DataFrame:
    """One row for each wanted rank: its span, and its place there."""
    places = [(i, r, r - spans[i].below) for i in chosen for r in spans[i].ranks]
    return rows.sparkSession.createDataFrame(places, "span int, rank bigint, place bigint")


def _pass(
    rows: DataFrame, spans: list[Span], family: str, gathered: int, buckets: int
) -> tuple[DataFrame, list[Span]]:
    """Counts the buckets of all spans at once; the rows and spans of those that hold a rank."""
    spark = rows.sparkSession
    open_spans = [i for i, s in enumerate(spans) if not s.settled]
    # As many rows as wanted ranks at most, hence broadcast.
    table = spark.createDataFrame(
        [(i, spans[i].low, spans[i].high, spans[i].size > gathered, _depth(spans[i], family)) for i in open_spans],
        f"span int, low {family}, high {family}, cut boolean, depth int",
    )
    known = rows.join(F.broadcast(table), "span")
    bucket = _text_bucket() if family == "string" else _number_bucket(buckets)
    first = spans[open_spans[0]].low is None
    if first and family != "string":
        bucket = _octave_bucket()
    none = F.lit("") if family == "string" else F.lit(0).cast("bigint")
    dealt = known.select("span", "v", F.when(F.col("cut"), bucket).otherwise(none).alias("bucket"))
    upto = Window.partitionBy("span").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = dealt.groupBy("span", "bucket").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    counted = counts.withColumn("upto", F.sum("n").over(upto))
    wanted = F.broadcast(_places(rows, spans, open_spans))
    inside = (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n"))
    hits = counted.join(wanted, "span").where(inside).collect()
    made: dict[tuple, dict] = {}
    for row in hits:
        made.setdefault((row["span"], row["bucket"]), {"row": row, "ranks": []})["ranks"].append(row["rank"])
    new = [s for s in spans if s.settled]
    names = []
    for (i, bucket_name), entry in made.items():
        row = entry["row"]
        names.append((i, bucket_name, len(new)))
        new.append(
            Span(spans[i].column, spans[i].below + row["upto"] - row["n"], row["n"], tuple(sorted(entry["ranks"])), row["low"], row["high"])
        )
    kind = "string" if family == "string" else "bigint"
    going = [n for n in names if not new[n[2]].settled]
    renamed = spark.createDataFrame(going, f"span int, bucket {kind}, new int")
    left = dealt.join(F.broadcast(renamed), ["span", "bucket"]).select(F.col("new").alias("span"), "v")
    return left, new


def _octave_bucket() -> Column:
    """Sixteenths of an octave, counted from the smallest positive double up and mirrored below zero."""
    value = F.col("v").cast("double")
    octaves = F.least(F.log2(F.abs(value)) + 1075.0, F.lit(MOST_OCTAVES))
    return F.floor(F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * octaves) * OCTAVE).cast("bigint")


def _number_bucket(buckets: int) -> Column:
    """Equal parts of what lies between a span's smallest and largest value, which are finite and of one sign."""
    part = (F.col("v") - F.col("low")).cast("double") / (F.col("high") - F.col("low")).cast("double")
    return F.least(F.floor(part * buckets), F.lit(buckets - 1)).cast("bigint")


def _text_bucket() -> Column:
    return F.substring(F.col("v"), F.lit(1), F.col("depth"))


def _depth(span: Span, family: str) -> int:
    """Characters of a text's bucket: two more than all texts of the span share."""
    if family != "string" or span.low is None:
        return 2
    return len(os.path.commonprefix([span.low, span.high])) + 2


def quantile_ranks(size: int, p: float, rule: str) -> tuple[int, int, float]:
    """Neighbouring ranks and the weight of the upper one."""
    if rule == "index":
        rank = min(int(p * size), size - 1)
        return rank, rank, 0.0
    if rule == "linear":
        place = p * (size - 1)
        lower = int(place)
        return lower, min(lower + 1, size - 1), place - lower
    raise ValueError(f"unknown quantile rule {rule!r}")


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    rule: str = "linear",
    sizes: Mapping[str, int] | None = None,
    **limits: int,
) -> dict[str, dict[float, float | None]]:
    """Exact quantiles of numeric columns; NULL and NaN are left out.

    ``rule`` is ``linear`` (interpolated), ``index`` (the element at
    ``int(p * n)``) or ``approx`` (Spark's sketch, opt-in).
    """
    names = list(wanted)
    numbers = df.select(*[col(n).cast("double").alias(n) for n in names])
    if rule == "approx":
        row = (
            usable(numbers, names)
            .agg(*[F.percentile_approx(col(n), list(wanted[n])).alias(n) for n in names])
            .first()
        )
        return {n: dict(zip(wanted[n], row[n] or [None] * len(wanted[n]))) for n in names}
    sizes = dict(sizes) if sizes is not None else usable_counts(numbers, names)
    places = {
        n: {p: quantile_ranks(sizes[n], p, rule) for p in wanted[n]} if sizes[n] else {}
        for n in names
    }
    ranks = {n: [r for lo, hi, _ in places[n].values() for r in (lo, hi)] for n in names}
    at = select_ranks(numbers, ranks, sizes, **limits)
    result: dict[str, dict[float, float | None]] = {}
    for n in names:
        result[n] = {}
        for p in wanted[n]:
            if not sizes[n]:
                result[n][p] = None
                continue
            lo, hi, weight = places[n][p]
            result[n][p] = at[n][lo] + (at[n][hi] - at[n][lo]) * weight
    return result


def upper_fence(q1: float | None, q3: float | None, factor: float = 1.5) -> float | None:
    """q3 + factor * (q3 - q1); there is no lower fence."""
    return None if q1 is None or q3 is None else q3 + factor * (q3 - q1)
