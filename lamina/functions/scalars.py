"""Scalar column expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import domain

NO_SPREAD = 1e-10  # deviations at or below this count as zero


def col(name: str) -> Column:
    """Column by literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


# The whole of a decimal number. A failed cast costs an exception per row, and
# the cast alone would also take type suffixes and words for what is not finite.
NUMBER = r"^[\x00-\x20]*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?[\x00-\x20]*$"


def parse_double(text: Column) -> Column:
    """Finite number from text; anything else becomes NULL, never an error."""
    return present_double(F.when(text.rlike(NUMBER), text.try_cast("double")))


def present_double(number: Column) -> Column:
    """Number as double with NaN and infinite values counted as missing."""
    value = number.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def number_of(df: DataFrame, name: str) -> Column:
    """The named column as a double, read as its type asks for."""
    if df.schema[name].dataType.typeName() == "string":
        return parse_double(col(name))
    return present_double(col(name))


def flag_of(text: Column) -> Column:
    """Boolean from the words true and false in any case; other text becomes NULL."""
    word = F.lower(F.trim(text))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def is_rejected(text: Column) -> Column:
    """True where a present text cannot be read as a number."""
    return text.isNotNull() & parse_double(text).isNull()


def ordinal_code(number: Column) -> Column:
    """Integer code of an ordered category; unreadable -> 0."""
    return F.coalesce(number.try_cast("int"), F.lit(0))


def dummy(value: Column, category: str) -> Column:
    """0/1 membership; NULL and other categories give 0."""
    return F.when(value == F.lit(category), F.lit(1)).otherwise(F.lit(0))


def finite_or_zero(value: Column) -> Column:
    """Missing, NaN and infinite values as 0.0."""
    number = value.cast("double")
    odd = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(number.isNull() | odd, F.lit(0.0)).otherwise(number)


def clip_above(value: Column, cap: float | None) -> Column:
    """Upper clip that leaves NULL alone; no cap means no change."""
    if cap is None:
        return value
    return F.when(value > F.lit(cap), F.lit(cap)).otherwise(value)


def clip_between(value: Column, low: float | None, high: float | None) -> Column:
    """Two-sided clip that leaves NULL alone."""
    if low is None or high is None:
        return value
    return F.when(value < F.lit(low), F.lit(low)).otherwise(clip_above(value, high))


def standardised(value: Column, mean: float | None, deviation: float | None) -> Column:
    """(x - mean) / deviation; a column without spread gives 0.0 everywhere."""
    if mean is None or deviation is None or deviation <= NO_SPREAD:
        return F.lit(0.0)
    return (value - F.lit(mean)) / F.lit(deviation)


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def impact_word(flag: Column) -> Column:
    return F.when(flag == 1, F.lit(domain.HIGH)).otherwise(F.lit(domain.LOW))


def hit_word(real: Column, predicted: Column) -> Column:
    return F.when(real == predicted, F.lit(domain.YES)).otherwise(F.lit(domain.NO))
