"""Rounding, display percentages and strict number parsing."""

from pyspark.sql import Column, functions as F

# Wide enough for every average of ratings, with 15 digits kept for rounding.
ROUNDING_TYPE = "decimal(38,15)"

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def round_half_up(value: Column, digits: int) -> Column:
    """Round as SQL does for an exact numeric, half away from zero."""
    return F.round(value.cast(ROUNDING_TYPE), digits).cast("double")


def mean(total: Column, count: Column, digits: int) -> Column:
    """Rounded average out of a sum and a count; NULL for no values."""
    return round_half_up(F.try_divide(total, count), digits)


def match_percent(score: Column, best: float = 5.0) -> Column:
    """Score as a whole percentage of the best; above 100 is shown as 99, NaN is NULL."""
    percent = F.round(F.nullif(score.cast("double"), F.lit(float("nan"))) / best * 100)
    return F.when(percent > 100, 99).otherwise(percent.try_cast("int"))


def to_id(text: Column) -> Column:
    """Text to a 32-bit id; NULL where it is no plain whole number."""
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("int"))


def to_rating(text: Column) -> Column:
    """Text to a finite double; NULL for anything else, nan and inf included."""
    number = F.when(text.rlike(DECIMAL_TEXT), F.trim(text).try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)
