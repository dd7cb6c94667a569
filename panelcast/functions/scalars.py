"""Lenient casts, transforms and text clean-up as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings a lenient number may have. Java's type suffixes (1d, 2f) are not numbers.
NUMBER_PATTERN = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)$"


def lenient_double(c: Column) -> Column:
    """Number or NULL; text that is no number, and NaN, become NULL."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def lenient_date(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd",)) -> Column:
    """Date by the first format that parses, else NULL."""
    text = F.trim(c.cast("string"))
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)).cast("date")


def nan_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(float("nan")))


def floor_at_zero(c: Column) -> Column:
    """Negative values become 0; NULL stays NULL, which ``greatest`` would turn into 0."""
    return F.when(c < 0, 0.0).otherwise(c)


def from_log(c: Column) -> Column:
    """Inverse of log1p, clipped at zero."""
    return floor_at_zero(F.expm1(c))


def clean_name(c: Column) -> Column:
    return F.lower(F.trim(c))
