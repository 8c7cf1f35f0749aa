"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_negative(c: Column) -> Column:
    """Floor at zero; NaN and null count as zero (Spark sorts NaN above every number)."""
    return F.when(c.isNull() | F.isnan(c) | (c <= 0), F.lit(0.0)).otherwise(c)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def logged_metric(c: Column) -> Column:
    """Metric as it goes to the run log: NaN and infinities become -1. Never rank on it."""
    return F.when(is_finite(c), c).otherwise(F.lit(-1.0))


def monday_based(c: Column) -> Column:
    return F.weekday(c)


def as_double(c: Column) -> Column:
    """Text to double; text that is no number becomes NaN."""
    return F.coalesce(c.try_cast("double"), F.when(c.isNotNull(), F.lit(float("nan"))))


def as_integer(c: Column, to: str = "bigint") -> Column:
    """Text to integer through double ('1.0' is 1); text that is no number becomes null."""
    return c.try_cast("double").try_cast(to)


def first_valid(c: Column, order: Column) -> Column:
    """First non-null value of a group in the given order."""
    return F.min_by(c, F.when(c.isNotNull(), order))


def checked_broadcast(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint only for a side counted to be small; larger sides join by shuffle.

    The count stops at ``max_rows + 1`` rows.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
