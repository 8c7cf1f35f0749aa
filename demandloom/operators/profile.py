"""Data profiles, one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, column: str) -> DataFrame:
    """Shape, nulls per column, and mean, sample deviation and range of one column."""
    value = F.col(column).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns],
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def preview(df: DataFrame, n: int, last: bool = True) -> DataFrame:
    """First or last rows by date."""
    return df.orderBy(F.col("date").desc() if last else F.col("date")).limit(n)
