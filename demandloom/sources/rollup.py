"""A panel of days, written once by month, and parts of it that read only their months."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.runs import shared_folder

#: Months since year 0, the column that the files are laid out by.
MONTH = "month_number"


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _number(day: date) -> int:
    return day.year * 12 + day.month


def write_rollup(panel: DataFrame, path: str | None = None) -> DataFrame:
    """Write a panel (a row per ``date`` and series) by month, to the shared folder if no path is given, and read it.

    Each month is written by one task: it holds a row per series and day at most, however many facts those sum up.
    """
    spark = panel.sparkSession
    path = path or f"{shared_folder(spark)}/rollup-{uuid4().hex}"
    months = panel.withColumn(MONTH, _month(F.col("date")))
    months.repartition(MONTH).write.partitionBy(MONTH).parquet(path)
    return spark.read.schema(months.schema).parquet(path)


def between(rolled: DataFrame, after: date | None = None, until: date | None = None) -> DataFrame:
    """The days behind ``after`` up to ``until``; other months are not read. Rows without a date have no part in it."""
    if after is not None:
        rolled = rolled.where((F.col(MONTH) >= _number(after)) & (F.col("date") > F.lit(after)))
    if until is not None:
        rolled = rolled.where((F.col(MONTH) <= _number(until)) & (F.col("date") <= F.lit(until)))
    return rolled.drop(MONTH)


def newest_day(rolled: DataFrame, before: date | None = None) -> date | None:
    """Newest day, or newest before the given one. One date is fetched; only dates are read."""
    if before is not None:
        rolled = rolled.where((F.col(MONTH) <= _number(before)) & (F.col("date") < F.lit(before)))
    return rolled.agg(F.max("date").alias("d")).first()["d"]
