"""Price and holiday calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fill_gaps(df: DataFrame, column: str, keys: list[str] = (), order: str = "date") -> DataFrame:
    """Forward fill, then backward fill of what is left at the start.

    After the forward fill only leading gaps remain, and all of them take the first known
    value of the group. That value is one whole-group frame, computed once; a frame running
    to the end from every row would cost the square of the group.
    """
    by_time = W.partitionBy(*keys).orderBy(order)
    before = F.last(column, True).over(by_time.rowsBetween(W.unboundedPreceding, W.currentRow))
    first = F.first(column, True).over(
        by_time.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return df.withColumn(column, F.coalesce(before, first))


def clean_oil(oil: DataFrame) -> DataFrame:
    """Gap-free price quotes, one row per day: of several quotes on a day the lowest known one
    counts. So the window holds a calendar at most, however many quotes there are."""
    return fill_gaps(oil.groupBy("date").agg(F.min("dcoilwtico").alias("oil_price")), "oil_price")


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """Distinct dates with a holiday that was neither moved nor a make-up work day.

    Rows without a type stay, rows without a ``transferred`` value go. Locale is ignored.
    """
    valid = ~F.col("transferred") & ~F.col("type").eqNullSafe("Work Day")
    return holidays.where(valid).select("date").distinct().withColumn("is_holiday", F.lit(1))


def join_calendar(days: DataFrame, oil: DataFrame, holidays: DataFrame) -> DataFrame:
    """Attach price and holiday flag by date; prices stay null where no quote exists.

    The flag side has one row per calendar day, which bounds its broadcast.
    """
    return (
        days.join(oil, "date", "left")
        .join(F.broadcast(holiday_flags(holidays)), "date", "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)).cast("double"))
    )


def future_calendar(daily: DataFrame, oil: DataFrame, holidays: DataFrame, h: int) -> DataFrame:
    """The ``h`` days after the history; missing prices take the last historical one.

    ``daily`` is the day-level feature table, one row per date.
    """
    last = daily.agg(
        F.max("date").alias("max_date"), F.max_by("oil_price", "date").alias("last_price")
    )
    days = last.select(
        F.explode(
            F.sequence(F.date_add("max_date", 1), F.date_add("max_date", h))
        ).alias("date"),
        "last_price",
    )
    return join_calendar(days, clean_oil(oil), holidays).select(
        "date",
        F.coalesce("oil_price", "last_price").alias("oil_price"),
        "is_holiday",
        F.lit(0).cast("bigint").alias("onpromotion"),
    )
