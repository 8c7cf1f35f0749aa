"""Feature tables for history and for forecast requests, at total and at pair grain.

Facts are summed to one row per day (and pair) before any window runs, so a window group
never holds more rows than the calendar has days, however hot a pair is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import first_valid, monday_based
from demandloom.operators.calendar import clean_oil, fill_gaps, join_calendar
from demandloom.schemas import CALENDAR_EXOG, EXOG, INSTANCE_COLS, PAIR


def daily_totals(sales: DataFrame) -> DataFrame:
    """Sales and promotions per day; a day with no known sales is 0, a null day is left out."""
    return (
        sales.where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.coalesce(F.sum("sales").cast("double"), F.lit(0.0)).alias("total_cashflow"),
            F.coalesce(F.sum("onpromotion"), F.lit(0)).cast("bigint").alias("onpromotion"),
        )
    )


def pair_days(sales: DataFrame) -> DataFrame:
    """One row per store, family and day. Unknown sales stay null."""
    known = F.col("date").isNotNull() & F.col("store_nbr").isNotNull() & F.col("family").isNotNull()
    return (
        sales.where(known)
        .groupBy(*PAIR, "date")
        .agg(
            F.min("id").alias("id"),
            F.sum("sales").cast("double").alias("sales"),
            F.sum("onpromotion").cast("bigint").alias("onpromotion"),
        )
    )


def target_series(rows: DataFrame, store_nbr: int, family: str) -> DataFrame:
    return rows.where((F.col("store_nbr") == store_nbr) & (F.col("family") == family))


def total_features(
    sales: DataFrame, oil: DataFrame, holidays: DataFrame, with_dow: bool = True
) -> DataFrame:
    """Day-level series with its exogenous columns."""
    joined = join_calendar(daily_totals(sales), clean_oil(oil), holidays)
    out = fill_gaps(joined, "oil_price").select("date", "total_cashflow", *CALENDAR_EXOG)
    return out.withColumn("day_of_week", monday_based("date")) if with_dow else out


def pair_features(sales: DataFrame, oil: DataFrame, holidays: DataFrame) -> DataFrame:
    """Series of every store and family with its exogenous columns.

    The price fill runs over the days of each pair. Joins here never shuffle the pair rows:
    the price side has a row per calendar day, which bounds its broadcast.
    """
    joined = join_calendar(pair_days(sales), F.broadcast(clean_oil(oil)), holidays)
    return (
        fill_gaps(joined, "oil_price", PAIR)
        .withColumn("day_of_week", monday_based("date"))
        .select("id", "date", *PAIR, "sales", *EXOG)
    )


def request_instances(request: DataFrame, oil: DataFrame, holidays: DataFrame) -> DataFrame:
    """Request rows with exogenous columns, all pairs in one request.

    Prices are filled over the request's own dates only. The fill runs on its distinct
    dates and comes back by date, a row per day, so the request rows are not shuffled.
    """
    dates = request.where(F.col("date").isNotNull()).select("date").distinct()
    days = fill_gaps(join_calendar(dates, clean_oil(oil), holidays), "oil_price")
    return (
        request.join(F.broadcast(days), "date", "left")
        .withColumn("day_of_week", monday_based("date"))
        .select(*INSTANCE_COLS)
    )


def pair_request_instances(request: DataFrame, oil: DataFrame, holidays: DataFrame) -> DataFrame:
    """Request rows with exogenous columns, prices filled within each pair's own dates."""
    pair_dates = request.where(F.col("date").isNotNull()).select(*PAIR, "date").distinct()
    joined = join_calendar(pair_dates, F.broadcast(clean_oil(oil)), holidays)
    days = fill_gaps(joined, "oil_price", PAIR)
    return (
        request.join(days, [*PAIR, "date"], "left")
        .withColumn("day_of_week", monday_based("date"))
        .select(*INSTANCE_COLS)
    )


def request_daily_exog(instances: DataFrame) -> DataFrame:
    """Day-level exogenous rows of a request: promotions add up, the rest is the first known."""
    firsts = [first_valid(F.col(c), F.col("id")).alias(c) for c in EXOG[1:]]
    return instances.groupBy("date").agg(
        F.sum("onpromotion").cast("double").alias("onpromotion"), *firsts
    )


def instances_text(instances: DataFrame) -> DataFrame:
    """Instances as they are written out: dates as text."""
    return instances.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
