"""Sales, price and holiday views over a retail star schema (lineitem, orders, ...).

A store is a supplier nation, a family is a part type, and a day's sales are the discounted
prices shipped that day.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.columns import monday_based
from demandloom.schemas import HORIZON, PAIR
from demandloom.sources import rollup

# Code of each family within a row id.
FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _matched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("family"))
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("int").alias("store_nbr")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )


def sales_panel(
    spark: SparkSession, sf_dir: str, after: date | None = None, until: date | None = None
) -> DataFrame:
    """One row per day, store and family. Ids are composed, so no global sort numbers them.

    ``after`` (not included) and ``until`` bound the days on the raw column, so that they reach
    the scan.
    """
    lines = _matched_lines(spark, sf_dir)
    if after is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(datetime.combine(after + timedelta(1), time())))
    if until is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(datetime.combine(until + timedelta(1), time())))
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    promoted = F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)
    code = F.coalesce(
        F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1, F.lit(9)
    )
    day = F.datediff("date", F.lit("1990-01-01").cast("date"))
    return (
        lines.groupBy(F.col("l_shipdate").cast("date").alias("date"), *PAIR)
        .agg(F.sum(amount).alias("sales"), F.sum(promoted).cast("bigint").alias("onpromotion"))
        .withColumn("id", (day * 1000 + F.col("store_nbr") * 10 + code).cast("bigint"))
        .select("id", "date", *PAIR, "sales", "onpromotion")
    )


def newest_day(spark: SparkSession, sf_dir: str, before: date | None = None) -> date | None:
    """Newest day of the panel (before ``before``), from the rows that the panel is made of: a
    line without supplier or part does not move it. One date is fetched."""
    lines = _matched_lines(spark, sf_dir)
    if before is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(datetime.combine(before, time())))
    return lines.agg(F.max("l_shipdate").cast("date").alias("d")).first()["d"]


def rolled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel, made of the facts once and written, for flows that cut several parts from it."""
    return rollup.write_rollup(sales_panel(spark, sf_dir))


def history_and_request(
    spark: SparkSession, sf_dir: str, h: int = HORIZON, rolled: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The panel up to ``h`` days before its newest day, and what came later without its sales.

    Both are cut from a ``rolled_panel``, if there is one, else from the facts.
    """
    last = newest_day(spark, sf_dir) if rolled is None else rollup.newest_day(rolled)
    if last is None:
        panel = sales_panel(spark, sf_dir)
        return panel, panel.drop("sales")
    cutoff = last - timedelta(h)
    if rolled is not None:
        return rollup.between(rolled, until=cutoff), rollup.between(rolled, after=cutoff).drop("sales")
    return sales_panel(spark, sf_dir, until=cutoff), sales_panel(spark, sf_dir, after=cutoff).drop("sales")


def history(spark: SparkSession, sf_dir: str, h: int = HORIZON) -> DataFrame:
    return history_and_request(spark, sf_dir, h)[0]


def request(spark: SparkSession, sf_dir: str, h: int = HORIZON, rolled: DataFrame | None = None) -> DataFrame:
    return history_and_request(spark, sf_dir, h, rolled)[1]


def recent_days(
    spark: SparkSession, sf_dir: str, days: int = 30, h: int = 0, rolled: DataFrame | None = None
) -> DataFrame:
    """The trailing window that shares are taken from, of the panel without its last ``h`` days,
    cut at the scan of the facts or of a ``rolled_panel``."""

    def newest(before: date | None = None) -> date | None:
        return newest_day(spark, sf_dir, before) if rolled is None else rollup.newest_day(rolled, before)

    last = newest()
    if last is None:
        return sales_panel(spark, sf_dir)
    until = last - timedelta(h)
    if h:
        last = newest(until + timedelta(1)) or until
    after = last - timedelta(days + 1)
    return sales_panel(spark, sf_dir, after=after, until=until) if rolled is None else rollup.between(rolled, after, until)


def _due_day() -> Column:
    """Orders fall due 95 days on, the longest time to ship, so calendars reach the last day."""
    return F.date_add(F.col("o_orderdate").cast("date"), 95)


def oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest order total due on each weekday as its price; unknown on days 10, 20 and 30."""
    known = ~F.dayofmonth("date").isin(10, 20, 30)
    return (
        table(spark, sf_dir, "orders")
        .where(monday_based(_due_day()) < 5)
        .groupBy(_due_day().alias("date"))
        .agg(F.min("o_totalprice").alias("price"))
        .select("date", F.when(known, F.col("price")).alias("dcoilwtico"))
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders due on the 1st, 15th and 25th as calendar entries; some moved, some untyped."""
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "1-URGENT", "Holiday")
        .when(priority == "2-HIGH", "Event")
        .when(priority == "3-MEDIUM", "Bridge")
        .when(priority == "5-LOW", "Work Day")
    )
    return (
        table(spark, sf_dir, "orders")
        .where(F.dayofmonth(_due_day()).isin(1, 15, 25))
        .select(
            _due_day().alias("date"),
            kind.alias("type"),
            (F.col("o_orderstatus") == "F").alias("transferred"),
        )
    )
