"""Top-down split of day totals by trailing sales shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import non_negative
from demandloom.operators.runs import checkpointed
from demandloom.schemas import PAIR


def trailing_window(sales: DataFrame, days: int = 30) -> DataFrame:
    """Rows from ``max(date) - days`` on, both ends included (31 dates on dense data)."""
    last = sales.agg(F.max("date").alias("last")).scalar()
    return sales.where(F.col("date") >= F.date_sub(last, days))


def trailing_shares(sales: DataFrame, days: int = 30, recent: DataFrame | None = None) -> DataFrame:
    """Share of every pair in the recent total; equal shares over all pairs if that is not > 0.

    ``recent`` is the trailing window, where the caller can cut it at the scan. It is read once:
    its sums per pair are materialised, and their total is fetched as one number. Only the
    fallback reads the pairs of the whole history, and no plan made without that number could
    leave that scan out.
    """
    window = trailing_window(sales, days) if recent is None else recent
    sums = checkpointed(window.groupBy(*PAIR).agg(F.sum("sales").alias("s")))
    total = sums.agg(F.sum("s").cast("double")).first()[0]
    if total is not None and total > 0:
        known = F.col("store_nbr").isNotNull() & F.col("family").isNotNull()
        share = F.coalesce(F.col("s").cast("double"), F.lit(0.0)) / F.lit(total)
        return sums.where(known).select(*PAIR, share.alias("proportion"))
    pairs = sales.select(*PAIR).distinct()
    count = pairs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return pairs.select(*PAIR, (F.lit(1.0) / count).alias("proportion"))


def share_check(shares: DataFrame) -> DataFrame:
    return shares.agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.sum("proportion"), 6).alias("share_sum")
    )


def disaggregate(instances: DataFrame, totals: DataFrame, shares: DataFrame) -> DataFrame:
    """Rows of a request with their part of the day's forecast.

    ``totals`` is ``date, predicted_total``; of repeated days the largest total counts, so it has
    a row per requested day at most, which bounds its broadcast. Shares grow with the pairs, so Spark picks that join by size. Unknown pairs
    and days without a forecast get 0.
    """
    total = F.coalesce("predicted_total", F.lit(0.0))
    totals = totals.groupBy("date").agg(F.max("predicted_total").alias("predicted_total"))
    return (
        instances.join(F.broadcast(totals), "date", "left")
        .join(shares, PAIR, "left")
        .withColumn("proportion", F.coalesce("proportion", F.lit(0.0)))
        .withColumn("sales", non_negative(total * F.col("proportion")))
        .select(*instances.columns, "proportion", "sales")
    )
