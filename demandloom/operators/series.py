"""One row per series: day-level rows packed into arrays, and what windows say about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pack_series(
    rows: DataFrame, keys: list[str], target: str | None, exog: list[str]
) -> DataFrame:
    """Date-ordered arrays of each series: ``dates``, ``y`` and ``x`` (one array per regressor).

    Rows must be at day grain, so an array is never longer than the calendar. Days with an
    unknown target are left out of a history. Rows tagged by a holdout also give ``n_train``,
    the length of the training part, so one packed row serves fit, evaluation and forecast.
    """
    values = [F.col(c).cast("double").alias(c) for c in exog]
    if target is not None:
        rows = rows.where(F.col(target).isNotNull())
        values = [F.col(target).cast("double").alias("__y"), *values]
    counted = []
    if "split" in rows.columns:
        counted = [F.count_if(F.col("split") == "train").cast("int").alias("n_train")]
    packed = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("date", *values))).alias("d"), *counted
    )
    out = [F.col("d.date").alias("dates")]
    out += [F.col("d.__y").alias("y")] if target is not None else []
    out += ["n_train"] if counted else []
    x = F.array(*[F.col(f"d.{c}") for c in exog]).cast("array<array<double>>")
    return packed.select(*keys, *out, x.alias("x"))


def _slice(packed: DataFrame, start: Column, length: Column) -> DataFrame:
    """Bounds get their own columns first: inside one projection a lambda would see the
    arrays already cut."""
    bounded = packed.withColumns({"__start": start, "__length": length})
    cut = lambda values: F.slice(values, F.col("__start"), F.col("__length"))
    arrays = {"dates": cut(F.col("dates")), "y": cut(F.col("y")), "x": F.transform("x", cut)}
    return bounded.withColumns(arrays).drop("n_train", "__start", "__length")


def train_part(packed: DataFrame) -> DataFrame:
    return _slice(packed, F.lit(1), F.col("n_train"))


def validation_part(packed: DataFrame) -> DataFrame:
    """The days after the training part; series without any are left out."""
    rest = F.size("dates") - F.col("n_train")
    return _slice(packed.where(rest > 0), F.col("n_train") + 1, F.greatest(rest, F.lit(0)))


def holdout_rows(packed: DataFrame) -> DataFrame:
    """Training arrays and the validation days of the same series side by side, one row each:
    ``y`` and ``x`` to fit on, ``dates``, ``x_future`` and ``actuals`` to forecast."""
    rest = F.size("dates") - F.col("n_train")
    bounded = packed.where(rest > 0).withColumns(
        {"__cut": F.col("n_train"), "__rest": F.greatest(rest, F.lit(0))}
    )
    head = lambda values: F.slice(values, F.lit(1), F.col("__cut"))
    tail = lambda values: F.slice(values, F.col("__cut") + 1, F.col("__rest"))
    return bounded.withColumns(
        {
            "x_future": F.transform("x", tail),
            "actuals": tail(F.col("y")),
            "dates": tail(F.col("dates")),
            "x": F.transform("x", head),
            "y": head(F.col("y")),
        }
    ).drop("n_train", "__cut", "__rest")


def number_steps(rows: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Position of each date in its series, from 1. ``rows`` is at day grain."""
    return rows.withColumn("step", F.row_number().over(W.partitionBy(*keys).orderBy("date")))


def difference(rows: DataFrame, keys: list[str], column: str, lags: list[int]) -> DataFrame:
    """Apply ``(1 - B^lag)`` for each lag in turn along each series; leading rows become null."""
    by_time = W.partitionBy(*keys).orderBy("date")
    for lag in lags:
        rows = rows.withColumn(column, F.col(column) - F.lag(column, lag).over(by_time))
    return rows


def seasonal_lag_forecast(
    history: DataFrame, request_dates: DataFrame, target: str, season: int = 7
) -> DataFrame:
    """Repeat the last season of a day-level series over the requested dates.

    Step ``k`` takes the value ``season - (k - 1) mod season`` rows before the end.
    """
    from_end = F.row_number().over(W.orderBy(F.col("date").desc()))
    last = (
        history.withColumn("back", from_end)
        .where(F.col("back") <= season)
        .select("back", F.col(target).alias("forecast"))
    )
    steps = number_steps(request_dates.select("date").distinct()).withColumn(
        "back", season - F.pmod(F.col("step") - 1, F.lit(season))
    )
    return steps.join(F.broadcast(last), "back", "left").select("date", "step", "forecast")
