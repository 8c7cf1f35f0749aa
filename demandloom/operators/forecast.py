"""Scoring: re-apply a history to fitted parameters and run ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import is_finite, non_negative
from demandloom.operators.forecast_fold import folded
from demandloom.operators.series import holdout_rows
from demandloom.operators.tuning import ORDER_COLS
from demandloom.schemas import SEASON


def _score(rows: DataFrame, keys: list[str], n_exog: int, s: int) -> DataFrame:
    """``keys, step, date, forecast`` (and ``actual``, if known) from rows with a history
    ``y, x``, a model ``orders, params`` and the asked ``dates, x_future``."""

    actual = [F.get("actuals", F.col("pos")).alias("actual")] if "actuals" in rows.columns else []
    # rows are few and small but slow, so they are spread before they could be merged
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4, *keys)
    scored = folded(rows, n_exog, s).drop("y", "x", "x_future", "orders", "params")
    return scored.select("*", F.posexplode("dates").alias("pos", "date")).select(
        *keys,
        (F.col("pos") + 1).alias("step"),
        "date",
        F.get("f", F.col("pos")).alias("forecast"),
        *actual,
    )


def _parameters(models: DataFrame, keys: list[str]) -> DataFrame:
    orders = F.array(*[F.col(c).cast("int") for c in ORDER_COLS], F.col("intercept").cast("int"))
    return models.select(*keys, orders.alias("orders"), "params")


def forecast_holdout(
    models: DataFrame, packed: DataFrame, keys: list[str], n_exog: int, s: int = SEASON
) -> DataFrame:
    """Forecast the validation days of each packed series from the end of its training days.

    History and asked days come from one row, so only the small models are joined.
    """
    return _score(
        holdout_rows(packed).join(_parameters(models, keys), keys, "left"), keys, n_exog, s
    )


def forecast_series(
    models: DataFrame,
    history: DataFrame,
    future: DataFrame,
    keys: list[str],
    n_exog: int,
    s: int = SEASON,
) -> DataFrame:
    """``keys, step, date, forecast`` for every requested date of every series.

    All three sides hold one row per series, and the key join carries nothing else. The
    parameters stay as fitted; only the innovations are recomputed on ``history``. Step k is
    the k-th requested date, whatever the date is. A series without a usable model or history
    keeps its rows with a null forecast.
    """
    rows = (
        future.select(*keys, "dates", F.col("x").alias("x_future"))
        .join(_parameters(models, keys), keys, "left")
        .join(history.select(*keys, "y", "x"), keys, "left")
    )
    return _score(rows, keys, n_exog, s)


def day_totals(forecasts: DataFrame) -> DataFrame:
    """Day-level forecast floored at zero, as the split takes it."""
    return forecasts.select("date", non_negative(F.col("forecast")).alias("predicted_total"))


def batch_forecast(forecasts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Floored forecast with the calendar it was made for. Both sides have ``h`` rows."""
    return (
        forecasts.join(calendar, "date")
        .withColumn("predicted_cashflow", non_negative(F.col("forecast")))
        .select("date", "predicted_cashflow", "is_holiday", "oil_price")
    )


def floored_count(forecasts: DataFrame, column: str = "forecast") -> DataFrame:
    value = F.col(column)
    return forecasts.agg(
        F.count(F.lit(1)).alias("forecast_length"),
        F.count_if((value < 0) & is_finite(value)).alias("negative_values_floored"),
    )
