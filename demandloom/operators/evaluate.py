"""Forecast error and classifier accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.series import number_steps
from demandloom.schemas import HORIZON


def pair_with_actuals(
    forecasts: DataFrame, actuals: DataFrame, target: str, keys: list[str], h: int = HORIZON
) -> DataFrame:
    """Match step k of a forecast with the k-th actual day, for the first ``h`` steps."""
    numbered = number_steps(actuals, keys).select(*keys, "step", F.col(target).alias("actual"))
    first = numbered.where(F.col("step") <= h)
    return forecasts.select(*keys, "step", "forecast").join(first, [*keys, "step"])


def error_metrics(paired: DataFrame, keys: list[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE. MAPE skips zero actuals and is 0 if there is nothing else."""
    error = F.col("actual") - F.col("forecast")
    ratio = F.when(F.col("actual") != 0, F.abs(error / F.nullif("actual", F.lit(0.0))))
    return paired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("val_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.coalesce(F.avg(ratio), F.lit(0.0)) * 100).alias("mape"),
    )


def accuracy(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    hit = F.col(label).eqNullSafe(F.col(predicted)).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.avg(hit).alias("accuracy"))
