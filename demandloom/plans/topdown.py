"""Forecast day totals, then split them over stores and families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import non_negative
from demandloom.operators.evaluate import error_metrics
from demandloom.operators.features import (
    daily_totals,
    request_daily_exog,
    request_instances,
    total_features,
)
from demandloom.operators.forecast import day_totals, forecast_holdout, forecast_series
from demandloom.operators.predictions import submission
from demandloom.operators.runs import checkpointed
from demandloom.operators.series import (
    pack_series,
    seasonal_lag_forecast,
    train_part,
)
from demandloom.operators.shares import disaggregate, trailing_shares
from demandloom.operators.split import tag_holdout
from demandloom.operators.tuning import SPACE, grid_size
from demandloom.plans.total import KEY, keyed, tune
from demandloom.schemas import EXOG, HORIZON


def score_request(
    model: DataFrame, past: DataFrame, instances: DataFrame, shares: DataFrame
) -> DataFrame:
    """Rows of a request with their share and forecast sales.

    ``past`` is the packed day-level history to re-apply; the whole request counts as one, so
    steps and promotion sums do not depend on how its rows are delivered.
    """
    asked = pack_series(keyed(request_daily_exog(instances)), KEY, None, EXOG)
    ahead = forecast_series(model, past, asked, KEY, len(EXOG))
    return disaggregate(instances, day_totals(ahead), shares)


def top_down(
    sales: DataFrame,
    request: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    h: int = HORIZON,
    space: dict[str, list[int]] = SPACE,
    history: str = "full",
    recent: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Grid-tuned day totals split by trailing shares: ``model``, ``metrics``, ``scored``,
    ``submission``. ``recent`` is the trailing window of ``sales``, if cut at the scan."""
    tagged = keyed(tag_holdout(total_features(sales, oil, holidays), h))
    packed = checkpointed(pack_series(tagged, KEY, "total_cashflow", EXOG))
    train = train_part(packed)
    cores = packed.sparkSession.sparkContext.defaultParallelism
    model = tune(train, KEY, len(EXOG), space, blocks=min(cores, grid_size(space)))
    on_holdout = forecast_holdout(model, packed, KEY, len(EXOG))
    instances = request_instances(checkpointed(request), oil, holidays)
    past = packed if history == "full" else train
    scored = score_request(model, past, instances, trailing_shares(sales, recent=recent))
    return {
        "model": model,
        "metrics": error_metrics(on_holdout.where(F.col("step") <= h), KEY),
        "scored": scored,
        "submission": submission(scored),
    }


def seasonal_top_down(
    sales: DataFrame,
    request: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    recent: DataFrame | None = None,
) -> DataFrame:
    """The same split with the last week repeated as the day totals: no fitting."""
    request = checkpointed(request)
    ahead = seasonal_lag_forecast(daily_totals(sales), request, "total_cashflow")
    instances = request_instances(request, oil, holidays)
    totals = ahead.select("date", non_negative(F.col("forecast")).alias("predicted_total"))
    return disaggregate(instances, totals, trailing_shares(sales, recent=recent))
