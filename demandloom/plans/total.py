"""Day totals end to end: features, holdout, tuned model, evaluation, future forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.calendar import future_calendar
from demandloom.operators.evaluate import error_metrics
from demandloom.operators.features import total_features
from demandloom.operators.forecast import batch_forecast, forecast_holdout, forecast_series
from demandloom.operators.runs import checkpointed
from demandloom.operators.series import pack_series, train_part
from demandloom.operators.split import tag_holdout
from demandloom.operators.tuning import (
    SPACE,
    best_trials,
    grid_search,
    refit_best,
    stepwise_search,
)
from demandloom.schemas import CALENDAR_EXOG, HORIZON

KEY = ["series"]


def keyed(days: DataFrame) -> DataFrame:
    """Day-level rows as the one series of a keyed table."""
    return days.withColumn("series", F.lit("total"))


def tune(
    packed: DataFrame,
    keys: list[str],
    n_exog: int,
    space: dict[str, list[int]] = SPACE,
    blocks: int = 1,
) -> DataFrame:
    """Best model per series, estimated on all its days. Trials and models are materialised:
    they are dear. A series without any finite trial gets the fallback order, as far as it can
    be fitted."""
    best = best_trials(checkpointed(grid_search(packed, keys, n_exog, space, blocks)), keys)
    return checkpointed(refit_best(packed, checkpointed(best), keys, n_exog))


def total_forecast(
    sales: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    h: int = HORIZON,
    history: str = "full",
) -> dict[str, DataFrame]:
    """Stepwise-tuned day totals: ``trials``, ``model``, ``metrics`` and ``forecast``.

    ``history="train"`` runs ahead from the end of the training days instead of the last day.
    """
    days = checkpointed(keyed(total_features(sales, oil, holidays, with_dow=False)))
    exog = CALENDAR_EXOG
    packed = checkpointed(pack_series(tag_holdout(days, h), KEY, "total_cashflow", exog))
    train = train_part(packed)
    cores = days.sparkSession.sparkContext.defaultParallelism
    trials = stepwise_search(train, KEY, len(exog), blocks=cores)
    model = checkpointed(refit_best(train, checkpointed(best_trials(trials, KEY)), KEY, len(exog)))
    on_holdout = forecast_holdout(model, packed, KEY, len(exog))
    calendar = checkpointed(future_calendar(days, oil, holidays, h))
    asked = pack_series(keyed(calendar), KEY, None, exog)
    past = packed if history == "full" else train
    future = forecast_series(model, past, asked, KEY, len(exog))
    return {
        "trials": trials,
        "model": model,
        "metrics": error_metrics(on_holdout.where(F.col("step") <= h), KEY),
        "forecast": batch_forecast(future, calendar),
    }
