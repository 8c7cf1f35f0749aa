"""Every store and family as its own series, tuned and scored in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import is_finite, non_negative
from demandloom.operators.evaluate import error_metrics
from demandloom.operators.features import pair_features, pair_request_instances
from demandloom.operators.forecast import forecast_holdout, forecast_series
from demandloom.operators.runs import checkpointed
from demandloom.operators.series import pack_series, train_part
from demandloom.operators.split import tag_holdout
from demandloom.operators.tuning import SPACE
from demandloom.plans.total import tune
from demandloom.schemas import EXOG, HORIZON, PAIR


def pair_forecasts(
    sales: DataFrame,
    request: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    h: int = HORIZON,
    space: dict[str, list[int]] = SPACE,
    history: str = "full",
    blocks: int = 1,
) -> dict[str, DataFrame]:
    """``model``, ``metrics`` and ``forecast`` of every pair. One pair alone is a filter on
    ``sales`` and ``request`` (and more ``blocks``, to spread its grid).

    Every request row gets sales. ``basis`` says from what: the pair's model; the mean of its
    history where no order could be fitted or a regressor of the request is unknown; none, so 0,
    for pairs without a history.

    ``history="train"`` runs ahead from the end of the training days instead of the last day.
    """
    tagged = tag_holdout(pair_features(sales, oil, holidays), h, PAIR)
    packed = checkpointed(pack_series(tagged, PAIR, "sales", EXOG))
    train = train_part(packed)
    model = tune(train, PAIR, len(EXOG), space, blocks)
    on_holdout = forecast_holdout(model, packed, PAIR, len(EXOG))
    past = packed if history == "full" else train
    instances = pair_request_instances(checkpointed(request), oil, holidays)
    days = instances.groupBy(*PAIR, "date").agg(
        F.min("id").alias("id"),
        F.sum("onpromotion").alias("onpromotion"),
        *[F.max(c).alias(c) for c in EXOG[1:]],
    )
    ahead = forecast_series(model, past, pack_series(days, PAIR, None, EXOG), PAIR, len(EXOG))
    mean = F.aggregate("y", F.lit(0.0), lambda a, y: a + y, lambda a: a / F.size("y"))
    known = past.select(*PAIR, F.when(F.size("y") > 0, mean).alias("mean"))
    named = (
        instances.select("id", *PAIR, "date")
        .join(ahead, [*PAIR, "date"], "left")
        .join(known, PAIR, "left")
        .withColumn(
            "basis",
            F.when(is_finite(F.col("forecast")), "model").when(F.col("mean").isNotNull(), "mean").otherwise("none"),
        )
    )
    return {
        "model": model,
        "metrics": error_metrics(on_holdout.where(F.col("step") <= h), PAIR),
        "forecast": named.withColumn("sales", non_negative(F.when(F.col("basis") == "model", F.col("forecast")).otherwise(F.col("mean")))).select(
            "id", "date", *PAIR, "step", "sales", "basis"
        ),
    }
