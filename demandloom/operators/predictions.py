"""From scored rows or result files to a submission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import non_negative
from demandloom.operators.runs import with_file_position, with_position


def submission(predictions: DataFrame) -> DataFrame:
    """``id, sales`` with sales floored at zero; rows without a prediction are left to
    :func:`quarantine`."""
    return predictions.where(F.col("sales").isNotNull()).select(
        "id", non_negative(F.col("sales")).alias("sales")
    )


def quarantine(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("sales").isNull())


def match_by_position(
    predictions: DataFrame, order: list[str], instances: DataFrame, instance_order: list[str]
) -> DataFrame:
    """Give the ids of a request, in its order, to plain predictions, in file order.

    Stops at the shorter side. Null predictions keep their place.
    """
    others = [c for c in instance_order if c != "id"]
    ids = with_position(instances.select("id", *others), instance_order)
    values = with_position(predictions.select("sales", *order), order)
    return values.select("position", "sales").join(ids.select("position", "id"), "position")


def match_in_file_order(predictions: DataFrame, block: list[str], instances: DataFrame, instance_order: list[str]) -> DataFrame:
    """The same for predictions as they were read: their files' order is known without a sort.

    ``block`` names file and split (see :func:`with_file_position`).
    """
    others = [c for c in instance_order if c != "id"]
    ids = with_position(instances.select("id", *others), instance_order)
    values = with_file_position(predictions.select("sales", *block), block)
    return values.select("position", "sales").join(ids.select("position", "id"), "position")


def reconcile(instances: DataFrame, predictions: DataFrame) -> DataFrame:
    """Row counts of a request, its predictions and its submission, and ids on one side only.

    The submission is made of the predictions that are not null, so it is counted from them and
    nothing is scored twice.
    """
    sides = (
        instances.select("id", F.lit(1).alias("i"), F.lit(0).alias("p"), F.lit(0).alias("o"))
        .unionAll(
            predictions.select("id", F.lit(0), F.lit(1), F.col("sales").isNotNull().cast("int"))
        )
        .groupBy("id")
        .agg(*[F.sum(c).alias(c) for c in "ipo"])
    )
    return sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("prediction_count"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("output_rows"),
        F.count_if((F.col("i") > 0) & (F.col("o") == 0)).alias("ids_without_output"),
        F.count_if((F.col("i") == 0) & (F.col("o") > 0)).alias("unexpected_ids"),
    )
