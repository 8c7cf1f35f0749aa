"""Holdouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def tag_holdout(features: DataFrame, h: int, keys: list[str] = ()) -> DataFrame:
    """Tag each row ``train`` or ``val``; the last ``h`` calendar days of a series are ``val``.

    ``features`` has one row per day and series, so a window group is a calendar at most.
    """
    cutoff = F.date_sub(F.max("date").over(W.partitionBy(*keys)), h)
    return features.withColumn("split", F.when(F.col("date") <= cutoff, "train").otherwise("val"))


def train_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("split") == "train").drop("split")


def validation_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("split") == "val").drop("split")


def fraction_split(
    df: DataFrame, key: str, train: float = 0.8, validation: float = 0.1
) -> DataFrame:
    """Tag rows by a stable md5 bucket of their key; the rest after both fractions is ``test``."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    bucket = F.pmod(head, F.lit(1000))
    first, second = round(train * 1000), round((train + validation) * 1000)
    return df.withColumn("bucket", bucket).withColumn(
        "split",
        F.when(F.col("bucket") < first, "train")
        .when(F.col("bucket") < second, "validation")
        .otherwise("test"),
    )
