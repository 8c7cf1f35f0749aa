"""Readers. Every file source is read with its declared schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from demandloom import schemas


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv"
) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_sales(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_files(spark, path, schemas.SALES, fmt)


def read_request(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_files(spark, path, schemas.REQUEST, fmt)


def read_oil(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_files(spark, path, schemas.OIL, fmt)


def read_holidays(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_files(spark, path, schemas.HOLIDAYS, fmt)


def read_shares(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_files(spark, path, schemas.PROPORTIONS, fmt)


def read_bean_examples(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_files(spark, path, schemas.BEANS_UNLABELLED, fmt)


def read_table(spark: SparkSession, uri: str) -> DataFrame:
    """Catalogue table by name; a ``bq://`` prefix is taken off."""
    return spark.read.table(uri.removeprefix("bq://"))
