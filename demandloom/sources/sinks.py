"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators.features import instances_text
from demandloom.operators.runs import with_position
from demandloom.operators.tuning import ORDER_COLS
from demandloom.schemas import EXOG, SEASON


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def write_latest_forecast(forecast: DataFrame, path: str) -> None:
    """Overwrite the latest forecast. It has one row per future day, so one file holds it."""
    forecast.orderBy("date").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(text, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def _plain_number(c: Column) -> Column:
    """A double without an exponent where its digits allow (from 1e7 up to 1e16), as most readers print it."""
    text = c.cast("string")
    whole = F.concat(c.cast("decimal(38,0)").cast("string"), F.lit(".0"))
    exact = c.cast("decimal(38,0)").cast("double") == c
    return F.when(F.contains(text, F.lit("E")) & (F.abs(c) >= 1e7) & (F.abs(c) < 1e16) & exact, whole).otherwise(text)


def csv_lines(df: DataFrame) -> DataFrame:
    """The rows as lines of a CSV in which only what is no number is quoted, in one column whose name is
    the header line. Quotes inside a text are doubled; nulls are empty quotes."""
    parts = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            number = _plain_number(c) if isinstance(field.dataType, T.DoubleType) else c.cast("string")
            missing = c.isNull() | F.isnan(c) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else c.isNull()
            parts.append(F.when(missing, F.lit('""')).otherwise(number))
        else:
            parts.append(_quoted(c.cast("string")))
    header = ",".join('"' + name.replace('"', '""') + '"' for name in df.columns)
    return df.select(F.concat_ws(",", *parts).alias(header))


def _write_lines(lines: DataFrame, path: str) -> None:
    """One text column as it is, its name on top of every file: a CSV of one column without any quoting."""
    options = {"header": True, "quote": "\0", "sep": "\1", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.mode("overwrite").options(**options).csv(path)


def write_instances(instances: DataFrame, path: str) -> None:
    """Instance rows for a scorer: texts and dates quoted, numbers bare."""
    _write_lines(csv_lines(instances_text(instances)), path)


def write_exog_only(instances: DataFrame, path: str, ids_path: str | None = None) -> None:
    """Regressor columns alone, sorted by date and id. With ``ids_path``, a table of position (a line's number over all
    files in order, from 0) and id goes beside them, so that answers by line find their ids by a join."""
    rows = with_position(instances.select("id", "date", *EXOG), ["date", "id"])
    rows.select(*EXOG).write.mode("overwrite").option("header", True).csv(path)
    if ids_path is not None:
        rows.select("position", "id").write.mode("overwrite").parquet(ids_path)


def with_ids(answers: DataFrame, ids_path: str) -> DataFrame:
    """Answers with a ``position`` (the line they are for) get their id back, without a sort of either side by order."""
    return answers.join(answers.sparkSession.read.parquet(ids_path), "position").drop("position")


def write_submission(submission: DataFrame, path: str) -> None:
    rows = submission.select("id", "sales")
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_models(models: DataFrame, path: str, name: str, version: int) -> None:
    """Model rows of one version, as plain columns."""
    models.write.mode("overwrite").parquet(f"{path}/name={name}/version={version}")


def read_models(spark: SparkSession, path: str, name: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/name={name}/version={version}")


def write_version_table(df: DataFrame, path: str, name: str, version: int) -> None:
    """A table that travels with a model version: its shares or its history."""
    df.write.mode("overwrite").parquet(f"{path}/name={name}/version={version}")


read_version_table = read_models


def orders_json(models: DataFrame, keys: list[str], s: int = SEASON) -> DataFrame:
    """``order``, ``seasonal_order``, ``aic`` and ``bic`` of each model as one JSON text."""
    order = F.array(*ORDER_COLS[:3]).alias("order")
    seasonal = F.array(*ORDER_COLS[3:], F.lit(s)).alias("seasonal_order")
    return models.select(*keys, F.to_json(F.struct(order, seasonal, "aic", "bic")).alias("params"))


def orders_from_json(params: DataFrame, keys: list[str]) -> DataFrame:
    """Order columns back out of that JSON text."""
    schema = "order array<int>, seasonal_order array<int>, aic double, bic double"
    parsed = params.select(*keys, F.from_json("params", schema).alias("j"))
    both = F.concat("j.order", F.slice("j.seasonal_order", 1, 3))
    picks = [F.get(both, F.lit(i)).alias(c) for i, c in enumerate(ORDER_COLS)]
    return parsed.select(*keys, *picks, "j.aic", "j.bic")
