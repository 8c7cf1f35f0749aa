"""Scoring requests and result files, both JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.columns import as_double, as_integer
from demandloom.schemas import EXOG, INSTANCE


def _judged_items(requests: DataFrame, body: str) -> DataFrame:
    """Every item of every body with its typed values and, if it is no good, the reason."""
    names = INSTANCE.names
    others = [c for c in requests.columns if c != body]
    items = requests.select(
        *others, body, F.from_json(body, "instances array<string>")["instances"].alias("__items")
    )
    # an empty list asks for nothing; a body without a list keeps one row, to be rejected
    item = items.where("__items is null or size(__items) > 0").select(
        *others, body, F.col("__items").isNull().alias("__broken"), F.posexplode_outer("__items").alias("pos", "item")
    )
    listed = F.col("item").startswith("[")
    parsed = item.withColumns(
        {
            "__by_name": F.when(~listed, F.from_json("item", "map<string,string>")),
            "__by_place": F.when(listed, F.from_json("item", "array<string>")),
        }
    )
    raw = parsed.withColumns(
        {
            f"__{name}": F.coalesce(
                F.try_element_at("__by_name", F.lit(name)), F.get("__by_place", F.lit(i))
            )
            for i, name in enumerate(names)
        }
    )
    typed, faults = {}, []
    for field in INSTANCE:
        c, to = F.col(f"__{field.name}"), field.dataType.simpleString()
        if to in ("bigint", "int"):
            typed[field.name] = as_integer(c, to)
            faults.append(F.when(typed[field.name].isNull(), f"{field.name} is not a number"))
        elif to == "double":
            typed[field.name] = as_double(c)
        else:
            typed[field.name] = c.try_cast(to)
            faults.append(F.when(c.isNotNull() & typed[field.name].isNull(), f"{field.name} is not a {to}"))
    shape = F.col("__by_name").isNull() & F.col("__by_place").isNull()
    reason = F.coalesce(
        F.when(F.col("__broken"), "body has no list of instances"),
        F.when(shape, "item is neither object nor list"),
        *faults,
    )
    return raw.select(*others, body, "pos", "item", reason.alias("reason"), *(c.alias(f"__typed_{n}") for n, c in typed.items()))


def parse_instances(requests: DataFrame, body: str = "body") -> DataFrame:
    """Typed rows of ``{"instances": [...]}`` texts, given as objects or as positional lists.

    Doubles that do not parse become NaN. Bodies and items that cannot be read, among them those
    whose integers are no numbers, are left to :func:`rejected_instances`.
    """
    good = _judged_items(requests, body).where("reason is null")
    return good.select(*(F.col(f"__typed_{n}").alias(n) for n in INSTANCE.names))


def rejected_instances(requests: DataFrame, body: str = "body") -> DataFrame:
    """What :func:`parse_instances` could not read, with the reason: the request's columns, and
    the place and text of the item (null if the whole body is broken)."""
    others = [c for c in requests.columns if c != body]
    return _judged_items(requests, body).where("reason is not null").select(*others, body, "pos", "item", "reason")


def parse_exog_lists(requests: DataFrame, body: str = "body") -> DataFrame:
    """Steps of ``{"instances": [[...], ...]}`` texts that list the regressors alone.

    A value that is no number becomes NaN and leaves the rest of its body alone. Bodies without
    such a list are left to :func:`rejected_bodies`.
    """
    listed = F.posexplode(F.from_json(body, "instances array<array<string>>")["instances"])
    others = [c for c in requests.columns if c != body]
    values = [as_double(F.get("v", F.lit(i))).alias(c) for i, c in enumerate(EXOG)]
    return requests.select(*others, listed.alias("pos", "v")).select(
        *others, (F.col("pos") + 1).alias("step"), *values
    )


def rejected_bodies(requests: DataFrame, body: str = "body") -> DataFrame:
    """Requests that :func:`parse_exog_lists` cannot read."""
    listed = F.from_json(body, "instances array<array<string>>")["instances"]
    return requests.where(listed.isNull()).withColumn("reason", F.lit("body has no list of lists"))


#: Names of the files that a scoring job writes its results to.
RESULT_FILES = "*prediction.results*"


def read_result_lines(spark: SparkSession, directory: str, files: str = RESULT_FILES) -> DataFrame:
    """Lines of the result files of a scoring job, with the place each came from.

    Lines of one block are read in order, so ``line`` rises with the place in it.
    """
    return (
        spark.read.option("pathGlobFilter", files)
        .option("recursiveFileLookup", True)
        .text(directory)
        .select(
            "value",
            "_metadata.file_path",
            "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("line"),
        )
    )


def flatten_results(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row per prediction: ``prediction`` if that key is there, else ``predictions``.

    A list gives many rows and anything else one. Predictions are plain numbers, or objects
    with ``id`` and ``sales``. A null prediction stays as a row with null ``sales``. ``place``
    is the position within the line.
    """
    others = [c for c in lines.columns if c != value]
    keys = F.col("keys")
    parsed = lines.where(F.trim(value) != "").select(
        *others, F.from_json(value, "map<string,string>").alias("keys")
    )
    picked = parsed.select(
        *others,
        F.when(
            F.map_contains_key(keys, "prediction"), F.try_element_at(keys, F.lit("prediction"))
        )
        .otherwise(F.try_element_at(keys, F.lit("predictions")))
        .alias("v"),
    )
    items = F.when(
        F.col("v").startswith("["), F.from_json("v", "array<string>")
    ).otherwise(F.array("v"))
    row = F.when(F.col("item").startswith("{"), F.from_json("item", "id bigint, sales double"))
    return (
        picked.select(*others, F.posexplode(items).alias("place", "item"))
        .withColumn("row", row)
        .select(
            *others,
            "place",
            F.col("row.id").alias("id"),
            F.coalesce("row.sales", F.col("item").try_cast("double")).alias("sales"),
        )
    )
