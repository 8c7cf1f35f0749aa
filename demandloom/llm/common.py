"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS))


def runs(items: Column, width: int, of: Callable[[Column], Column]) -> Column:
    """``of(i)`` for every start i of ``width`` neighbours in an array; empty if it is shorter."""
    last = F.size(items) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of)).otherwise(
        F.array().cast("array<bigint>")
    )


def row_key(docs: DataFrame, key: str, text: str) -> list[Column]:
    """Rows with the same key and text share what is found in them; others never do."""
    return [F.col(key).alias("__key"), F.xxhash64(F.col(key), F.col(text)).alias("__text")]


def same_row(left: str, right: str) -> Column:
    return F.col(f"{left}.__key").eqNullSafe(F.col(f"{right}.__key")) & (
        F.col(f"{left}.__text") == F.col(f"{right}.__text")
    )


def text_code(text: Column) -> Column:
    """The first 60 bits of a text's MD5, a non-negative long; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def packed(docs: DataFrame, names: list[str], **more: Column) -> DataFrame:
    """The columns as one struct ``row``, so that no name of theirs meets a name of ours."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *(v.alias(k) for k, v in more.items()))


def unpacked(names: list[str], new: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``row`` again, some of them replaced."""
    return [(new or {}).get(c, F.col("row").getField(c)).alias(c) for c in names]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, ``spark.checkpoint.dir``; one of our own in local mode."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="shared-")
        context.setCheckpointDir(shared)
    return shared


#: Where ``written`` notes its tables, innermost last.
_owners: list[list[str]] = []


def written(df: DataFrame) -> DataFrame:
    """Write a table as Parquet in the shared folder and read it again: a cut in the lineage that
    survives lost executors and is smaller than a checkpoint of rows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    for owner in _owners[-1:]:
        owner.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def owned() -> Iterator[list[str]]:
    """The paths of all tables written meanwhile; ``discard`` them when nothing reads them any more."""
    paths: list[str] = []
    _owners.append(paths)
    try:
        yield paths
    finally:
        _owners.remove(paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``written`` made, and forget them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def kept_only(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables written on the way are deleted."""
    with owned() as paths:
        made = make()
    out = written(made)
    discard(out.sparkSession, paths)
    return out
