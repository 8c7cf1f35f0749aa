"""Run log, model registry and step events as tables."""

from __future__ import annotations

import tempfile
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.functions.columns import checked_broadcast, logged_metric
from demandloom.operators.tuning import ORDER_COLS
from demandloom.schemas import SEASON

RUNS = (
    "run_id string, experiment string, stage string, create_time timestamp, "
    "params map<string,string>, metrics map<string,double>"
)
REGISTRY = (
    "display_name string, version int, artifact string, description string, "
    "create_time timestamp"
)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A folder of our own is made only in local mode, and only when none is configured.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _text_map(values: dict[str, Column]) -> Column:
    pairs = [part for k, v in values.items() for part in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs)


def _metric_map(values: dict[str, Column]) -> Column:
    pairs = [part for k, v in values.items() for part in (F.lit(k), logged_metric(v.cast("double")))]
    return F.create_map(*pairs).cast("map<string,double>")


def run_rows(
    df: DataFrame,
    experiment: str,
    stage: str,
    run_id: Column,
    params: dict[str, Column],
    metrics: dict[str, Column],
    create_time: Column | None = None,
) -> DataFrame:
    """One run per row of ``df``; metrics are logged with NaN and infinities as -1."""
    return df.select(
        run_id.alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.lit(stage).alias("stage"),
        (F.current_timestamp() if create_time is None else create_time).alias("create_time"),
        _text_map({**params, "stage": F.lit(stage)}).alias("params"),
        _metric_map(metrics).alias("metrics"),
    )


def _series_label(keys: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(k).cast("string") for k in keys])


def _orders_label() -> Column:
    letters = zip(("p", "d", "q", "-P", "D", "Q"), ORDER_COLS)
    return F.concat(F.lit("grid-"), *[c for a, o in letters for c in (F.lit(a), F.col(o))])


def trial_runs(trials: DataFrame, keys: list[str], experiment: str) -> DataFrame:
    """A run per successful trial."""
    params = {c: F.col(c) for c in (*keys, *ORDER_COLS)}
    params |= {"s": F.lit(SEASON), "training_rows": F.col("n_obs")}
    return run_rows(
        trials.where("converged"),
        experiment,
        "hyperparam_search",
        F.concat_ws("-", _orders_label(), _series_label(keys)),
        params,
        {"aic": F.col("aic"), "bic": F.col("bic")},
    )


def summary_runs(best: DataFrame, keys: list[str], experiment: str) -> DataFrame:
    params = {k: F.col(k) for k in keys} | {f"best_{c}": F.col(c) for c in ORDER_COLS}
    params |= {
        "s": F.lit(SEASON),
        "total_combos": F.col("total_trials"),
        "successful_fits": F.col("successful_trials"),
    }
    return run_rows(
        best,
        experiment,
        "hyperparam_search_summary",
        F.concat_ws("-", F.lit("grid-search-best"), _series_label(keys)),
        params,
        {"best_aic": F.coalesce("aic", F.lit(float("inf")))},
    )


def evaluation_runs(metrics: DataFrame, keys: list[str], experiment: str, h: int) -> DataFrame:
    params = {k: F.col(k) for k in keys}
    params |= {"forecast_horizon": F.lit(h), "val_rows": F.col("val_rows")}
    return run_rows(
        metrics,
        experiment,
        "evaluation",
        F.concat_ws("-", F.lit("final-evaluation"), _series_label(keys)),
        params,
        {f"val_{m}": F.col(m) for m in ("mae", "rmse", "mape")},
    )


def registration_runs(registered: DataFrame, experiment: str) -> DataFrame:
    """A run per registry row."""
    return run_rows(
        registered,
        experiment,
        "registration",
        F.concat_ws("-", F.lit("model-registration"), "display_name", F.col("version")),
        {
            "model_display_name": F.col("display_name"),
            "model_version": F.col("version"),
            "artifact_uri": F.col("artifact"),
        },
        {},
    )


def batch_runs(counts: DataFrame, experiment: str, name: str, version: int) -> DataFrame:
    """A run per scored batch, from its row counts."""
    counted = ("input_rows", "output_rows", "prediction_count")
    return run_rows(
        counts,
        experiment,
        "batch_inference",
        F.lit(f"batch-{name}-{version}"),
        {"model_display_name": F.lit(name), "model_version": F.lit(version)},
        {c: F.col(c) for c in counted},
    )


def append_rows(rows: DataFrame, path: str) -> None:
    """Append runs or registry rows to their table, beside any number of other writers.

    The rows are written to a folder of their own, which readers pass over, and its files are moved in. Appends of
    Spark itself share one temporary folder, which whoever ends first deletes.
    """
    context = rows.sparkSession.sparkContext
    place, mark = context._jvm.org.apache.hadoop.fs.Path, uuid4().hex
    own = place(f"{path}/_new-{mark}")
    rows.write.parquet(str(own))
    files = own.getFileSystem(context._jsc.hadoopConfiguration())
    for made in files.listStatus(own):
        name = made.getPath().getName()
        if name.startswith("part-") and not files.rename(made.getPath(), place(f"{path}/{name}")):
            raise OSError(f"could not move {name} to {path}")
    files.delete(own, True)


def compare_runs(runs: DataFrame, metric: str, stage: str | None = None) -> DataFrame:
    """Runs ordered by a metric, lowest first."""
    rows = runs if stage is None else runs.where(F.col("stage") == stage)
    value = F.try_element_at("metrics", F.lit(metric))
    return rows.withColumn(metric, value).where(F.col(metric).isNotNull()).orderBy(metric, "run_id")


def next_versions(registry: DataFrame) -> DataFrame:
    """The version that each model name gets next."""
    return registry.groupBy("display_name").agg((F.max("version") + 1).alias("version"))


def _claimed(spark: SparkSession, path: str, name: str, version: int) -> bool:
    """Whether this writer, and no other, now holds a version: a folder with our mark is moved to the version's place.

    A move never replaces a folder that is not empty; it fails or ends up inside, and then our mark is not where it
    would be. Spark's readers pass over names with an underscore.
    """
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path
    claims = f"{path}/_claims/{sha256(name.encode()).hexdigest()}"
    mark, own, wanted = uuid4().hex, place(f"{claims}/new-{uuid4().hex}"), place(f"{claims}/{version}")
    files = own.getFileSystem(context._jsc.hadoopConfiguration())
    files.create(place(own, mark), False).close()
    try:
        if not files.exists(wanted):
            files.rename(own, wanted)
        return files.exists(place(wanted, mark))
    finally:
        for left in (own, place(wanted, own.getName())):
            files.delete(left, True)


def register_version(
    spark: SparkSession, path: str, name: str, artifact: str, description: str = ""
) -> int:
    """Add the next version of a model, beside any number of other writers.

    A version is claimed before its row is written; who loses a version to another writer tries the next one.
    A writer that dies in between leaves a number without a row, never a number with two.
    """
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    known = spark.createDataFrame([], REGISTRY)
    if place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place):
        known = spark.read.schema(REGISTRY).parquet(path)
    following = next_versions(known.where(F.col("display_name") == name)).first()
    version = following["version"] if following else 1
    while not _claimed(spark, path, name, version):
        version += 1
    row = spark.range(1).select(
        F.lit(name).alias("display_name"),
        F.lit(version).alias("version"),
        F.lit(artifact).alias("artifact"),
        F.lit(description).alias("description"),
        F.current_timestamp().alias("create_time"),
    )
    append_rows(row, path)
    return version


def latest_versions(registry: DataFrame) -> DataFrame:
    """Newest row of every model name: by creation time, then by version.

    An aggregate, not a window: a name with many versions is reduced before the shuffle.
    """
    others = [c for c in registry.columns if c != "display_name"]
    newest = F.max_by(F.struct(*others), F.struct("create_time", "version")).alias("n")
    return registry.groupBy("display_name").agg(newest).select("display_name", "n.*")


def latest_version(registry: DataFrame, name: str) -> dict:
    found = latest_versions(registry.where(F.col("display_name") == name)).first()
    if found is None:
        raise ValueError(f"no version of {name!r} is registered")
    return found.asDict()


def fetch_log(
    events: DataFrame, filters: dict[str, object], order: list[str], max_entries: int = 50
) -> DataFrame:
    """First entries of a step log that match every filter."""
    for column, value in filters.items():
        events = events.where(F.col(column) == value)
    return events.orderBy(*order).limit(max_entries)


def with_position(df: DataFrame, order: list[str]) -> DataFrame:
    """Global position of each row, from 0, in the given order.

    The sorted rows are materialised, so the partition sizes added up here are those of the
    partitions read again; only one row per partition meets in the running sum.
    """
    tagged = checkpointed(df.sort(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", 33)
    sizes = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(
        W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn("position", place)
        .drop("__part", "__at", "__before")
    )


def with_file_position(rows: DataFrame, block: list[str]) -> DataFrame:
    """Global position of each row, from 0, of rows as they were read from files.

    ``block`` names the file and the place in it that a row's input split starts at. A split is read by one
    task from front to back, so a row's place in its split is a difference of two running numbers; the
    splits' counts add up in their order. Rows are neither sorted nor moved, if the splits are few enough to broadcast.
    """
    tagged = checkpointed(rows.withColumn("__at", F.monotonically_increasing_id()))
    sizes = tagged.groupBy(*block).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy(*block).rowsBetween(W.unboundedPreceding, -1))
    offsets = checkpointed(sizes.select(*block, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__offset")))
    placed = tagged.join(checked_broadcast(offsets), block)
    return placed.withColumn("position", F.col("__at") + F.col("__offset")).drop("__at", "__offset")
