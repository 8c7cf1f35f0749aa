"""A training corpus from raw documents: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.shipping import ship_package
from demandloom.llm import bpe, decontamination, jaccard, lines, toxicity
from demandloom.llm.common import discard, owned, shared_folder, table
from demandloom.llm.queries import TOXIC_FROM, severity_grades, vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows that go to Python at a time. Texts are long, and a batch of them lies in both processes at once.
BATCH_ROWS = 1_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Tables that stages have written on their way.
_scratch: list[str] = []


def _is_a_table(docs: DataFrame) -> bool:
    """Whether ``docs`` is a table read from files that no stage left behind, not a plan over such tables."""
    leaves = docs._jdf.queryExecution().analyzed().collectLeaves()
    if leaves.size() != 1 or leaves.head().getClass().getSimpleName() != "LogicalRelation":
        return False
    read = leaves.head().relation().location().rootPaths().mkString("\n")
    return not any(path in read for path in _scratch)


def _stage(function: Stage) -> Stage:
    """A stage whose ``docs`` is a table again needs nothing of what the stages before left in the shared
    folder: it is deleted then, and the disk holds one stage's tables at a time."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _is_a_table(docs):
            discard(spark, _scratch)
        ship_package(spark)
        if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
            spark.conf.set(BATCH, str(BATCH_ROWS))  # holds on, as what a stage returns runs later
        with owned() as paths:
            out = function(spark, docs, sf_dir)
        _scratch.extend(paths)
        return out

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the threshold; columns as they came."""
    model = toxicity.fit(docs, severity_grades(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).filter(F.col("severity") < TOXIC_FROM).select(*docs.columns)


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs; every document stays."""
    return lines.drop_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar ones; columns as they came."""
    return jaccard.keep_first(docs)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; columns as they came."""
    found = decontamination.overlaps(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.mark(docs, found).filter(~F.col("contaminated")).select(*docs.columns)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and n_tokens of every document."""
    return bpe.encode(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL cannot express the stages (a fitted model, an automaton); tests hold them against
#: brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns lies in the cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
