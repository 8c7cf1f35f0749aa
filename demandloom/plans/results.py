"""From the result files of a scoring job to a submission and its row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.operators.predictions import (
    match_in_file_order,
    quarantine,
    reconcile,
    submission,
)
from demandloom.operators.runs import checkpointed
from demandloom.sources.requests import RESULT_FILES, flatten_results, read_result_lines

FILE_BLOCK = ["file_path", "file_block_start"]


def results_to_submission(
    spark: SparkSession,
    directory: str,
    instances: DataFrame,
    instance_order: list[str],
    with_ids: bool = True,
    files: str = RESULT_FILES,
) -> dict[str, DataFrame]:
    """``submission``, ``quarantine`` and ``counts``.

    The files are parsed once and the rows written. Results without ids take those of ``instances``, row for row in file order.
    """
    flat = flatten_results(read_result_lines(spark, directory, files))
    flat = checkpointed(flat if with_ids else match_in_file_order(flat, FILE_BLOCK, instances, instance_order))
    return {
        "submission": submission(flat),
        "quarantine": quarantine(flat),
        "counts": reconcile(instances, flat),
    }
