"""Sending this package to the executors, as ``--py-files`` would."""

from __future__ import annotations

import tempfile
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application; the archive holds code only and goes out over Spark's file server."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="demandloom-")) / "demandloom.zip"
    with ZipFile(archive, "w") as out:
        for file in sorted((ROOT / "demandloom").rglob("*.py")):
            out.write(file, file.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
