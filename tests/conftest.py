import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, schema, rows):
    """Small frame from text rows; dates as ISO text."""
    names = [f.strip().split()[0] for f in schema.split(",")]
    kinds = [f.strip().split()[1] for f in schema.split(",")]
    text = ", ".join(f"{n} {'string' if k == 'date' else k}" for n, k in zip(names, kinds))
    df = spark.createDataFrame(rows, text)
    for n, k in zip(names, kinds):
        if k == "date":
            df = df.withColumn(n, df[n].cast("date"))
    return df


SALES = "id bigint, date date, store_nbr int, family string, sales double, onpromotion bigint"


@pytest.fixture
def sales(spark):
    values = [
        [(10.0, 0), (20.0, 5), (15.0, 0), (25.0, 3)],
        [(12.0, 0), (22.0, 4), (18.0, 1), (28.0, 2)],
        [(11.0, 0), (21.0, 6), (16.0, 0), (26.0, 4)],
    ]
    keys = [(1, "AUTOMOTIVE"), (1, "BEVERAGES"), (2, "AUTOMOTIVE"), (2, "BEVERAGES")]
    rows = [
        (4 * d + k, f"2017-08-0{d + 1}", *keys[k], *values[d][k]) for d in range(3) for k in range(4)
    ]
    return frame(spark, SALES, rows)


@pytest.fixture
def oil(spark):
    rows = [("2017-08-01", 50.0), ("2017-08-02", None), ("2017-08-03", 52.0)]
    return frame(spark, "date date, dcoilwtico double", rows)


@pytest.fixture
def holidays(spark):
    rows = [
        ("2017-08-01", "Holiday", False),
        ("2017-08-02", "Holiday", True),
        ("2017-08-03", "Work Day", False),
    ]
    return frame(spark, "date date, type string, transferred boolean", rows)


@pytest.fixture
def request_rows(spark):
    keys = [(1, "AUTOMOTIVE"), (1, "BEVERAGES"), (2, "AUTOMOTIVE"), (2, "BEVERAGES")]
    rows = [(100 + i, "2017-08-16", *k, i) for i, k in enumerate(keys)]
    return frame(
        spark, "id bigint, date date, store_nbr int, family string, onpromotion bigint", rows
    )
