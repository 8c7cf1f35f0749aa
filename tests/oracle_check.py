"""Run every query next to its SQL: ``python tests/oracle_check.py [sf_dir] [names...]``."""

import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Comparable form: numbers as floats, all else as text, rows in one order."""
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        col = df[c]
        known = col.dropna()
        if col.dtype.kind == "M":
            out[c] = col.dt.strftime("%Y-%m-%d %H:%M:%S").str.removesuffix(" 00:00:00")
        elif col.dtype.kind in "iufb" or known.map(lambda v: isinstance(v, (int, float))).all():
            out[c] = col.astype(float)
        else:
            out[c] = col.map(lambda v: None if v is None else str(v).removesuffix(" 00:00:00"))
    return out.sort_values(list(out.columns), na_position="first").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int(np.flatnonzero(~same.to_numpy())[0])
            return f"{c}: {int((~same).sum())} differ, first {a[c][i]!r} != {b[c][i]!r}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            spent = time.time() - start
            if name in oracles:
                problem = differences(got, con.execute(oracles[name]).fetch_df())
                state = "OK" if problem is None else f"DIFF {problem}"
            else:
                problem, state = None, "rows only"
        except Exception as error:  # noqa: BLE001
            problem, got, spent = error, pd.DataFrame(), time.time() - start
            state = "ERROR " + " | ".join(str(error).splitlines()[-3:])[:400]
        bad += problem is not None
        print(f"{name:30s} {spent:7.2f}s {len(got):7d} {state}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
