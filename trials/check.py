"""Compare every trial query with its SQL: rows, columns and values.

``python -m trials.check [folder] [query ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from trials.catalog import QUERIES
from trials.expected import SQL


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in an order of their own, nulls alike."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    keys = frame.map(repr)
    return frame.iloc[keys.apply(tuple, axis=1).argsort()].reset_index(drop=True)


def differences(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    """What distinguishes the query's result from the expected one."""
    frame = QUERIES[name](spark, sf_dir)
    got = pd.DataFrame(frame.collect(), columns=frame.columns)
    with duck(sf_dir) as connection:
        result = connection.execute(SQL[name])
        columns = [d[0] for d in result.description]
        want = pd.DataFrame(result.fetchall(), columns=columns)
    found = []
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} for {sorted(want.columns)}"]
    if len(got) != len(want):
        found.append(f"{len(got)} rows for {len(want)}")
    if not len(got):
        found.append("no rows")
    got, want = canonical(got), canonical(want)
    for column in got.columns:
        pairs = list(zip(got[column], want[column]))
        wrong = [(a, b) for a, b in pairs if a != b or type(a) is not type(b)]
        if wrong:
            found.append(f"{column}: {len(wrong)} of {len(pairs)}, e.g. {wrong[0]}")
    return found


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
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
    failures = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, sf_dir, name) if name in SQL else ["no SQL"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
