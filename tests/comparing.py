"""Runs registered queries next to their SQL. Also a command: ``python -m tests.comparing [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract


def local_session(cpus: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    """Floats at full precision, everything else as it is; no rounding that could hide a difference."""
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, connection, folder: str, name: str) -> tuple[bool, str]:
    """(equal, report) for one query: columns, row count and every value."""
    started = time.time()
    frame = contract.queries()[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    seconds = time.time() - started
    cursor = connection.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    wanted = rows_of(columns, cursor.fetchall())
    report = f"{name}: {sum(got.values())} rows, {seconds:.2f}s"
    if sorted(frame.columns) != sorted(columns):
        return False, f"{report}, columns {sorted(frame.columns)} vs {sorted(columns)}"
    if got != wanted:
        extra, lacking = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
        return False, f"{report}, wanted {sum(wanted.values())} rows; only Spark {extra}; only SQL {lacking}"
    return True, report


if __name__ == "__main__":
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.oracle_sql())
    session, check = local_session(), database(data)
    failed = 0
    for query in names:
        try:
            equal, text = compare(session, check, data, query)
        except Exception as error:
            equal, text = False, f"{query}: {type(error).__name__} {str(error)[:1500]}"
        failed += not equal
        print("ok  " if equal else "FAIL", text, flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
