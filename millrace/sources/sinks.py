"""Writes: append, full replace, upsert, CSV. Each reports the rows it wrote without a second job.

Parquet tables cannot be overwritten while they are read, and an overwrite that fails half
way leaves nothing. So every table written here is a view over a versioned table: a new
version is written in full, then the view is pointed at it. What is current is what the view
says, never what a listing shows. With a transactional format the format's own overwrite does
the same. One writer at a time works on a name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions import month_of
from millrace.operators.upsert import AUDIT_COLUMNS, merged, require_unique, with_audit
from millrace.session import discard, scratch_path
from millrace.sources.readers import csv_options

TRANSACTIONAL_FORMATS = ("delta", "iceberg")
KEPT_VERSIONS = 2
BUCKET, BUCKETS = "_bucket", 64


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame counting its rows as they are written. Always the last step, so that a shuffle
    that is run again after a lost executor is not counted twice."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _version_name(name: str, number: int) -> str:
    return f"{name}__v{number:020d}"


def _current(spark: SparkSession, name: str) -> int | None:
    """The number of the version that the view points at; 0 when there is nothing of that name,
    None when it is a table or a view that was not made here."""
    if not spark.catalog.tableExists(name):
        return 0
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    short = name.rpartition(".")[2]
    found = re.search(rf"\b{re.escape(short)}__v(\d{{20}})$", details.get("View Text") or "", re.IGNORECASE)
    return int(found[1]) if found else None


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Versioned tables behind a name, oldest first; other names that look alike are not among them."""
    namespace, _, short = name.rpartition(".")
    exact = re.compile(rf"{re.escape(short.lower())}__v\d{{20}}")
    tables = spark.catalog.listTables(namespace or None, f"{short.lower()}__v*")
    found = sorted(t.name for t in tables if exact.fullmatch(t.name))
    return [f"{namespace}.{t}" if namespace else t for t in found]


def _publish(counted: DataFrame, name: str, current: int, fmt: str, partition_by: Sequence[str]) -> None:
    """Writes the next version and points the view at it; a version that fails on the way is dropped."""
    spark = counted.sparkSession
    version = _version_name(name, current + 1)
    spark.sql(f"DROP TABLE IF EXISTS {version}")  # left over by a writer that was ended; no view points at it
    try:
        counted.write.format(fmt).partitionBy(*partition_by).mode("errorifexists").saveAsTable(version)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for old in _versions(spark, name):
        if int(old[-20:]) <= current + 1 - KEPT_VERSIONS:
            spark.sql(f"DROP TABLE {old}")


def append_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = (), now: Column | datetime | None = None
) -> int:
    """Adds rows with audit columns; repeated business keys are welcome.

    The rows go to the version that readers see. A table that was not made here is appended to as it is.
    """
    spark = df.sparkSession
    counted, seen = _observed(with_audit(df, now))
    if fmt in TRANSACTIONAL_FORMATS:
        counted.write.format(fmt).mode("append").partitionBy(*partition_by).saveAsTable(name)
        return seen.get["rows"]
    current = _current(spark, name)
    if current == 0:
        _publish(counted, name, 0, fmt, partition_by)
    else:
        target = name if current is None else _version_name(name, current)
        counted.write.format(fmt).mode("append").partitionBy(*partition_by).saveAsTable(target)
    return seen.get["rows"]


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Full replace, also by an empty frame; readers see the old rows until the new ones are complete.

    The frame may read the table it replaces. The version before the current one is kept
    for queries that still run on it. A table that was not made here raises before anything is written.
    """
    spark = df.sparkSession
    counted, seen = _observed(df)
    if fmt in TRANSACTIONAL_FORMATS:
        counted.write.format(fmt).partitionBy(*partition_by).mode("overwrite").saveAsTable(name)
        return seen.get["rows"]
    current = _current(spark, name)
    if current is None:
        raise ValueError(f"{name} is a table or view that was not written by append_table or replace_table")
    _publish(counted, name, current, fmt, partition_by)
    return seen.get["rows"]


def upsert_table(
    updates: DataFrame, name: str, key: str, fmt: str = "parquet", now: Column | datetime | None = None
) -> int:
    """Insert or update on the key; returns the rows of the batch. The first batch creates the table."""
    spark = updates.sparkSession
    rows = require_unique(updates, key)
    if spark.catalog.tableExists(name):
        replace_table(merged(spark.table(name), updates, key, now), name, fmt)
    else:
        replace_table(with_audit(updates, now), name, fmt)
    return rows


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert_buckets(updates: DataFrame, name: str, key: str, buckets: int = BUCKETS, now: Column | datetime | None = None) -> int:
    """Insert or update on the key in a table that is laid out by hash of the key; returns the rows of the batch.

    Only the buckets that hold a key of the batch are read and rewritten, so a small batch costs the same
    however large the table has grown. The first batch creates the table with its number of buckets, which
    later batches must name too. The table has a column ``_bucket`` besides its own. Other sessions that
    have read the table before must refresh it.
    """
    spark = updates.sparkSession
    rows = require_unique(updates, key)
    placed = updates.withColumn(BUCKET, bucket_of(key, buckets))
    if not spark.catalog.tableExists(name):
        replace_table(with_audit(placed, now), name, partition_by=[BUCKET])
        return rows
    touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]  # fewer than there are buckets
    if touched:
        old = spark.table(name).where(F.col(BUCKET).isin(*touched)).drop(BUCKET)
        staged = scratch_path(spark, "buckets")
        merged(old, updates, key, now).withColumn(BUCKET, bucket_of(key, buckets)).write.parquet(staged)
        replace_folders(spark.read.schema(spark.table(name).schema).parquet(staged), name, BUCKET, touched)
        discard(spark, staged)
    return rows


def location(spark: SparkSession, name: str) -> str:
    """Folder of the version that readers of a table see now."""
    current = _current(spark, name)
    if not current:
        raise ValueError(f"{name} is not a table that was written by append_table or replace_table")
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {_version_name(name, current)}").collect()
    return next(r["data_type"] for r in details if r["col_name"] == "Location")


def refreshed(spark: SparkSession, name: str) -> None:
    """Tells the catalog which partition folders a table has, after some of them were rewritten."""
    version = _version_name(name, _current(spark, name) or 0)
    spark.sql(f"MSCK REPAIR TABLE {version} SYNC PARTITIONS")
    spark.catalog.refreshTable(version)
    spark.catalog.refreshTable(name)


def replace_folders(df: DataFrame, name: str, folder: str, values: Sequence[object]) -> int:
    """Rewrites some partition folders of a table, those of ``values``, and leaves all others.

    The frame has rows of these folders only, and may not read them. It runs once: which folders it fills is
    seen while it is written. A folder it has no row for is removed. ``values`` is one date or whole number per folder, so a
    short list. Other sessions that have read the table before must refresh it.
    """
    spark = df.sparkSession
    path = location(spark, name)
    columns = [c for c in spark.table(name).columns if c != folder]
    found = Observation()
    of_folder = F.col(folder).cast("string")
    written = {
        "filled": F.array_join(F.collect_set(of_folder), "\n"),  # as text, for lists of dates don't pass
        "without": F.count_if(of_folder.isNull()),
    }
    rows = replace_months(df.select(*columns, folder), path, folder, (found, written))
    filled = set(found.get["filled"].split("\n"))
    for value in (v for v in set(values) if not (found.get["without"] if v is None else str(v) in filled)):
        discard(spark, f"{path}/{folder}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    refreshed(spark, name)
    return rows


def replace_months(
    df: DataFrame, path: str, month: str = "order_month", more: tuple[Observation, dict[str, Column]] | None = None
) -> int:
    """Rewrites the months that occur in the frame and leaves all others.

    Rows of a month are brought together first, so that a month is a few files and not one
    per task; a month that is too large for one task is split again. ``more`` observes further aggregates of
    the rows as they are written.
    """
    together = df.hint("rebalance", month)
    if more is not None:
        together = together.observe(more[0], *(value.alias(name) for name, value in more[1].items()))
    counted, seen = _observed(together)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )
    return seen.get["rows"]


def write_silver(orders: DataFrame, name: str) -> int:
    """All silver orders as a table by month of their order date; those without a date form a folder of their own.

    A full replace: months that no order has any more go, and readers see the old orders until the new
    ones are complete. ``replace_folders`` rewrites some months only.
    """
    dated = orders.withColumn("order_month", month_of(F.col("order_date"))).hint("rebalance", "order_month")
    return replace_table(dated, name, partition_by=["order_month"])


def write_csv(df: DataFrame, path: str, null_text: str = "") -> int:
    """A folder of CSV files with headers; see :func:`millrace.sources.readers.csv_options`."""
    counted, seen = _observed(df)
    counted.write.mode("overwrite").options(**csv_options(null_text)).csv(path)
    return seen.get["rows"]


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)
