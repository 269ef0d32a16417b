"""Latest copy per business key.

Bronze order ids are not unique. Which copy survives is decided by the surrogate row
id, so ``dropDuplicates`` (any copy) does not do. NULL keys count as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, order: str | Sequence[str] = "bronze_row_id") -> DataFrame:
    """One row per key: the one with the highest order columns.

    ``row_number() = 1`` makes Spark put a group limit below the shuffle, so every map
    task sends at most one row per key. A key holding a third of the table costs one
    row per task, not one giant reducer.
    """
    columns = [order] if isinstance(order, str) else list(order)
    latest_first = Window.partitionBy(key).orderBy(*(F.desc(c) for c in columns))
    return df.withColumn("_copy", F.row_number().over(latest_first)).where("_copy = 1").drop("_copy")


def keep_latest_counted(df: DataFrame, key: str, order: str = "bronze_row_id", copies: str = "_copies") -> DataFrame:
    """:func:`keep_latest` plus the number of copies the key had.

    One aggregate does both: a task sends one row per key with the highest order it met and a
    count, so a hot key costs one row per task. NULL keys are one group.
    """
    others = [c for c in df.columns if c not in (key, order)]
    latest = F.max(F.struct(order, *others)).alias("_latest")
    counted = df.groupBy(key).agg(latest, F.count(F.lit(1)).alias(copies))
    return counted.select(*(F.col(key) if c == key else F.col("_latest")[c].alias(c) for c in df.columns), copies)


def mark_repeated(df: DataFrame, key: str, row_id: str = "bronze_row_id", marker: str = "_repeated") -> DataFrame:
    """Every row, with a marker on those whose key occurs more than once.

    The rows that stand alone are found by a narrow aggregate and matched back on the
    unique row id, so neither step has a key that can grow hot.
    """
    alone = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(row_id).alias(row_id))
        .where("_n = 1")
        .select(row_id, F.lit(False).alias(marker))
    )
    return df.join(alone, row_id, "left").withColumn(marker, F.coalesce(F.col(marker), F.lit(True)))
