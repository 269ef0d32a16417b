"""Ranked top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, measure: str, tie_break: str, rank: str) -> DataFrame:
    """The k rows with the highest measure, ranked from 1; equal measures in the order of ``tie_break``.

    Sort and limit run as one take-ordered step that keeps k rows per task, so the
    unpartitioned window ranks k rows, never the table.
    """
    best = [F.desc(measure), F.asc(tie_break)]
    return df.orderBy(*best).limit(k).withColumn(rank, F.row_number().over(Window.orderBy(*best)))
