"""Raw rows as the order tables keep them: everything text and nullable, plus a surrogate row id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def row_ids(above: int = 0) -> Column:
    """Row ids above a stored maximum, for batch loads and streams alike.

    Unique, ascending with the read order within a task, with gaps. A load that no longer fits
    into a BIGINT raises.
    """
    counter = F.monotonically_increasing_id()
    fits = counter < F.lit(2**63 - 1 - above - 1)
    return F.when(fits, F.lit(above).cast("bigint") + 1 + counter).otherwise(F.raise_error(F.lit("no row ids left")).cast("bigint"))


def conform(df: DataFrame, columns: Sequence[str] | StructType, above: int = 0) -> DataFrame:
    """Named columns as text, missing ones NULL, and a ``bronze_row_id`` above a stored maximum.

    The row id is unique and follows the read order within a partition; it has gaps.
    """
    names = columns.names if isinstance(columns, StructType) else list(columns)
    names = [c for c in names if c != "bronze_row_id"]
    present = set(df.columns)
    texts = [
        (F.col(c) if c in present else F.lit(None)).cast("string").alias(c)
        for c in names
    ]
    return df.select(row_ids(above).alias("bronze_row_id"), *texts)


def highest_row_id(bronze: DataFrame) -> int:
    """Stored maximum, 0 for an empty table."""
    return bronze.agg(F.coalesce(F.max("bronze_row_id"), F.lit(0).cast("bigint"))).first()[0]
