"""Row predicates of orders and the ledger."""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import tolerant_long
from millrace.model import OrderKind


def in_status(df: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Exact status membership: no trimming, no case folding."""
    return df.where(F.col("status").isin(*statuses))


def materials_of(materials: DataFrame, material_type: str) -> DataFrame:
    return materials.where(F.col("material_type") == F.lit(material_type))


def has_text(column: Column) -> Column:
    """Neither NULL nor empty. Blanks count as text."""
    return column.isNotNull() & (column != F.lit(""))


def movable(df: DataFrame, kind: OrderKind) -> DataFrame:
    """Orders with everything a stock movement needs; the quantity becomes a positive BIGINT."""
    return (
        df.withColumn("quantity", tolerant_long(F.col("quantity")))
        .where(has_text(F.col(kind.id)) & has_text(F.col("material_id")) & has_text(F.col(kind.delivery)))
        .where(F.col("quantity") > 0)
    )


def month_range(year: int | None = None, month: int | None = None) -> tuple[date, date]:
    """First and last day of a month; of the current one when nothing is given."""
    today = date.today()
    year, month = year or today.year, month or today.month
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def in_month(df: DataFrame, day: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Rows of one month, as a plain range on the column so that it reaches the scan."""
    first, last = month_range(year, month)
    return df.where(F.col(day).between(F.lit(first), F.lit(last)))
