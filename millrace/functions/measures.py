"""Measures the KPI tables share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of the value where the condition holds, 0 elsewhere; a NULL value stays out of the sum."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("bigint")))


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded half up; NULL where the whole is 0 or NULL."""
    return F.round(F.try_divide(part, whole), digits)


def month_of(day: Column) -> Column:
    """First day of the month as a DATE, so no session time zone enters the value."""
    return F.trunc(day, "month")


def lead_days(ordered: Column, due: Column) -> Column:
    return F.datediff(due, ordered)
