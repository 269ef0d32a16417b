"""Tolerant readings of bronze text. Nothing here raises on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number and as a date.
FLOAT_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
NUMERIC_TEXT = r"^-?[0-9]+(\.[0-9]+)?$"
ISO_DATE_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DIGIT_GROUPING = r"(?<=[0-9])_(?=[0-9])"


def blank_to_null(text: Column) -> Column:
    """Trimmed text; NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def is_missing(text: Column) -> Column:
    """NULL, empty or only blanks."""
    return blank_to_null(text).isNull()


def tolerant_long(text: Column) -> Column:
    """Number text, also float text, cut toward zero. NULL when unreadable, infinite or too large.

    The pattern keeps out what a plain cast would let through: ``1d``, ``nan``, ``inf``.
    """
    raw = text.cast("string")
    plain = F.when(raw.contains("_"), F.regexp_replace(raw, DIGIT_GROUPING, "")).otherwise(raw)
    return F.when(plain.rlike(FLOAT_TEXT), plain.try_cast("double").try_cast("bigint"))


def is_numeric_text(text: Column) -> Column:
    return F.coalesce(text.rlike(NUMERIC_TEXT), F.lit(False))


def iso_date(text: Column, lenient: bool = False) -> Column:
    """``yyyy-MM-dd`` as a date, else NULL. Lenient reads the first ten characters, so a time part may follow."""
    day = F.substring(text, 1, 10) if lenient else text
    return F.when(day.rlike(ISO_DATE_TEXT), day.try_cast("date"))
