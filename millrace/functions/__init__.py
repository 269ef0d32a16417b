"""Column-to-Column building blocks. No Python UDF: everything stays in generated code."""

from millrace.functions.ids import format_id, hash_bucket, parse_id
from millrace.functions.measures import count_where, lead_days, month_of, rate, sum_where
from millrace.functions.text import blank_to_null, is_missing, is_numeric_text, iso_date, tolerant_long

__all__ = [
    "blank_to_null",
    "count_where",
    "format_id",
    "hash_bucket",
    "is_missing",
    "is_numeric_text",
    "iso_date",
    "lead_days",
    "month_of",
    "parse_id",
    "rate",
    "sum_where",
    "tolerant_long",
]
