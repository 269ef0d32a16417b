"""Insert or update on a business key, as a pure function of two frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("created_at", "updated_at")


def with_audit(df: DataFrame, now: Column | datetime | None = None) -> DataFrame:
    """Both audit columns set to the write time."""
    at = _instant(now)
    return df.withColumns({"created_at": at, "updated_at": at})


def _instant(now: Column | datetime | None) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now)


def require_unique(df: DataFrame, key: str) -> int:
    """Rows of the batch; raises when a key is NULL or repeated. One aggregate, one row comes back."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.max_by(key, "n").alias("example"),
        F.max("n").alias("most"),
        F.count_if(F.col(key).isNull()).alias("missing"),
    ).first()
    if found["missing"]:
        raise ValueError(f"a row of the batch has no {key}")
    if found["rows"] and found["most"] > 1:
        raise ValueError(f"{key} {found['example']!r} occurs {found['most']} times in one batch")
    return found["rows"]


def upsert(target: DataFrame, updates: DataFrame, key: str, now: Column | datetime | None = None) -> DataFrame:
    """The target after the batch: new keys inserted, known keys take every value of the batch."""
    require_unique(updates, key)
    return merged(target, updates, key, now)


def merged(target: DataFrame, updates: DataFrame, key: str, now: Column | datetime | None = None) -> DataFrame:
    """:func:`upsert` of a batch whose keys were checked before.

    ``created_at`` of a known key is kept, ``updated_at`` changes on the rows the batch
    touches. NULL in the batch overwrites. One full join on the unique key does it all. Batch and
    target must have the same columns, but for the audit columns; otherwise a value would be lost.
    """
    at = _instant(now)
    values = [c for c in target.columns if c != key and c not in AUDIT_COLUMNS]
    given = [c for c in updates.columns if c != key and c not in AUDIT_COLUMNS]
    if set(given) != set(values):
        unknown, absent = sorted(set(given) - set(values)), sorted(set(values) - set(given))
        raise ValueError(f"columns the target does not have: {unknown}; columns the batch does not have: {absent}")
    old = target.select(key, *(F.col(c).alias(f"_old_{c}") for c in target.columns if c != key))
    new = updates.select(key, *values, F.lit(True).alias("_touched"))
    touched = F.col("_touched").isNotNull()
    after = {c: F.when(touched, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in values}
    after[key] = F.col(key)
    after["created_at"] = F.coalesce(F.col("_old_created_at"), at).alias("created_at")
    after["updated_at"] = F.when(touched, at).otherwise(F.col("_old_updated_at")).alias("updated_at")
    return old.join(new, key, "full").select(*(after[c] for c in target.columns))
