"""Joins of many fact rows to a reference with one row per key.

A reference is broadcast only after its size was checked. Beyond the limit both sides
are shuffled, and keys that hold an unusual share of the facts are cut into pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to the first limit Spark's estimate is believed, as Spark itself does; between the two it
# is checked by measuring, as join estimates run high; above the second nothing is measured.
ESTIMATE_LIMIT = 10 * 1024 * 1024
MEASURE_LIMIT = 1024 * 1024 * 1024
# Most bytes that are broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024
# A key is heavy when it holds more than 1/PIECES of all rows, so there are fewer than
# PIECES heavy keys whatever the table size. That bounds what is broadcast below.
PIECES = 1000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate for the optimized plan; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Exact text size of all values plus 16 bytes per value, by one distributed aggregate."""
    per_row = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(16) for c in df.columns), F.lit(0)
    )
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    estimate = estimated_bytes(df)
    if estimate <= min(limit, ESTIMATE_LIMIT):
        return True
    return limit > 0 and estimate <= MEASURE_LIMIT and measured_bytes(df) <= limit


def heavy_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys above 1/PIECES of all rows and the pieces each is cut into; fewer than PIECES rows."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = facts.agg(F.count(F.lit(1))).scalar()
    return (
        counts.withColumn("_total", total)
        .where(F.col("_n") * PIECES > F.col("_total"))
        .select(key, F.ceil(F.col("_n") * PIECES / F.col("_total")).cast("int").alias("_pieces"))
    )


def _cut(
    facts: DataFrame, reference: DataFrame, key: str, row_id: str, weighed_by: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_piece``: each fact row in one piece of its key, each reference row in all of them."""
    heavy = F.broadcast(heavy_keys(facts if weighed_by is None else weighed_by, key))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    spread = F.when(F.col(key).isNull(), F.lit(PIECES)).otherwise(pieces)
    piece = F.pmod(F.xxhash64(F.col(row_id)), spread).cast("int")
    every_piece = F.explode(F.sequence(F.lit(0), pieces - 1))
    return (
        facts.join(heavy, key, "left").withColumn("_piece", piece).drop("_pieces"),
        reference.join(heavy, key, "left").withColumn("_piece", every_piece).drop("_pieces"),
    )


def lookup(
    facts: DataFrame,
    reference: DataFrame,
    key: str,
    row_id: str = "bronze_row_id",
    broadcast_limit: int = BROADCAST_LIMIT,
    weighed_by: DataFrame | None = None,
) -> DataFrame:
    """Left join of the facts to a reference that is unique on ``key``.

    ``row_id`` must be unique in the facts: it spreads the rows of a heavy key, and the
    rows without a key, over the pieces. ``weighed_by`` is a cheaper frame with about the
    same keys, for instance the scan below a deduplication; which keys are heavy is then
    counted there. It decides how the work is spread, not what comes out.
    """
    if fits_broadcast(reference, broadcast_limit):
        return facts.join(F.broadcast(reference), key, "left")
    cut_facts, cut_reference = _cut(facts, reference, key, row_id, weighed_by)
    return cut_facts.join(cut_reference, [key, "_piece"], "left").drop("_piece")


def mark_known(
    facts: DataFrame,
    keys: DataFrame,
    key: str,
    marker: str,
    row_id: str = "bronze_row_id",
    broadcast_limit: int = BROADCAST_LIMIT,
    weighed_by: DataFrame | None = None,
) -> DataFrame:
    """Every fact row, with a marker that its key occurs in ``keys``. A NULL key is never known.

    Repeated keys do no harm. Without a broadcast they are removed in the same shuffle that
    serves the join.
    """
    known = keys.select(key).where(F.col(key).isNotNull())
    if fits_broadcast(known, broadcast_limit):
        marked = facts.join(F.broadcast(known.distinct().withColumn(marker, F.lit(True))), key, "left")
    else:
        cut_facts, cut_keys = _cut(facts, known, key, row_id, weighed_by)
        distinct = cut_keys.select(key, "_piece").distinct().withColumn(marker, F.lit(True))
        marked = cut_facts.join(distinct, [key, "_piece"], "left").drop("_piece")
    return marked.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def keep_known(
    facts: DataFrame,
    keys: DataFrame,
    key: str,
    row_id: str = "bronze_row_id",
    broadcast_limit: int = BROADCAST_LIMIT,
    weighed_by: DataFrame | None = None,
) -> DataFrame:
    """Semi join: fact rows whose key occurs in ``keys``."""
    marked = mark_known(facts, keys, key, "_known", row_id, broadcast_limit, weighed_by)
    return marked.where("_known").drop("_known")


def drop_known(facts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Anti join: fact rows whose key does not occur in ``keys``; rows without a key stay.

    For facts that are unique on the key (orders after ``keep_latest``), so no key can be
    heavy. A small batch against a long history is broadcast first to pick the few history
    rows that matter, so the history is scanned but not shuffled. Empty ``keys`` drop nothing.
    """
    own = facts.select(key)
    if fits_broadcast(own):
        keys = keys.join(F.broadcast(own), key, "left_semi")
    return facts.join(keys.select(key).distinct(), key, "left_anti")
