"""Master data kept current from a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedupe import keep_latest
from millrace.sources.sinks import BUCKET, BUCKETS, bucket_of, upsert_buckets


def newer_changes(batch: DataFrame, stored: DataFrame | None, key: str, order: str) -> DataFrame:
    """The highest ``order`` of each key in the batch, where it is above the one that is stored.

    Equal orders go by all other columns, so a replay chooses the same row; a change without an
    order counts as the lowest.
    """
    ties = [order, *(c for c in batch.columns if c not in (key, order))]
    latest = keep_latest(batch, key, ties)
    if stored is None:
        return latest
    known = stored.select(key, F.col(order).alias("_known"), F.lit(True).alias("_stored"))
    newer = F.col("_stored").isNull() | (F.col(order) > F.col("_known")) | (F.col("_known").isNull() & F.col(order).isNotNull())
    return latest.join(known, key, "left").where(newer).drop("_known", "_stored")


def upsert_stream(
    changes: DataFrame, table: str, key: str, order: str, checkpoint: str, buckets: int = BUCKETS
) -> StreamingQuery:
    """Upserts each micro-batch into a master table laid out by hash of its key; the highest ``order`` of a key wins.

    A micro-batch reads and rewrites the buckets of its own keys only.

    The order is stored with the row, so an older change that arrives in a later batch, or
    after a new checkpoint, changes nothing. Replaying a batch changes nothing either.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = None
        if spark.catalog.tableExists(table):
            own = [r[0] for r in batch.select(bucket_of(key, buckets)).distinct().collect()]
            stored = spark.table(table).where(F.col(BUCKET).isin(*own))
        upsert_buckets(newer_changes(batch, stored, key, order), table, key, buckets)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
