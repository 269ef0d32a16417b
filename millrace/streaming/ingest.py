"""Files to bronze, each file once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.plans.bronze import highest_row_id, row_ids
from millrace.session import path_exists
from millrace.sources.readers import csv_options


def stream_csv(spark: SparkSession, landing: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New CSV files of a folder as text rows with their file and the time they were read."""
    reader = spark.readStream.schema(schema).options(**csv_options())
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(landing).select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingested_at")
    )


def run_name(spark: SparkSession) -> str:
    """The id of the streaming query whose micro-batch is at work. Its checkpoint keeps it, so a
    restart goes on under the same name and a fresh checkpoint has another."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def write_batch(target: str, run: str | None = None):
    """Each micro-batch of a run owns one partition folder, so a replay rewrites what it wrote before.

    Row ids go on above all other folders' and above what ``floor`` says of other tables, so the copy
    that arrived last has the highest id, whether it came by a stream or a batch load.
    """

    def write(batch: DataFrame, batch_id: int, floor: int = 0) -> None:
        name = run or run_name(batch.sparkSession)
        own = f"ingest_run={name}/ingest_batch={batch_id}"
        above = max(floor, highest_elsewhere(batch.sparkSession, target, name, batch_id))
        rows = batch.select(row_ids(above).alias("bronze_row_id"), "*")
        rows.write.mode("overwrite").parquet(f"{target}/{own}")

    return write


def highest_elsewhere(spark: SparkSession, target: str, run: str, batch_id: int) -> int:
    """The highest row id in the target outside one batch's folder; reads one column."""
    if not path_exists(spark, target):
        return 0
    fields = "bronze_row_id bigint, ingest_run string, ingest_batch bigint"
    others = spark.read.schema(fields).parquet(target).where(~((F.col("ingest_run") == run) & (F.col("ingest_batch") == batch_id)))
    return highest_row_id(others)


def ingest_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    floor: Callable[[], int] = lambda: 0,
) -> StreamingQuery:
    """Takes in the files that are there now and not yet known to the checkpoint, then ends.

    Several landing folders, each with its checkpoint, may fill one target. ``floor`` gives the
    highest row id of a table that is loaded in batches beside the stream.
    """
    write = write_batch(target)
    return (
        stream_csv(spark, landing, schema, files_per_batch)
        .writeStream.foreachBatch(lambda batch, batch_id: write(batch, batch_id, floor()))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
