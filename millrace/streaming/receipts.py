"""Goods receipts for orders as they arrive, and the stock they lead to.

Ledger, bitmaps of booked orders and changes of stock live in partition folders named after the run and the
micro-batch that wrote them; a run is a checkpoint. A replayed batch looks only at what others wrote, then
rewrites its own folders, and a fresh checkpoint sees what earlier runs have booked, so nothing
is booked twice. The run "seed" holds what was there before the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.model import INVENTORY_TRANSACTIONS, PURCHASE
from millrace.plans.movements import fulfilled_orders, new_receipts, next_transaction
from millrace.session import discard, scratch_path
from millrace.streaming.ingest import run_name
from millrace.streaming.references import (
    BATCH,
    RUN,
    Folder,
    folder,
    folders,
    highest_number,
    meeting,
    of_folders,
    references_path,
    write_references,
)
from millrace.streaming.stock import add_changes, add_missing, compact, publish_stock, seed_stock

SEED = "seed"


def seed_ledger(ledger: DataFrame, ledger_path: str, balance_path: str) -> None:
    """Existing ledger, possibly empty, and its balances as the starting point of the stream."""
    spark = ledger.sparkSession
    own = folder(ledger_path, SEED, 0)
    ledger.select(*INVENTORY_TRANSACTIONS.names).write.mode("overwrite").parquet(own)
    stored = spark.read.schema(INVENTORY_TRANSACTIONS).parquet(own)
    write_references(stored, folder(references_path(ledger_path), SEED, 0))
    seed_stock(stored, balance_path, SEED, 0)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    schema = StructType([*INVENTORY_TRANSACTIONS.fields, StructField(RUN, StringType(), True), StructField(BATCH, LongType(), True)])
    return spark.read.schema(schema).parquet(ledger_path)


def _next_number(spark: SparkSession, ledger_path: str, others: set[Folder]) -> int:
    """First free transaction number; only folders that don't say theirs are read."""
    silent = others - folders(spark, references_path(ledger_path))
    number = highest_number(spark, ledger_path, others) + 1
    return max(number, next_transaction(read_ledger(spark, ledger_path).where(of_folders(silent)))) if silent else number


def book_batch(
    ledger_path: str, balance_path: str, materials: DataFrame, warehouses: DataFrame, snapshot: str | None = None, run: str | None = None
):
    """Writes the receipts of one micro-batch and what they change in stock.

    The batch is read once: every look at it would read its files again in full, and choose the latest copies
    again, so the fulfilled orders are stored and all else reads those. Of the ledger only the folders are read
    whose bitmaps meet ids of theirs. Stock grows by a folder of changes, merged into the base now and then. With ``snapshot`` the whole stock is also published as a
    table after each batch. One run at a time books into a ledger.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run or run_name(spark)
        if batch_id == 0:
            add_missing(spark, ledger_path, balance_path)
        others = {(r, b) for r, b in folders(spark, ledger_path) if r != name or b < batch_id}
        fulfilled = fulfilled_orders(batch, PURCHASE).select("bronze_row_id", PURCHASE.id, "material_id", "quantity", PURCHASE.delivery)
        staged = scratch_path(spark, "fulfilled")
        fulfilled.write.parquet(staged)
        orders = spark.read.schema(fulfilled.schema).parquet(staged)
        met = meeting(orders, ledger_path, others)
        booked_before = read_ledger(spark, ledger_path).where(of_folders(met))
        own_path = folder(ledger_path, name, batch_id)
        receipts = new_receipts(batch, booked_before, materials, warehouses, _next_number(spark, ledger_path, others), orders)
        receipts.write.mode("overwrite").parquet(own_path)
        discard(spark, staged)

        booked = spark.read.schema(INVENTORY_TRANSACTIONS).parquet(own_path)
        write_references(booked, folder(references_path(ledger_path), name, batch_id))
        add_changes(spark, booked, balance_path, name, batch_id)
        compact(spark, balance_path)
        if snapshot is not None:
            publish_stock(spark, balance_path, snapshot)

    return write


def book_receipts(
    orders: DataFrame,
    ledger_path: str,
    balance_path: str,
    materials: DataFrame,
    warehouses: DataFrame,
    snapshot: str | None,
    checkpoint: str,
) -> StreamingQuery:
    """Books every bronze order row that arrived since the last run, then ends."""
    return (
        orders.writeStream.foreachBatch(book_batch(ledger_path, balance_path, materials, warehouses, snapshot))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_bronze(
    spark: SparkSession, bronze_path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New files of a bronze folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(bronze_path)
