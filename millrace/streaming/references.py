"""Which folders of the ledger a batch of orders can meet, without reading the ledger.

Beside each folder lies what it has booked: bitmaps of the numbers in its order ids, one for each range of
numbers, whether it has ids of another form, and the highest transaction numbers. A batch's own bitmaps
are ANDed with them; folders that meet none of its ids are not read. Bitmaps say which number, not which text, so
the ids themselves are compared in the folders that are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import parse_id
from millrace.model import GOODS_RECEIPT, PURCHASE, TRANSACTION_PREFIX

RUN, BATCH = "receipt_run", "receipt_batch"
FIELDS = f"bucket bigint, bits binary, last_number bigint, {RUN} string, {BATCH} bigint"

#: The bucket of ledger rows that book no order; those of order numbers start at 1.
NO_ORDER = -1

Folder = tuple[str, int]


def references_path(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}-references"


def folder(path: str, run: str, batch_id: int) -> str:
    return f"{path}/{RUN}={run}/{BATCH}={batch_id}"


def folders(spark: SparkSession, path: str) -> set[Folder]:
    """(run, batch) of the complete folders below a path."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{RUN}=*/{BATCH}=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    parts = [str(s.getPath().getParent()).split("/")[-2:] for s in found or []]
    return {(run.partition("=")[2], int(batch.partition("=")[2])) for run, batch in parts}


def of_folders(wanted: set[Folder]) -> Column:
    """Rows of some folders, as a condition on the partition columns."""
    runs: dict[str, list[int]] = {}
    for run, batch in sorted(wanted):
        runs.setdefault(run, []).append(batch)
    conditions = [(F.col(RUN) == run) & F.col(BATCH).isin(*batches) for run, batches in runs.items()]
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _order_number(reference: Column) -> Column:
    number = parse_id(reference, PURCHASE.id_prefix)
    return F.when(number > 0, number)


def _bitmap() -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("number", F.lit(1))))


def _bits(ids: DataFrame, reference: str) -> DataFrame:
    """Bitmaps of the numbers in the ids; those of another form make a row with a NULL bucket."""
    usable = ids.where(F.col(reference).isNotNull()).select(_order_number(F.col(reference)).alias("number"))
    return usable.groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(_bitmap().alias("bits"))


def write_references(ledger: DataFrame, path: str) -> None:
    """What the rows of one ledger folder have booked; also for a folder without rows.

    Each bucket has the highest transaction number of its rows, so the ledger is read once. Rows that book no
    order have a bucket of their own, without bits.
    """
    order = F.when(F.col("transaction_type") == GOODS_RECEIPT, F.col("reference_id"))
    rows = ledger.select(
        order.isNull().alias("no_order"),
        _order_number(order).alias("number"),
        parse_id(F.col("transaction_id"), TRANSACTION_PREFIX).alias("last_number"),
    )
    bucket = F.when(F.col("no_order"), F.lit(NO_ORDER)).otherwise(F.bitmap_bucket_number("number")).alias("bucket")
    held = rows.groupBy(bucket).agg(_bitmap().alias("bits"), F.max("last_number").alias("last_number"))
    bits = F.when(F.col("bucket").isNull() | (F.col("bucket") != NO_ORDER), F.col("bits"))
    held.withColumn("bits", bits).coalesce(1).write.mode("overwrite").parquet(path)


def read_references(spark: SparkSession, ledger_path: str) -> DataFrame:
    return spark.read.schema(FIELDS).parquet(references_path(ledger_path))


def meeting(batch: DataFrame, ledger_path: str, candidates: set[Folder]) -> set[Folder]:
    """Those of the candidate folders that may have booked an order of the batch.

    A folder without bitmaps is always among them, for instance one whose writer was ended before it wrote them.
    """
    spark = batch.sparkSession
    indexed = candidates & folders(spark, references_path(ledger_path))
    if not indexed:
        return set(candidates)
    own = _bits(batch, PURCHASE.id).select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_own"))
    kept = read_references(spark, ledger_path).where(of_folders(indexed))
    both = kept.join(F.broadcast(own), F.col("bucket").eqNullSafe(F.col("_bucket")))
    pairs = both.select(RUN, BATCH, "bucket", F.explode(F.array("bits", "_own")).alias("bits"))
    common = pairs.groupBy(RUN, BATCH, "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    met = common.where("n > 0").select(RUN, BATCH).distinct().collect()  # one row for each folder
    return (candidates - indexed) | {(r[RUN], r[BATCH]) for r in met}


def highest_number(spark: SparkSession, ledger_path: str, candidates: set[Folder]) -> int:
    """The highest transaction number of indexed folders, 0 if there is none."""
    indexed = candidates & folders(spark, references_path(ledger_path))
    if not indexed:
        return 0
    return read_references(spark, ledger_path).where(of_folders(indexed)).agg(F.max("last_number")).first()[0] or 0
