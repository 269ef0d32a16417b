"""Numbers for business ids: the next free one, and dense numbering at scale."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructField, StructType

from millrace.functions import parse_id
from millrace.session import discard, scratch_path

# monotonically_increasing_id() is the partition number above 33 bits of row position.
POSITION_BITS = 33
# Rows that a range of numbers should hold; one with more than twice as many is cut again.
ROWS_PER_BUCKET = 1 << 20
FEWEST_RANGES = 64
FINER_BITS = 8
LOWEST = -(1 << 63)


def next_number(df: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """One row: highest number behind the prefix, plus one. Other texts and NULL do not count; 1 when empty."""
    highest = F.max(parse_id(F.col(id_column), prefix))
    return df.agg((F.coalesce(highest, F.lit(0).cast("bigint")) + 1).alias("next_number"))


def dense_numbers(
    df: DataFrame, order: Sequence[str], start: int = 1, name: str = "number", by: str | None = None, rows: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Rows numbered from ``start`` without gaps, in the order of columns that are unique together.

    A global ``row_number`` would sort the table in one task. Here an integer column, ``by`` or the first
    of the order, is cut into ranges. The rows of each range are counted, a range that holds too many is cut
    again and counted again, and what stands before each range is added up. A row's number is that plus its
    rank within its range. Counting reads the order columns only; nothing is written, and the frame must
    give the same rows whenever it runs. It runs three times or more: a costly one is ``settled`` first. The
    counts, one for each million rows or so, pass through the driver.

    Columns of the order before ``by`` have few values. When no integer column leads, the rows are dealt
    out by range instead, see :func:`dense_numbers_by_range`.
    """
    by = by or order[0]
    if not isinstance(df.schema[by].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return dense_numbers_by_range(df, order, start, name)
    spark, lead = df.sparkSession, list(order[: order.index(by)])
    at = F.coalesce(F.col(by).cast("bigint"), F.lit(LOWEST))
    low, high, total = df.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    if not total:
        return df.withColumn(name, F.lit(start).cast("bigint"))
    ranges = max(FEWEST_RANGES, -(-total // rows))
    bits = max(0, ((high - low) // ranges).bit_length())
    placed, counts = df.withColumn("_low", _floor(at, bits)), {}
    counted = df.select(*lead, at.alias("_at")).withColumn("_low", _floor(F.col("_at"), bits))
    fields = StructType([*(StructField(c, df.schema[c].dataType) for c in lead), StructField("_low", LongType())])
    while True:
        found = {tuple(r)[:-1]: r["n"] for r in counted.groupBy(*lead, "_low").agg(F.count(F.lit(1)).alias("n")).collect()}
        counts |= found
        crowded = [key for key, n in found.items() if n > 2 * rows and bits]
        if not crowded:
            break
        for key in crowded:
            del counts[key]
        bits = max(0, bits - FINER_BITS)
        cut = F.broadcast(spark.createDataFrame(crowded, fields).select(*(F.col(c).alias(f"_of_{c}") for c in fields.names)))
        same = _equal(fields.names, "_of_")
        gone = [f"_of_{c}" for c in fields.names]
        counted = counted.join(cut, same, "left_semi").withColumn("_low", _floor(F.col("_at"), bits))
        finer = F.when(F.col("_of__low").isNotNull(), _floor(at, bits)).otherwise(F.col("_low"))
        placed = placed.join(cut, same, "left").withColumn("_low", finer).drop(*gone)
    before, done = [], start - 1
    for key in sorted(counts, key=lambda k: [(v is not None, v) for v in k]):
        before.append((*key, done))
        done += counts[key]
    offsets = spark.createDataFrame(before, StructType([*fields.fields, StructField("_before", LongType())]))
    offsets = offsets.select(*(F.col(c).alias(f"_of_{c}") for c in fields.names), "_before")
    within = Window.partitionBy(*fields.names).orderBy(*order)
    ranked = placed.withColumn("_rank", F.row_number().over(within))
    return (
        ranked.join(F.broadcast(offsets), _equal(fields.names, "_of_"))
        .withColumn(name, F.col("_before") + F.col("_rank"))
        .drop("_low", "_rank", "_before", *(f"_of_{c}" for c in fields.names))
    )


def _floor(value: Column, bits: int) -> Column:
    """The start of the range of 2^bits numbers that holds the value, also below zero."""
    return value.bitwiseAND(F.lit(-(1 << bits)).cast("bigint"))


def _equal(names: Sequence[str], prefix: str) -> Column:
    conditions = [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in names]
    return reduce(lambda a, b: a & b, conditions)


def dense_numbers_by_range(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "number") -> DataFrame:
    """The same for order columns of any type.

    The rows are range partitioned and sorted, which balances any distribution of the order columns.
    Numbering takes two passes, partition sizes and then rows, and both must see the same partitions,
    also after an executor was lost; so the partitioned rows are written once and read
    twice. The rows are settled in a table before that as well, since range partitioning
    samples its input and would run everything below it twice. Only the sizes, one row per
    partition, are summed up in order and broadcast.
    """
    spark = df.sparkSession
    settled, numbered = scratch_path(spark, "settled"), scratch_path(spark, "numbered")
    ranged = _stored(df, settled).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = _stored(ranged.withColumn("_slot", F.monotonically_increasing_id()), numbered).withColumn(
        "_part", F.shiftright("_slot", POSITION_BITS)
    )
    discard(spark, settled)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    position = F.col("_slot").bitwiseAND(F.lit(2**POSITION_BITS - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start).cast("bigint") + F.col("_before") + position)
        .drop("_part", "_slot", "_before")
    )


def settled(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, for a frame that is costly to work out and read several times."""
    return _stored(df, scratch_path(df.sparkSession, "settled"))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written to the shared folder and read back: a cut in the lineage that outlives executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
