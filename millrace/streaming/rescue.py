"""File ingest that loses no record, whatever its header or fields look like.

Each file is read by its own header, so columns may come in another order, be absent or be new. A value of
a column that the schema doesn't have goes to the ``_rescued`` map of its row. A record with more or fewer
fields than its header, or with quotes that don't close, is no row: it goes to a quarantine folder as it
stands, with its file, line and the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.plans.bronze import row_ids
from millrace.session import discard, scratch_path
from millrace.streaming.ingest import highest_elsewhere, run_name

RESCUED = "_rescued"
#: A field with the comma behind it: quoted, with quotes doubled inside, or plain.
_FIELD = '("(?:[^"]|"")*"|[^,"]*),'
_FILE, _LINE, _RAW = "_file", "_line", "_raw"


def stream_lines(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of new files with their file and split."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing).select(
        F.col("value").alias(_RAW), F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias("_block")
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """One narrow row for each split of a file: where its lines begin and how many stand before it in the file."""
    splits = lines.groupBy(_FILE, "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(_FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(_FILE, "_block", "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))


def numbered_lines(lines: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Lines with ``_line``, counted from 1 in each file. ``_at`` must rise within a split of a file.

    Splits are counted, and each learns how many lines stand before it. A caller that has stored the
    :func:`split_starts` passes them, and the lines aren't read for them again.
    """
    numbered = lines.join(F.broadcast(split_starts(lines) if starts is None else starts), [_FILE, "_block"])
    return numbered.select(_FILE, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(_LINE), _RAW)


def _plain(field: Column) -> Column:
    """A field without its quotes; an empty one is NULL."""
    inner = F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.nullif(F.when(field.startswith('"'), inner).otherwise(field), F.lit(""))


def _fields(raw: Column) -> tuple[Column, Column]:
    """The fields of a record and whether all of it was read."""
    found = F.regexp_extract_all(F.concat(raw, F.lit(",")), F.lit(_FIELD), F.lit(1))
    length = F.aggregate(found, F.lit(0), lambda n, x: n + F.length(x) + 1)
    return F.transform(found, _plain), length == F.length(raw) + 1


def _without_return(raw: str) -> Column:
    return F.regexp_replace(raw, "\r$", "")


def file_heads(lines: DataFrame, schema: StructType) -> DataFrame:
    """One row for each file: the size of its header, and which field belongs to which column.

    ``_places`` has the last field of each column of the schema, 0 for none, ``_others`` the fields that no
    column has. What a header says is found here, once for a file, and not again for each record.
    """
    header = _fields(F.regexp_replace(_without_return(_RAW), "^﻿", ""))[0]
    heads = lines.where(F.col(_LINE) == 1).select(F.col(_FILE).alias("_of"), header.alias("_header"))
    backwards = F.reverse("_header")

    def last(name: str) -> Column:
        found = F.array_position(backwards, name)
        return F.when(found > 0, F.size("_header") - found + 1).otherwise(0).cast("int")

    named = F.filter("_header", lambda x: x.isNotNull())
    fields = F.transform("_header", lambda x, i: F.struct(x.alias("name"), i.alias("at")))
    others = F.filter(fields, lambda f: ~F.coalesce(f["name"].isin(*schema.names), F.lit(False)))
    return heads.select(
        "_of",
        F.size("_header").alias("_wanted"),
        F.array(*map(last, schema.names)).alias("_places"),
        F.transform(others, lambda f: F.struct(F.coalesce(f["name"], F.lit("")).alias("key"), f["at"].alias("at"))).alias("_others"),
        (F.size(F.array_distinct(named)) < F.size(named)).alias("_repeated"),
    )


def split_records(
    lines: DataFrame, schema: StructType, heads: DataFrame | None = None, damaged: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows in the columns of a text schema with ``_rescued``, and the records that are none.

    ``lines`` has file, line and raw text; the first line of a file is its header. A row's ``_rescued`` is
    NULL when all its fields have a column, otherwise it holds the others by their name in the header, and the
    file, line and raw text. Blank lines are no records. Of columns that a header names twice the last
    counts; the record is rescued too. A file with nothing but a header has no rows.

    A caller that has stored the :func:`file_heads` passes them. ``damaged`` learns while the rows are read how
    many records are none, as ``held``.
    """
    raw = _without_return(_RAW)
    heads = file_heads(lines, schema) if heads is None else heads
    body = lines.where((F.col(_LINE) > 1) & (F.length(F.trim(raw)) > 0))
    fields, whole = _fields(raw)
    read = body.withColumns({"_fields": fields, "_whole": whole}).join(F.broadcast(heads), F.col(_FILE) == F.col("_of"))
    n, wanted = F.size("_fields"), F.col("_wanted")
    reason = (
        F.when(~F.col("_whole"), "quotes that do not close")
        .when(n > wanted, "more fields than the header")
        .when(n < wanted, "fewer fields than the header")
    )
    read = read.withColumn("_reason", reason)
    held = read.where(F.col("_reason").isNotNull()).select(_FILE, _LINE, _RAW, F.col("_reason").alias("reason"))

    seen = read if damaged is None else read.observe(damaged, F.count("_reason").alias("held"))
    good = seen.where(F.col("_reason").isNull())
    places = {name: F.get("_places", F.lit(i)) for i, name in enumerate(schema.names)}
    values = [F.when(at > 0, F.get("_fields", at - 1)).alias(name) for name, at in places.items()]
    found = F.transform("_others", lambda f: F.struct(f["key"].alias("key"), F.get("_fields", f["at"]).alias("value")))
    entries = F.filter(found, lambda e: e["value"].isNotNull())
    # of fields under one name the last is kept
    last = F.aggregate(
        entries,
        F.lit(None).cast("map<string,string>"),
        lambda done, e: F.map_concat(
            F.map_filter(F.coalesce(done, F.create_map().cast("map<string,string>")), lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])
        ),
    )
    where = F.create_map(
        F.lit(_FILE), F.col(_FILE), F.lit(_LINE), F.col(_LINE).cast("string"), F.lit(_RAW), F.col(_RAW)
    )
    own = F.map_filter(F.coalesce(last, F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(_FILE, _LINE, _RAW))
    rescued = F.when((F.size(entries) > 0) | F.col("_repeated"), F.map_concat(own, where))
    return good.select(*values, rescued.alias(RESCUED), F.col(_FILE).alias("source_file")), held


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_rescued(target: str, quarantine: str, schema: StructType, run: str | None = None):
    """Each micro-batch of a run owns a folder of the target and one of the quarantine; a replay rewrites both."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run or run_name(spark)
        own = f"ingest_run={name}/ingest_batch={batch_id}"
        # the batch is settled first: lines are numbered by where they stand in a task
        staged = scratch_path(spark, "lines")
        settled = _stored(batch.withColumn("_at", F.monotonically_increasing_id()), f"{staged}/lines")
        lines = numbered_lines(settled, _stored(split_starts(settled), f"{staged}/starts"))
        heads, damaged = _stored(file_heads(lines, schema), f"{staged}/heads"), Observation()
        rows, held = split_records(lines, schema, heads, damaged)
        above = highest_elsewhere(spark, target, name, batch_id)
        stamped = rows.select(row_ids(above).alias("bronze_row_id"), *rows.columns, F.current_timestamp().alias("ingested_at"))
        stamped.write.mode("overwrite").parquet(f"{target}/{own}")
        # most batches have no damaged record, and need no second look
        held = held if damaged.get.get("held", 1) else held.limit(0)
        held.write.mode("overwrite").parquet(f"{quarantine}/{own}")
        discard(spark, staged)

    return write


def ingest_rescued(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    quarantine: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Takes in the files that are there now and not yet known to the checkpoint, then ends.

    Fields may not hold line breaks. Other text than UTF-8 is read as Spark reads it.
    """
    return (
        stream_lines(spark, landing, files_per_batch)
        .writeStream.foreachBatch(write_rescued(target, quarantine, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
