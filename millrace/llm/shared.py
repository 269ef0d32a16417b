"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace
from millrace.session import discard, scratch_path

#: A word is a run of characters other than these: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Keys above this share of the rows are cut into pieces of it, hence fewer than a thousand keys.
HEAVY_SHARE = 1000
#: So many rows are no large part of a job: below, no key is cut into pieces.
FEW = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch folders written in this process, oldest first.
_WRITTEN: list[str] = []


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame to the folder all executors share and reads it back.

    Cuts the lineage and makes what several jobs read the same rows, also when an executor is lost.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    _WRITTEN.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def written_since(mark: int) -> list[str]:
    """Scratch folders written after so many others."""
    return _WRITTEN[mark:]


def scratch_mark() -> int:
    """How many scratch folders were written up to now."""
    return len(_WRITTEN)


def discard_unread(spark: SparkSession, paths: list[str], frame: DataFrame) -> list[str]:
    """Removes scratch folders, but for those that a frame still reads; they are returned."""
    roots, kept = _roots(frame), []
    for path in paths:
        if any(path.split(":", 1)[-1].lstrip("/") in root for root in roots):
            kept.append(path)
        else:
            discard(spark, path)
    return kept


def _roots(frame: DataFrame) -> list[str]:
    """Folders that a plan reads files of."""
    leaves, roots = frame._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            roots += [paths.apply(j).toString() for j in range(paths.size())]
    return roots


def named(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(frame: DataFrame) -> Column:
    """All columns as one, so that no name of theirs meets one that an operator uses."""
    return F.struct(*[named(x) for x in frame.columns])


def from_row(frame: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The columns of a frame, taken out of ``_row`` again, but for some."""
    return [F.col("_row")[x].alias(x) for x in frame.columns if x not in without]


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def spread_join(left: DataFrame, right: DataFrame, on: str, weight: str, spread: Column, total: int | None = None) -> DataFrame:
    """Inner join where some keys hold a large part of ``left``.

    ``right`` has one row per key and in ``weight`` the rows that ``left`` has of it. A key above a
    thousandth of all is cut into pieces of that size, by ``spread``, a column of ``left`` that differs
    from row to row; its row of ``right`` is repeated once for each piece. The list of such keys is
    shorter than a thousand whatever the input, so it is broadcast. ``total`` is the number of rows of
    ``left``, if that is known; otherwise the weights are summed.
    """
    if total is None:
        total = right.agg(F.sum(weight)).first()[0] or 0
    pieces = F.ceil(F.col(weight) * HEAVY_SHARE / F.lit(max(total, 1))).cast("int")
    cut = right.withColumn("_pieces", F.greatest(pieces, F.lit(1)))
    heavy = cut.filter("_pieces > 1").select(F.col(on).alias("_key"), F.col("_pieces").alias("_of"))
    salt = F.when(F.col("_of").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("_of"))).cast("int")
    salted = left.join(F.broadcast(heavy), F.col(on) == F.col("_key"), "left").withColumn("_salt", salt).drop("_key", "_of")
    copies = cut.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
    return salted.join(copies, [on, "_salt"]).drop("_salt")


def split_join(left: DataFrame, right: DataFrame, on: str, weight: str, spread: Column, total: int, counts: DataFrame | None = None) -> DataFrame:
    """As ``spread_join``, where most often no key holds a large part of ``left``.

    The keys above a thousandth of ``total``, hence fewer than a thousand, are looked up first, and
    cut by an expression that lists them. ``counts`` is a cheaper frame with the key and weight of ``right``.
    """
    if total <= FEW:
        return left.join(right, on)
    share = F.ceil(F.col(weight) * HEAVY_SHARE / F.lit(max(total, 1))).cast("int")
    known = (right if counts is None else counts).select(F.xxhash64(on).alias("_hash"), share.alias("_of")).filter("_of > 1")
    heavy = {x["_hash"]: x["_of"] for x in known.collect()}
    if not heavy:
        return left.join(right, on)
    # both sides find the pieces by the same digest, so a colliding key is cut alike
    of = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])[F.xxhash64(on)]
    pieces = F.when(F.xxhash64(on).isin(list(heavy)), of).otherwise(1)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), pieces).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return salted.join(copies, [on, "_salt"]).drop("_salt")


def ship_package(spark: SparkSession) -> None:
    """Workers find this package in its folder; a cluster may also ship it."""
    folder = str(Path(millrace.__file__).resolve().parent.parent)
    variables = spark.sparkContext.environment
    known = variables.get("PYTHONPATH", "").split(":")
    if folder not in known:
        variables["PYTHONPATH"] = ":".join([*filter(None, known), folder])


def map_arrow(frame: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def strings(column: pa.Array) -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
