"""Exact duplicates by sorting the contents.

Sampled splitters deal the texts out by range and each task sorts its range externally, so equal texts lie
next to each other; one pass compares neighbours in full. The sort key starts with a short prefix and a
digest, which keeps the sample small and most comparisons short, and ends with the id, so a text that a
third of all rows share is spread over as many tasks as it fills. A run that touches the edge of a range
may go on in the next one: such runs, two for each range at most, are put together by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import from_row, map_arrow, stored, whole_row

#: Characters of a text in the range splitters.
PREFIX = 24

RUNS = "doc_id long, text_sha256 string, _keep long, _size long, _head boolean, _edge boolean"


def _sorted_by_content(rows: DataFrame, text: Column) -> DataFrame:
    """Rows with ``_id``, dealt out by range of a text and sorted, with ``_text`` and its digest at the end.

    Of equal texts the largest id comes first, null last. The text is worked out again after the shuffle,
    so that rows that hold it already don't carry it twice.
    """
    keyed = rows.withColumns({"_prefix": F.left(text, F.lit(PREFIX)), "_hash": F.xxhash64(text)})
    largest = F.col("_id").desc_nulls_last()
    dealt = keyed.repartitionByRange("_prefix", "_hash", largest).sortWithinPartitions("_prefix", "_hash", text, largest)
    return dealt.drop("_prefix", "_hash").withColumns({"_text": text, "_sha": F.sha2(F.encode(text, "UTF-8"), 256)})


def _starts(texts: pa.Array, last: str | None) -> np.ndarray:
    """True where a text differs from the one before it."""
    new = np.ones(len(texts), dtype=bool)
    new[0] = last is None or texts[0].as_py() != last
    if len(texts) > 1:
        new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
    return new


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (doc_id, text, digest) to rows that know their run's first id and size."""
    names = [x.split()[0] for x in RUNS.split(", ")]

    def rows(ids: pa.Array, shas: pa.Array, lengths: np.ndarray, edge: bool) -> pa.RecordBatch:
        """Rows of complete runs, of so many rows each."""
        heads = np.cumsum(lengths) - lengths
        run = np.repeat(np.arange(len(lengths)), lengths)
        first = np.zeros(len(ids), dtype=bool)
        first[heads] = True
        keep = ids.take(pa.array(heads)).take(pa.array(run))
        arrays = [ids, shas, keep, pa.array(lengths[run], pa.int64()), pa.array(first), pa.array(np.full(len(ids), edge))]
        return pa.RecordBatch.from_arrays(arrays, names)

    last, sha, held, first_run = None, None, [], True

    def close(edge: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(held)
        return rows(ids, pa.array([sha] * len(ids), pa.string()), np.array([len(ids)]), edge)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts, shas = (batch.column(i) for i in range(3))
        starts = np.flatnonzero(_starts(texts, last))
        if not starts.size:
            held.append(ids)
        else:
            if held or starts[0]:
                held.append(ids[: starts[0]])
            if held:
                yield close(first_run)
                first_run = False
            if starts.size > 1:
                inner = ids[starts[0] : starts[-1]]
                lengths = np.diff(starts)
                shas_inner = shas[starts[0] : starts[-1]]
                if first_run:
                    n = int(lengths[0])
                    yield rows(inner[:n], shas_inner[:n], lengths[:1], True)
                    inner, shas_inner, lengths, first_run = inner[n:], shas_inner[n:], lengths[1:], False
                if len(lengths):
                    yield rows(inner, shas_inner, lengths, False)
            held, sha = [ids[starts[-1] :]], shas[int(starts[-1])].as_py()
        last = texts[len(texts) - 1].as_py()
    if held:
        yield close(True)


def exact_groups(docs: DataFrame, normalise: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when ``normalise``, by default the text unchanged with null as empty, gives the same
    bytes. The row with the largest id of a group stays; a null id comes after all others, and of repeated
    rows with the same id and text one stays. An empty table gives no rows, other columns aren't read.
    ``doc_id`` must be an integer column.
    """
    whole = F.coalesce((F.col(text) if normalise is None else normalise).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), whole.alias("_whole"))
    ordered = _sorted_by_content(rows, F.col("_whole")).select("_id", "_text", "_sha")
    runs = stored(map_arrow(ordered, _runs, RUNS), "runs")
    edges = runs.filter("_edge").groupBy(F.col("text_sha256").alias("_of")).agg(F.max("doc_id").alias("_most"), F.count("*").alias("_all"))
    # two runs for each range at most
    joined = runs.join(F.broadcast(edges), F.col("_edge") & (F.col("text_sha256") == F.col("_of")), "left")
    keep = F.when(F.col("_edge"), F.col("_most")).otherwise(F.col("_keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.when(F.col("_edge"), F.col("_all")).otherwise(F.col("_size")).alias("group_size"),
        (F.col("_head") & F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, with ``_text`` and ``_sha`` last, to the first row of each run and whether the run is at an edge."""
    last, held, first_run = None, None, True

    def marked(batch: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
        columns = [x for i, x in enumerate(batch.columns) if batch.schema.names[i] != "_text"]
        names = [x for x in batch.schema.names if x != "_text"]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(batch.num_rows, edge))], [*names, "_edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.num_columns - 2)
        starts = np.flatnonzero(_starts(texts, last))
        last = texts[len(texts) - 1].as_py()
        if not starts.size:
            continue
        if held is not None:
            yield marked(held, first_run)
            first_run = False
        found = batch.take(pa.array(starts))
        if found.num_rows > 1:
            if first_run:
                yield marked(found.slice(0, 1), True)
                found, first_run = found.slice(1), False
            if found.num_rows > 1:
                yield marked(found.slice(0, found.num_rows - 1), False)
        held = found.slice(found.num_rows - 1)
    if held is not None:
        yield marked(held, True)


def without_copies(docs: DataFrame, normalise: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; which those are, ``exact_groups`` says."""
    rows = docs.select(whole_row(docs).alias("_row"), F.col(doc_id).cast("long").alias("_id"))
    if normalise is None:
        whole = F.col("_row")[text].cast("string")
    else:
        rows = docs.select(whole_row(docs).alias("_row"), F.col(doc_id).cast("long").alias("_id"), normalise.cast("string").alias("_normal"))
        whole = F.col("_normal")
    ordered = _sorted_by_content(rows, F.coalesce(whole, F.lit(""))).select("_row", "_id", "_text", "_sha")
    schema = ordered.drop("_text").withColumn("_edge", F.lit(True)).schema
    heads = stored(map_arrow(ordered, _heads, schema), "heads")
    edges = heads.filter("_edge").groupBy(F.col("_sha").alias("_of")).agg(F.max("_id").alias("_most"))
    joined = heads.join(F.broadcast(edges), F.col("_edge") & (F.col("_sha") == F.col("_of")), "left")
    return joined.filter(~F.col("_edge") | F.col("_id").eqNullSafe(F.col("_most"))).select(*from_row(docs))
