"""Removes lines or paragraphs that occur elsewhere already.

Units are normalised and hashed, equal digests are grouped over the whole table, the occurrence that ranks
first stays, and all others are removed. Each removed unit is reported with its offsets in the text as it
came, so a caller can cut it out or just mark it. Texts are read once; what is shuffled is a digest and a
position for each unit, and a unit that stands in a third of all documents is cut into pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import from_row, in_slices, map_arrow, spread_join, stored, strings, whole_row

#: Units of fewer words are left alone: only those without a letter or digit.
LEAST_WORDS = 1

_MARKS = re.compile(r"[\W_]+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
UNITS = "doc_id long, unit int, start_char long, end_char long, n_words int, digest binary, text_digest string"


def normalised(unit: str) -> str:
    """Lower case, with one blank for each run of anything but letters and digits."""
    return _MARKS.sub(" ", unit.lower()).strip()


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def _paragraphs(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for gap in _PARAGRAPH.finditer(text):
        yield at, text[at : gap.start()]
        at = gap.end()
    yield at, text[at:]


def _units(by: str, least_words: int):
    cut = {"line": _lines, "paragraph": _paragraphs}[by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            out: list[list] = [[] for _ in range(7)]
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                whole = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()
                for number, (at, unit) in enumerate(cut(text)):
                    norm = normalised(unit)
                    words = norm.count(" ") + 1
                    if norm and words >= least_words:
                        row = (doc, number, at, at + len(unit), words, xxhash.xxh3_128_digest(norm.encode("utf-8", "surrogatepass")), whole)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string())
            arrays = [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in UNITS.split(", ")])

    return run


def repeated_units(docs: DataFrame, by: str = "line", least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit to remove: doc_id, unit, start_char, end_char, n_words, keep_doc_id, keep_unit, n_copies, text_digest.

    ``by`` is "line" or "paragraph"; offsets count code points from 0, the end is not included. The unit
    that stays is the one with the smallest id, then the smallest number; a null id ranks last. Null and
    empty texts have no units, and neither has a unit without letters or digits. Where different texts share
    an id and a number, the unit that starts first stays, then the one of the smallest text digest. Of rows
    repeated with id and text, one place stands for all: none of them removes the place that stays. An empty
    table gives no rows, and other columns aren't read. ``doc_id`` must be an integer column. Digests have 128 bits.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    units = stored(map_arrow(rows, _units(by, least_words), UNITS), "units")
    place = [F.col(x).alias(y) for x, y in (("doc_id", "_doc"), ("unit", "_unit"), ("start_char", "_start"), ("text_digest", "_text"))]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_late"), *place))
    groups = units.groupBy("digest").agg(F.count("*").alias("n_copies"), first.alias("_first")).filter("n_copies > 1")
    spread = F.struct("doc_id", "unit")
    found = spread_join(units, stored(groups, "repeated"), "digest", "n_copies", spread)
    stays = F.col("doc_id").eqNullSafe(F.col("_first._doc")) & (F.col("unit") == F.col("_first._unit")) & (F.col("text_digest") == F.col("_first._text"))
    return found.filter(~stays).select(
        "doc_id",
        "unit",
        "start_char",
        "end_char",
        "n_words",
        F.col("_first._doc").alias("keep_doc_id"),
        F.col("_first._unit").alias("keep_unit"),
        "n_copies",
        "text_digest",
    )


def without_units(docs: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the reported units cut out of their texts; the rest stays character by character.

    A report holds for the rows with its id **and** text, so rows that share an id, or have none, keep what
    was reported of others. Rows without a report, null texts among them, stay as they are, and so do all
    if nothing is reported. Columns of any name pass through. An empty table gives no rows.
    """
    key = ("_id", "_digest")
    spans = removed.select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest"), F.struct("start_char", "end_char").alias("_span"))
    spans = spans.groupBy(*key).agg(F.sort_array(F.collect_set("_span")).alias("_spans"))
    rows = docs.select(whole_row(docs).alias("_row"), F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"))
    ends = F.concat(F.transform("_spans", lambda x: x["start_char"]), F.array(F.length("_text").cast("long")))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("_spans", lambda x: x["end_char"]))
    parts = F.zip_with(begins, ends, lambda a, b: F.substr(F.col("_text"), (a + 1).cast("int"), (b - a).cast("int")))
    left = F.when(F.col("_spans").isNull() | F.col("_text").isNull(), F.col("_text")).otherwise(F.array_join(parts, ""))
    joined = rows.join(spans, F.col("_doc").eqNullSafe(F.col("_id")) & (F.md5(F.encode("_text", "UTF-8")) == F.col("_digest")), "left")
    columns = zip(docs.columns, from_row(docs), strict=True)
    return joined.select(*[left.alias(name) if name == text else column for name, column in columns])
