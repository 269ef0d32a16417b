"""Token ids as blocks of a static range asymmetric numeral system.

One frequency table, counted over all documents, is shared by every block, so blocks don't depend on each
other. In a block the ids are dealt in turn to many lanes, each a state of its own, and all lanes write to
one stream of 32-bit words; a step of all lanes is a handful of array operations. At every so many steps
the states and the place in the stream are kept as a checkpoint from which decoding can start.

A file holds blocks as rows: ``part`` and ``first`` order them, ``before`` are the ids that stand before the
block in its part, and ``payload`` is::

    magic, sizes       "RNB1", then documents, ids, lanes, checkpoints, words (uint64 each), table's CRC-32 (uint32)
    documents          for each its id (int64), whether it has one (uint8), its number of ids (uint64)
    checkpoints        for each its step, its word (uint64 each), the state of each lane (uint64)
    words              uint32
    CRC-32             of all that (uint32)

All numbers are little-endian. The frequency table is a file of its own beside the blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shared import in_slices, map_arrow, strings
from millrace.llm.tokens import encoder
from millrace.session import discard, scratch_path

MAGIC = b"RNB1"
HEAD = struct.Struct("<4s5QI")
#: Words that a worker remembers when it encodes; it does nothing else beside that.
REMEMBERED = 1_000_000
#: Bits of a frequency: all of them add up to one less than this power of two.
BITS = 20
LANES = 1024
#: Ids after which a block is closed; documents aren't split.
BLOCK = 1 << 20
#: Steps between checkpoints.
SPAN = 256

_LOW = np.uint64(1 << 32)
_HALF = np.uint64(32)
IDS = "part int, row long, before long, doc_id long, n_tokens long, ids binary"
BLOCKS = "part int, first long, before long, n_docs long, n_tokens long, payload binary"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Damaged(ValueError):
    """A block whose checksum, table or shape doesn't fit."""


@dataclass(frozen=True)
class Table:
    """Frequencies of the ids that occur, ascending by id; together 2 ** BITS - 1."""

    ids: np.ndarray
    frequencies: np.ndarray

    @staticmethod
    def of(counts: dict[int, int]) -> Table:
        """Scales counts so that each is 1 at least; what rounding leaves goes to the largest."""
        ids = np.array(sorted(counts), dtype=np.int64)
        n = np.array([counts[i] for i in ids.tolist()], dtype=np.float64)
        room = (1 << BITS) - 1 - len(ids)
        if room < 0:
            raise ValueError(f"more than {(1 << BITS) - 1} different ids")
        scaled = 1 + np.floor(n / n.sum() * room).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        if len(ids):
            scaled[int(n.argmax())] += (1 << BITS) - 1 - int(scaled.sum())
        return Table(ids, scaled.astype(np.uint64))

    @cached_property
    def starts(self) -> np.ndarray:
        return (np.cumsum(self.frequencies) - self.frequencies).astype(np.uint64)

    @cached_property
    def owners(self) -> np.ndarray:
        """Which entry each slot of the range belongs to."""
        return np.repeat(np.arange(len(self.ids), dtype=np.int32), self.frequencies.astype(np.int64))

    @cached_property
    def entry(self) -> np.ndarray:
        """The entry of each id."""
        at = np.full(int(self.ids[-1]) + 1 if len(self.ids) else 0, -1, dtype=np.int32)
        at[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        return at

    @cached_property
    def crc(self) -> int:
        return zlib.crc32(self.frequencies.astype("<u8").tobytes(), zlib.crc32(self.ids.astype("<i8").tobytes()))


def encode_block(table: Table, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, lanes: int = LANES, span: int = SPAN) -> bytes:
    """The payload of documents whose ids stand one after the other in ``ids``."""
    entries = table.entry[ids]
    steps = -(-len(ids) // lanes)
    states = np.full(lanes, _LOW, dtype=np.uint64)
    written: list[np.ndarray] = []
    n_written, marks = 0, []
    shift, low = np.uint64(64 - BITS), np.uint64(0xFFFFFFFF)
    for step in range(steps - 1, -1, -1):
        at = entries[step * lanes : (step + 1) * lanes]
        x = states[: len(at)]
        f = table.frequencies[at]
        full = x >= (f << shift)
        if full.any():
            written.append((x[full] & low).astype("<u4"))
            n_written += len(written[-1])
            x[full] >>= _HALF
        whole, rest = np.divmod(x, f)
        x[:] = (whole << np.uint64(BITS)) + rest + table.starts[at]
        if step % span == 0:
            marks.append((step, n_written, states.astype("<u8").tobytes()))
    words = np.concatenate(written[::-1]).tobytes() if written else b""
    known = np.array([x is not None for x in doc_ids], dtype="u1")
    parts = [
        HEAD.pack(MAGIC, len(doc_ids), len(ids), lanes, len(marks), n_written, table.crc),
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
        known.tobytes(),
        np.array(lengths, dtype="<u8").tobytes(),
        *[struct.pack("<2Q", step, n_written - behind) + kept for step, behind, kept in reversed(marks)],
        words,
    ]
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


@dataclass(frozen=True)
class Block:
    """A payload taken apart; nothing is decoded yet."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    n_ids: int
    lanes: int
    marks: list[tuple[int, int, np.ndarray]]
    words: np.ndarray

    @staticmethod
    def of(payload: bytes, table: Table) -> Block:
        if len(payload) < HEAD.size + 4 or payload[:4] != MAGIC:
            raise Damaged("not a block")
        if zlib.crc32(memoryview(payload)[:-4]) != struct.unpack("<I", payload[-4:])[0]:
            raise Damaged("checksum differs")
        _, n_docs, n_ids, lanes, n_marks, n_words, crc = HEAD.unpack_from(payload)
        if crc != table.crc:
            raise Damaged("made with another frequency table")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, n, at)
            at += found.nbytes
            return found

        numbers, known, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
        marks = []
        for _ in range(n_marks):
            step, word = take("<u8", 2).tolist()
            marks.append((step, word, take("<u8", lanes)))
        doc_ids = [x if k else None for x, k in zip(numbers.tolist(), known.tolist(), strict=True)]
        return Block(doc_ids, lengths.astype(np.int64), n_ids, lanes, marks, take("<u4", n_words))

    def decode_span(self, table: Table, mark: int) -> np.ndarray:
        """The ids from one checkpoint up to the next; needs no other part of the stream."""
        first, word, kept = self.marks[mark]
        last = self.marks[mark + 1][0] if mark + 1 < len(self.marks) else -(-self.n_ids // self.lanes)
        states = kept.astype(np.uint64)
        out = np.empty(min(last * self.lanes, self.n_ids) - first * self.lanes, dtype=np.int64)
        slots, done = np.uint64((1 << BITS) - 1), 0
        for step in range(first, last):
            n = min(self.lanes, self.n_ids - step * self.lanes)
            x = states[:n]
            slot = x & slots
            at = table.owners[slot.astype(np.int64)]
            out[done : done + n] = at
            done += n
            x[:] = table.frequencies[at] * (x >> np.uint64(BITS)) + slot - table.starts[at]
            low = x < _LOW
            n_low = int(np.count_nonzero(low))
            if n_low:
                x[low] = (x[low] << _HALF) | self.words[word : word + n_low].astype(np.uint64)
                word += n_low
        return table.ids[out]

    def decode(self, table: Table) -> np.ndarray:
        spans = [self.decode_span(table, i) for i in range(len(self.marks))]
        return np.concatenate(spans) if spans else np.zeros(0, np.int64)


def _batch(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _tokenised(path: str, end_id: int):
    """Ordered documents to their ids, with places in their part."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, row, before = encoder(path, REMEMBERED), TaskContext.get().partitionId(), 0, 0
        narrow = max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        for batch in in_slices(batches):
            out: list[list] = [[] for _ in range(6)]
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                ids = coder.encode(text) + end
                n = len(ids) // 4
                kept = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if narrow else ids
                for column, value in zip(out, (part, row, before, doc, n, kept), strict=True):
                    column.append(value)
                row, before = row + 1, before + n
            yield _batch(IDS, out)

    return run


def _numbers(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each id occurs, once for each task."""
    counts = np.zeros(0, dtype=np.int64)
    for batch in in_slices(batches):
        ids = [_numbers(x, n) for x, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        found = np.bincount(np.concatenate(ids), minlength=len(counts))
        found[: len(counts)] += counts
        counts = found
    used = np.flatnonzero(counts)
    yield _batch("id long, n long", [used, counts[used]])


def _encoded(table: Table, lanes: int, block: int):
    """Runs of documents that follow each other to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple] = []
        held, follows = 0, None

        def close() -> pa.RecordBatch:
            part, first, before = docs[0][:3]
            ids = np.concatenate([_numbers(x[5], x[4]) for x in docs])
            payload = encode_block(table, [x[3] for x in docs], [x[4] for x in docs], ids, lanes)
            return _batch(BLOCKS, [[part], [first], [before], [len(docs)], [len(ids)], [payload]])

        for batch in in_slices(batches):
            for doc in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if docs and (held >= block or doc[:2] != follows):
                    yield close()
                    docs, held = [], 0
                docs.append(doc)
                held, follows = held + doc[4], (doc[0], doc[1] + 1)
        if docs:
            yield close()

    return run


def _decoded(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            payload, start = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            block = Block.of(payload, table)
            ids = block.decode(table).astype("<u4")
            ends = np.cumsum(block.lengths)
            crcs = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), block.lengths.tolist(), strict=True)]
            yield _batch(ROWS, [block.doc_ids, start + ends - block.lengths, block.lengths, crcs])

    return run


def write_ids(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int = 2,
    lanes: int = LANES,
    block: int = BLOCK,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Writes the token ids of all documents below ``path``, ascending by id: ``table`` and ``blocks``.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. A null id comes after
    all others; rows with the same id are ordered by a digest of their text. An empty table gives files
    without a block. Other columns aren't read; ``doc_id`` must be an integer column.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    scratch = scratch_path(spark, "ids")
    map_arrow(ordered, _tokenised(tokenizer, end_id), IDS).write.option("compression", "zstd").parquet(scratch)
    ids = spark.read.schema(IDS).parquet(scratch)
    counts = map_arrow(ids.select("ids", "n_tokens"), _counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    table = Table.of({r["id"]: r["n"] for r in counts.collect()})  # one row for each id of the vocabulary
    pairs = list(zip(table.ids.tolist(), table.frequencies.tolist(), strict=True))
    spark.createDataFrame(pairs, "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    blocks = map_arrow(ids, _encoded(table, lanes, block), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    discard(spark, scratch)


def read_table(spark: SparkSession, path: str) -> Table:
    rows = sorted(map(tuple, spark.read.parquet(f"{path}/table").collect()))
    return Table(np.array([x for x, _ in rows], np.int64), np.array([x for _, x in rows], np.uint64))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before. Each block is decoded by itself; only one number for
    each part is gathered to place it. A damaged block raises.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = sums.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = blocks.join(F.broadcast(parts), F.col("part") == F.col("_part"))  # one row for each written file
    return map_arrow(placed.select("payload", (F.col("_base") + F.col("before")).alias("start")), _decoded(read_table(spark, path)), ROWS)
