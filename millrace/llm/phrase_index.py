"""Finds passages of a benchmark in documents by a positional inverted index.

Documents are read once. Every few thousand words make a block, and a block is one row of the index: its
terms, and for each term the places where it stands, as a search engine keeps them. Terms are 64-bit
digests of words. A benchmark is cut into windows of a few words. In each block a window is looked up by
its rarest term there; the places of that term, moved back by the term's place in the window, are
intersected with the moved places of the next rarest one, and so on. What is left are the exact phrases.
The same lists give proximity matches, where the words of a window stand close together in any order.

The index doesn't depend on the benchmark and is written to shared storage. A block is a small bounded
piece of the table, however frequent a word is; a block is only larger if one document is. The benchmark
goes to the tasks in parts of a fixed number of windows, one part after the other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import map_arrow
from millrace.session import scratch_path

#: Words of a window.
WINDOW = 10
#: Bytes of text after which a block ends.
BLOCK_BYTES = 1 << 20
#: Pairs of window and item that are sent to the tasks at once, some 90 bytes each.
PART = 1 << 17

INDEX = "block long, doc_ids array<long>, firsts binary, terms binary, counts binary, places binary"
FOUND = "block long, nth int, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
PLACES = "block long, nth int, doc_id long, item_id string, item_word int, start long, end long"

_WORD_BYTE = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD_BYTE[_low : _high + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MIXED = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    """Digests of all words of some texts in order, and at which of them each text begins, and the end."""

    digests: np.ndarray
    firsts: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """Words are runs of ASCII letters in lower case, digits, and characters beyond ASCII; null has none."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if not len(raw):
        return Words(np.zeros(0, np.uint64), np.zeros(len(at), np.int64))
    inside = _WORD_BYTE[raw]
    fresh = np.zeros(len(raw), dtype=bool)
    fresh[at[:-1][at[:-1] < len(raw)]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:]
    starts = np.flatnonzero(begins)
    firsts = np.searchsorted(starts, at)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), firsts)
    letters = _LOWER[raw[inside]]
    heads = np.cumsum(inside)[starts] - 1
    lengths = np.diff(np.append(heads, len(letters)))
    power = np.multiply.accumulate(np.full(int(lengths.max()), _STEP))
    nth = np.arange(len(letters)) - np.repeat(heads, lengths)
    digests = np.add.reduceat(_MIXED[letters] * power[nth], heads)
    digests ^= digests >> np.uint64(32)
    return Words(digests * _SPREAD, firsts)


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in INDEX.split(", ")]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // size
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            for start, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                rows = batch.slice(start, end - start)
                words = words_of(rows.column(1))
                order = np.argsort(words.digests, kind="stable")
                ordered = words.digests[order]
                heads = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] ^ np.uint64(1))) if len(ordered) else np.zeros(0, np.int64)
                counts = np.diff(np.append(heads, len(ordered)))
                steps = np.diff(order, prepend=0)
                steps[heads] = order[heads]  # the first place of a term, then the distance from one to the next
                binary = [x.tobytes() for x in (words.firsts.astype("<u4"), ordered[heads].astype("<u8"), counts.astype("<u4"), steps.astype("<u4"))]
                ids = pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), ids, *[pa.array([x], pa.binary()) for x in binary]], names)
                number += 1

    return run


def write_index(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> None:
    """Writes the postings of all words of ``docs`` to ``path``, one row per block.

    A null or repeated id is a document like any other, a null or empty text has no words, and other columns
    aren't read. ``doc_id`` must be an integer column.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    map_arrow(rows, _blocks(block_bytes), INDEX).write.option("compression", "zstd").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


class _Block:
    """One row of the index, unpacked."""

    def __init__(self, row: dict):
        self.number, self.doc_ids = row["block"], row["doc_ids"]
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.steps = np.frombuffer(row["places"], "<u4")
        self.heads = np.cumsum(self.counts) - self.counts

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each of ``terms`` stands here, and all their places as ``term number << 32 | place``."""
        counts = np.zeros(len(terms), np.int64)
        if not len(self.terms):
            return counts, np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == terms)
        counts[known] = self.counts[at[known]]
        number = np.repeat(known, counts[known])
        starts = np.cumsum(counts[known]) - counts[known]
        inner = np.arange(len(number)) - np.repeat(starts, counts[known])
        steps = self.steps[np.repeat(self.heads[at[known]], counts[known]) + inner].astype(np.int64)
        # places are running sums of the steps within each term
        total = np.cumsum(steps)
        before = np.repeat(total[starts] - steps[starts], counts[known]) if len(starts) else total
        return counts, (number << 32) | (total - before)


class Part:
    """A bounded part of a benchmark: its terms, its windows by length, and the items they belong to."""

    def __init__(self, rows: list):
        self.items = sorted({r.item_id for r in rows})
        number = {x: i for i, x in enumerate(self.items)}
        owners = defaultdict(list)
        for r in rows:
            owners[bytes(r.terms)].append((number[r.item_id], r.item_word))
        self.terms = np.unique(np.frombuffer(b"".join(owners), "<u8"))
        keys = defaultdict(list)
        for key in owners:
            keys[len(key) // 8].append(key)
        #: For each length the windows as numbers of terms, and for each window the items and where in them.
        self.windows = {n: np.searchsorted(self.terms, np.frombuffer(b"".join(k), "<u8").reshape(-1, n)) for n, k in keys.items()}
        self.owners = {n: [owners[x] for x in k] for n, k in keys.items()}


def _from_rarest(windows: np.ndarray, counts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, order of its terms from the rarest, place of that term) of windows all of whose terms are here."""
    held = counts[windows]
    alive = np.flatnonzero(held.min(axis=1) > 0)
    order = np.argsort(held[alive], axis=1, kind="stable")
    first = windows[alive, order[:, 0]]
    n = counts[first]
    begin = np.searchsorted(places, first.astype(np.int64) << 32)
    which = np.repeat(np.arange(len(alive)), n)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return alive, order, which, places[begin[which] + inner] & 0xFFFFFFFF


def _document(block: _Block, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The document of each stretch of words, and whether the stretch lies within it."""
    doc = np.searchsorted(block.firsts, start, side="right") - 1
    doc = np.clip(doc, 0, len(block.firsts) - 2)
    return doc, (start >= 0) & (end <= block.firsts[doc + 1])


def _phrases(block: _Block, part: Part) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of window: length, windows found, documents, places of their first words."""
    counts, places = block.lists(part.terms)
    for n, windows in part.windows.items():
        alive, order, which, at = _from_rarest(windows, counts, places)
        start = at - order[which, 0] if len(which) else at
        for k in range(1, n):
            if not len(which):
                break
            offset = order[which, k]
            wanted = (windows[alive[which], offset].astype(np.int64) << 32) | (start + offset)
            there = (places[np.minimum(np.searchsorted(places, wanted), len(places) - 1)] == wanted) & (start >= 0)
            which, start = which[there], start[there]
        if len(which):
            doc, inside = _document(block, start, start + n)
            yield n, alive[which[inside]], doc[inside], start[inside]


def _close(block: _Block, part: Part, slop: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(length, window, document, start, end) of the shortest stretch around each place of a rarest term."""
    counts, places = block.lists(part.terms)
    for n, windows in part.windows.items():
        alive, _, which, at = _from_rarest(windows, counts, places)
        most = n + slop
        for k in range(n):  # every term must stand near enough
            if not len(which):
                break
            term = windows[alive[which], k].astype(np.int64) << 32
            near = np.searchsorted(places, term | np.maximum(at - most + 1, 0)) < np.searchsorted(places, term | (at + most))
            which, at = which[near], at[near]
        for w, place in zip(which.tolist(), at.tolist(), strict=True):
            doc = int(np.searchsorted(block.firsts, place, side="right")) - 1
            low, high = max(place - most + 1, int(block.firsts[doc])), min(place + most, int(block.firsts[doc + 1]))
            terms = np.unique(windows[alive[w]]).astype(np.int64) << 32
            around = [places[np.searchsorted(places, t | low) : np.searchsorted(places, t | high)] & 0xFFFFFFFF for t in terms]
            stretch = _shortest([x.tolist() for x in around], place)
            if stretch and stretch[1] - stretch[0] <= most:
                yield n, int(alive[w]), doc, *stretch


def _shortest(lists: list[list[int]], place: int) -> tuple[int, int] | None:
    """The shortest stretch, then the first, that holds ``place`` and one place of every list."""
    best = None
    for low in sorted({p for x in lists for p in x if p <= place}):
        ends = [next((p for p in x if p >= low), None) for x in lists]
        if None in ends:
            break
        high = max(place, *ends) + 1
        if best is None or high - low < best[1] - best[0]:
            best = (low, high)
    return best


def _marking(part):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = part.value
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                hit = np.zeros(int(block.firsts[-1]) + 1, np.int32)
                pairs = [np.zeros((0, 2), np.int64)]
                for n, windows, docs, starts in _phrases(block, wanted):
                    np.add.at(hit, starts, 1)
                    np.add.at(hit, starts + n, -1)
                    seen = np.unique(np.stack([docs, windows], axis=1), axis=0)
                    owners = wanted.owners[n]
                    pairs.append(np.array([(d, i) for d, w in seen.tolist() for i, _ in owners[w]], np.int64).reshape(-1, 2))
                inside = np.cumsum(hit)[:-1] > 0
                edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
                spans, items = defaultdict(list), defaultdict(list)
                for start, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
                    for doc in range(int(np.searchsorted(block.firsts, start, side="right")) - 1, len(block.doc_ids)):
                        base, stop = int(block.firsts[doc]), int(block.firsts[doc + 1])
                        if base >= end:
                            break
                        if stop > base:  # adjoining hits of two documents are one stretch of the block
                            spans[doc].append({"start": int(max(start, base)) - base, "end": int(min(end, stop)) - base})
                for doc, item in np.unique(np.concatenate(pairs), axis=0).tolist():
                    items[doc].append(wanted.items[item])
                n_docs = len(block.doc_ids)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()))
                columns = (
                    [block.number] * n_docs,
                    range(n_docs),
                    block.doc_ids,
                    np.diff(block.firsts).tolist(),
                    [spans.get(d, []) for d in range(n_docs)],
                    [items.get(d, []) for d in range(n_docs)],
                )
                arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "nth", "doc_id", "n_words", "spans", "items"])

    return run


def _placing(part, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = part.value
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                if slop is None:
                    found = (x for n, ws, ds, ss in _phrases(block, wanted) for x in zip([n] * len(ws), ws.tolist(), ds.tolist(), ss.tolist(), (ss + n).tolist()))
                else:
                    found = sorted(set(_close(block, wanted, slop)))
                out = []
                for n, window, doc, start, end in found:
                    base = int(block.firsts[doc])
                    for item, word in wanted.owners[n][window]:
                        out.append((block.number, doc, block.doc_ids[doc], wanted.items[item], word, start - base, end - base))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                arrays = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in PLACES.split(", ")])

    return run


def windows_of(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, item_word, terms) of all windows; an item of fewer words, but not none, is one window.

    A null item id is written as an empty one, and of windows that an item repeats the first place counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column(1))
            ids, places, terms = [], [], []
            for item, start, end in zip(batch.column(0).to_pylist(), words.firsts[:-1].tolist(), words.firsts[1:].tolist(), strict=True):
                for at in range(start, max(end - window, start) + 1 if end > start else start):
                    ids.append(item)
                    places.append(at - start)
                    terms.append(words.digests[at : min(at + window, end)].astype("<u8").tobytes())
            arrays = [pa.array(ids, pa.string()), pa.array(places, pa.int32()), pa.array(terms, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["item_id", "item_word", "terms"])

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(text).cast("string").alias("text"))
    found = map_arrow(rows, run, "item_id string, item_word int, terms binary")
    return found.groupBy("item_id", "terms").agg(F.min("item_word").alias("item_word"))


def _parts(windows: DataFrame, size: int) -> Iterator[Part]:
    """Parts of a fixed size; one is with the driver at a time."""
    rows = windows.toLocalIterator()
    while part := list(islice(rows, size)):
        yield Part(part)


def _merged(spans: Column) -> Column:
    """Spans of several parts as spans that don't touch."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def marked(index: DataFrame, windows: DataFrame, part: int = PART) -> DataFrame:
    """One row per document of the index: block, nth, doc_id, n_words, spans, items.

    ``spans`` are the stretches of words, counted from 0 without the end, in which a window stands word for
    word, ``items`` the ids, sorted, of the items whose windows these are. Documents without any have empty
    arrays, and so have all if the benchmark has no words; an empty index gives no rows. Windows don't run
    from one document into the next. ``part`` bounds what is broadcast; more parts change no result.
    """
    spark = index.sparkSession
    found, parts = None, 0
    for held in _parts(windows, part):
        one = map_arrow(index, _marking(spark.sparkContext.broadcast(held)), FOUND)
        found, parts = (one if found is None else found.unionByName(one)), parts + 1
    if found is None:
        found = map_arrow(index, _marking(spark.sparkContext.broadcast(Part([]))), FOUND)
    if parts > 1:
        together = [F.first(x).alias(x) for x in ("doc_id", "n_words")] + [F.flatten(F.collect_list(x)).alias(x) for x in ("spans", "items")]
        found = found.groupBy("block", "nth").agg(*together).withColumn("spans", _merged(F.col("spans")))
    return found.select("block", "nth", "doc_id", "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"))


def matches(index: DataFrame, windows: DataFrame, slop: int | None = None, part: int = PART) -> DataFrame:
    """One row per match of a window: block, nth, doc_id, item_id, item_word, start, end.

    Without ``slop`` the words of the window stand at ``start`` in their order. With it they stand in any
    order within as many words as the window has and ``slop`` more; each place of the window's rarest word
    gives the shortest such stretch around it. A word that the window repeats may then stand once.
    """
    spark = index.sparkSession
    found = spark.createDataFrame([], PLACES)
    for held in _parts(windows, part):
        found = found.unionByName(map_arrow(index, _placing(spark.sparkContext.broadcast(held), slop), PLACES))
    return found.dropDuplicates()


def index_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of ``docs`` in the folder that all executors share."""
    path = scratch_path(docs.sparkSession, "phrase-index")
    write_index(docs, path, block_bytes=block_bytes)
    return read_index(docs.sparkSession, path)
