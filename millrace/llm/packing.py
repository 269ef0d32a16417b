"""Best-fit packing of token pieces into sequences of a fixed length.

A configuration is a multiset of piece lengths that fits one sequence. Which configurations to use, and
how often, is a linear program over the histogram of lengths: cover every length's count with as few
sequences as can be. It is solved by multiplicative weights, in whole uses. Each length has a price; a
knapsack dynamic program finds the configuration worth most at these prices, it is used for a small share
of the counts, and the prices of what it covers fall. After ``ROUNDS`` of these a configuration is used
until one of its lengths has run out, so that the rounds end. A length leaves the program when fewer of its
pieces are left than the configuration has; so what is left over is less than one sequence full of each
length, however many pieces there are. It is put into the fullest sequence in which it fits, the longest first.

The program sees the histogram alone, at most ``capacity`` counts whatever the input, so it runs on the
driver. Documents are only numbered within their length, by two small shuffles of narrow rows without a
text, and each looks its place up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import in_slices, map_arrow, stored, strings
from millrace.llm.tokens import REMEMBERED, encoder

CAPACITY = 2048
#: Rounds in which a configuration takes a small share of its lengths' counts, and that share.
ROUNDS, SHARE = 300, 0.1
#: How strongly a price falls with what has been covered.
STEP = 0.5
#: Prices start as this power of the length: over 1, so that long pieces are placed while short ones are left to fill up.
POWER = 1.2
#: Bits that hold the number of a piece within its length.
RANK_BITS = 44

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _rank long"


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go. Arrays of one entry per length and configuration:

    pieces of ``length`` numbered from ``first`` on fill ``each`` places a sequence, from sequence
    ``sequence`` and offset ``offset`` on.
    """

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of lengths worth most, as a count per length, by dynamic programming.

    ``prices[l]`` is what one piece of length l is worth; 0 for lengths that don't occur.
    """
    lengths = np.flatnonzero(prices > 0)
    few = lengths.size * 4 < capacity
    worth = prices[lengths] if few else np.where(prices > 0, prices, -1.0)[1:]
    best = np.zeros(capacity + 1)  # of a room, at capacity - room
    chosen = np.zeros(capacity + 1, dtype=np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    shifted = capacity + lengths
    values = np.empty(capacity)
    for room in range(1, capacity + 1):
        here = capacity - room
        best[here] = best[here + 1]
        if n := upto[room]:
            if few:
                value = best[shifted[:n] - room] + worth[:n]
            else:
                value = np.add(best[here + 1 :], worth[:room], out=values[:room])
            at = int(value.argmax())
            if value[at] > best[here]:
                best[here], chosen[room] = value[at], lengths[at] if few else at + 1
    counts = np.zeros(capacity + 1, dtype=np.int64)
    room = capacity
    while room > 0:
        if chosen[room]:
            counts[chosen[room]] += 1
            room -= chosen[room]
        else:
            room -= 1
    return counts


def cover(need: np.ndarray, capacity: int, rounds: int = ROUNDS, share: float = SHARE, step: float = STEP) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: together at most ``need`` (a count per length), and of no
    length less by as much as one sequence holds. At most ``rounds`` and two for each length are made.

    A price falls by a factor for each share of its length's count that is covered.
    """
    left = need.copy()
    start = (np.arange(need.size) / capacity) ** POWER
    inside = left > 0
    uses: list[tuple[np.ndarray, int]] = []
    while inside.any():
        prices = start * np.exp(step * left / np.maximum(need, 1))
        counts = best_configuration(np.where(inside, prices, 0.0), capacity)
        held = np.flatnonzero(counts)
        times = int((left[held] // counts[held]).min())
        if not times:
            inside[held[left[held] < counts[held]]] = False
            continue
        if rounds > 0:
            times = min(times, max(1, int((share * need[held] / counts[held]).min())))
        rounds -= 1
        left[held] -= counts[held] * times
        inside[held] = left[held] > 0
        uses.append((counts, times))
    return uses


def best_fit(left: np.ndarray, capacity: int) -> dict[tuple[int, ...], int]:
    """Puts what is left, the longest first, into the fullest sequence with room for it."""
    from bisect import bisect_left, insort

    room: list[int] = []  # of open sequences, ascending
    holds: dict[int, list[list[int]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        for _ in range(int(left[length])):
            at = bisect_left(room, length)
            if at < len(room):
                was = room.pop(at)
                held = holds[was].pop()
            else:
                was, held = capacity, []
            held.append(length)
            holds.setdefault(was - length, []).append(held)
            insort(room, was - length)
    closed: dict[tuple[int, ...], int] = {}
    for lists in holds.values():
        for held in lists:
            closed[tuple(held)] = closed.get(tuple(held), 0) + 1
    return closed


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Slots:
    """Places for all pieces of a histogram of lengths from 1 to ``capacity``."""
    need = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        need[length] = n
    used: dict[tuple[int, ...], int] = {}
    left = need.copy()
    if left[capacity]:
        used[(capacity,)] = int(left[capacity])
        left[capacity] = 0
    for counts, times in cover(left, capacity):
        held = np.flatnonzero(counts)
        left[held] -= counts[held] * times
        key = tuple(np.repeat(held, counts[held])[::-1].tolist())
        used[key] = used.get(key, 0) + times
    for key, n in best_fit(left, capacity).items():
        used[key] = used.get(key, 0) + n
    taken = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for key, times in used.items():
        offset = 0
        for length in dict.fromkeys(key):
            each = key.count(length)
            rows.append((length, taken[length], each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    rows.sort()
    columns = [np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)] or [np.zeros(0, np.int64)] * 5
    return Slots(*columns, sequence)


def _pieces(path: str, end_id: int, capacity: int, remembered: int):
    """Batches of documents to batches of pieces, numbered within their length and task."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = encoder(path, remembered).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in in_slices(batches):
            out: list[list] = [[] for _ in range(5)]
            ranks = []
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                ids = memoryview(ids_of(text) + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    length = len(cut) // 4
                    for column, value in zip(out, (doc, piece, at // 4, length, zlib.crc32(cut)), strict=True):
                        column.append(value)
                    ranks.append(int(seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
            arrays += [pa.array(np.full(len(ranks), part, np.int32)), pa.array(ranks, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in PIECES.split(", ")])

    return run


def _placed(slots: Slots):
    """Batches of numbered pieces to the sequence and offset of each."""
    starts = (slots.length << RANK_BITS) + slots.first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "_rank"))
            at = np.searchsorted(starts, (length << RANK_BITS) + rank, side="right") - 1
            copy, place = np.divmod(rank - slots.first[at], slots.each[at])
            arrays = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            arrays += [pa.array(slots.sequence[at] + copy), pa.array(slots.offset[at] + place * length)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; longer ones than ``capacity`` are cut into pieces of it.
    A null or empty text is the end id alone, a null doc_id stays null, repeated rows are packed each, an
    empty table gives no rows, and other columns aren't read. ``doc_id`` must be an integer column. A worker
    remembers ``remembered`` words in each of two generations; it changes no result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = stored(map_arrow(rows, _pieces(tokenizer, end_id, capacity, remembered), PIECES), "pieces")
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = pieces.join(bases, ["length", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_arrow(numbered.drop("_base", "_part"), _placed(plan(histogram, capacity)), schema)
