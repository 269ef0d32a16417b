"""Repairs the order of roles in conversations by the cheapest edits.

Allowed are an opening system turn, if any, and pairs of a user's and an assistant's turn, or nothing at
all. A generalised LR parser reads a conversation's turns with the tables of that grammar. Wherever a turn
may be kept, given another role or deleted, and one may be inserted, it goes all ways at once; the stacks
share what lies below, and stacks with equal tops are merged into the one with the least cost, then the
least audit, the edits' initials in order. In this grammar what may follow depends on a stack's top alone,
so merging loses nothing.

A conversation need not be in one task. Turns are dealt out by range and a task parses the turns it has of
a conversation from every top that the turns before may leave; these tables are put together for each
conversation, and the edits found go back to the tasks with the turns. Equal turns are counted before the
shuffle. Audits are kept as links to what came before and are compared by rank, so a step costs the same
wherever it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import in_slices, map_arrow, spread_join
from millrace.session import scratch_path

#: What edits cost; a turn that is cut off costs one more unless it is deleted.
RELABEL, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"

# The parser's tables for  Talk: s Pairs | Pairs | nothing   Pairs: Pairs Pair | Pair   Pair: u a
SHIFTS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (4, "u"): 2, (5, "u"): 2, (2, "a"): 3}
REDUCTIONS = {3: (2, "Pair"), 6: (1, "Pairs"), 7: (2, "Pairs")}
GOTOS = {(0, "Pair"): 6, (1, "Pair"): 6, (4, "Pair"): 7, (5, "Pair"): 7, (0, "Pairs"): 4, (1, "Pairs"): 5}
ACCEPTED = (0, 4, 5)

#: A stack is its top state and the stack below.
Stack = tuple
START: Stack = (0, None)
#: Stacks that stand for all with such a top: nothing yet, after the system's turn, after a user's, after a pair.
ENTRIES: dict[int, Stack] = {0: START, 1: (1, START), 2: (2, START), 4: (4, START)}

_LEGAL = {"su", "ua", "au"}
SEGMENT = (
    "first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long, "
    "head string, tail string, moves array<struct<entry:int,exit:int,cost:long,audit:string>>"
)
VERDICT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def pushed(stack: Stack, role: str) -> Stack | None:
    """The stack after a role's initial and all reductions, or none if the role can't follow."""
    state = SHIFTS.get((stack[0], role))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCTIONS:
        length, name = REDUCTIONS[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (GOTOS[stack[0], name], stack)
    return stack


@lru_cache(maxsize=4096)
def with_inserts(stack: Stack) -> list[tuple[int, str, Stack]]:
    """(cost, edits, stack) after inserting turns before the next one; a top that was reached needs no more."""
    found, tops = [(0, "", stack)], {stack[0]}
    for cost, edits, at in found:
        for role in ROLES:
            after = pushed(at, role)
            if after and after[0] not in tops:
                tops.add(after[0])
                found.append((cost + INSERT, edits + "I", after))
    return found


@lru_cache(maxsize=4096)
def moves(stack: Stack, initial: str, delete: bool, cut_off: bool) -> list[tuple[int, str, Stack]]:
    """(cost, edits, stack) of all ways past a turn, the best for each top."""
    best: dict[int, tuple[int, str, Stack]] = {}

    def way(cost: int, edits: str, after: Stack | None) -> None:
        if after and (after[0] not in best or (cost, edits) < best[after[0]][:2]):
            best[after[0]] = (cost, edits, after)

    for cost, edits, at in with_inserts(stack):
        way(cost + DELETE, edits + "D", at)
        if not delete:
            way(cost + cut_off * CUT_OFF, edits + "K", pushed(at, initial))
            for role in ROLES:
                way(cost + RELABEL + cut_off * CUT_OFF, edits + "R", pushed(at, role))
    return list(best.values())


class _Top(NamedTuple):
    """The best way to a top: cost, rank of its audit among those of all tops, the audit itself as links, stack."""

    cost: int
    rank: int
    audit: tuple | None
    stack: Stack


def _ranked(best: dict[int, tuple]) -> dict[int, _Top]:
    """Tops of (cost, (rank, edits), audit before, stack) ways with ranks of their whole audits.

    Two audits of the same turns end with an edit of the last turn, so neither begins the other unless they
    are equal, and the order of what came before, then of what was added, is the order of the audits.
    """
    order = {key: rank for rank, key in enumerate(sorted({way[1] for way in best.values()}))}
    return {top: _Top(cost, order[key], (audit, key[1]), stack) for top, (cost, key, audit, stack) in best.items()}


def _stepped(tops: dict[int, _Top], ways) -> dict[int, _Top]:
    best: dict[int, tuple] = {}
    for at in tops.values():
        for cost, edits, stack in ways(at):
            new = (at.cost + cost, (at.rank, edits), at.audit, stack)
            if stack[0] not in best or new[:2] < best[stack[0]][:2]:
                best[stack[0]] = new
    return _ranked(best)


def _spelled(audit: tuple | None) -> list[str]:
    parts = []
    while audit is not None:
        audit, edits = audit
        parts.append(edits)
    return parts[::-1]


def _exit(state: int) -> int:
    return 4 if state == 5 else state


class _Segment:
    """What a task has of one conversation, turn by turn."""

    def __init__(self, entries: tuple[int, ...]):
        self.tops = {e: {ENTRIES[e][0]: _Top(0, 0, None, ENTRIES[e])} for e in entries}
        self.first = self.last = self.head = self.tail = None
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, times: int, known: bool) -> None:
        """``times`` equal turns; ``known`` if an earlier one of the conversation equals them."""
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.n_turns += 1
        said = text.rstrip(BLANKS)
        initial = role[:1]
        self.illegal += (self.tail is not None and self.tail + initial not in _LEGAL) + (times - 1)
        self.head = initial if self.head is None else self.head
        self.tail = initial
        copies, cut_off = times - 1, bool(said) and said[-1] not in ENDS
        if not said:
            self.blank += times
        else:
            self.duplicate += times if known else copies
            self.truncated += cut_off and not known
        if not said or known:
            copies += 1
        else:
            self._read(lambda at: moves(at.stack, initial, False, cut_off))
        if copies:
            self._read(lambda at: [(DELETE * copies, "D" * copies, at.stack)])

    def _read(self, ways) -> None:
        self.tops = {entry: _stepped(tops, ways) for entry, tops in self.tops.items()}

    def summary(self) -> dict:
        found = {}
        for entry, tops in self.tops.items():
            for top in tops.values():
                way = (top.cost, "".join(_spelled(top.audit)))
                key = (entry, _exit(top.stack[0]))
                found[key] = min(way, found.get(key, way))
        table = [{"entry": e, "exit": x, "cost": c, "audit": a} for (e, x), (c, a) in sorted(found.items())]
        counts = ("n_turns", "blank", "duplicate", "truncated", "illegal", "head", "tail")
        return {"first_turn": self.first, "last_turn": self.last, **{k: getattr(self, k) for k in counts}, "moves": table}


def _parsing(conv_type: str):
    """Sorted turns and marks of repeated ones to the same turns, with their number, and a summary of each segment."""
    names = ["kind", "conv_id", "seg", "at", "role", "text", "times", "summary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, conv, tie, marks, at, schema, part = None, None, None, set(), 0, None, 0

        def ended(out: list) -> None:
            if segment is not None:
                out.append(("segment", conv, part, -1, None, None, None, segment.summary()))

        for batch in in_slices(batches):
            schema = batch.schema
            out: list[tuple] = []
            for row in batch.to_pylist():
                part = row["part"]
                if segment is None or row["conv_id"] != conv:
                    ended(out)
                    # only the first conversation of a task may have begun before
                    segment, conv, tie = _Segment(tuple(ENTRIES) if segment is None else (0,)), row["conv_id"], None
                here = (row["turn"], row["role"], row["prefix"])
                if here != tie:
                    tie, marks = here, set()
                key = (row["key"]["a"], row["key"]["b"])
                if row["mark"]:
                    marks.add(key)
                elif row["times"]:
                    segment.add(row["turn"], row["role"], row["text"], row["times"], key in marks)
                    out.append(("turn", conv, part, at, row["role"], row["text"], row["times"], None))
                    at += 1
            yield _batch(out, names, schema.field("conv_id").type)
        if segment is not None:
            out = []
            ended(out)
            yield _batch(out, names, schema.field("conv_id").type)

    return run


_MOVES = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SUMMARY = pa.struct(
    [(x, pa.int64()) for x in ("first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated", "illegal")]
    + [("head", pa.string()), ("tail", pa.string()), ("moves", _MOVES)]
)
_KINDS = {"seg": pa.int32(), "at": pa.int64(), "times": pa.int64(), "cost": pa.int64(), "entry": pa.int32(), "summary": _SUMMARY, "nth": pa.int64()}


def _batch(rows: list[tuple], names: list[str], conv_type) -> pa.RecordBatch:
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")
    kinds = [conv_type if n == "conv_id" else _KINDS.get(n, pa.int64() if n in counts else pa.string()) for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def verdict(segments: list[dict]) -> tuple[dict, list[tuple[int, str]]]:
    """Counts, cost and audit of a conversation from its segments in order, and (top before, edits) of each."""
    tops = {0: _Top(0, 0, None, START)}
    total = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
    first = last = tail = None
    n_turns = 0
    for held in segments:
        table: dict[int, list] = {}
        for m in held["moves"]:
            table.setdefault(m["entry"], []).append((m["cost"], m["audit"], ENTRIES[m["exit"]]))
        best: dict[int, tuple] = {}
        for at in tops.values():
            entry = _exit(at.stack[0])
            for cost, audit, stack in table.get(entry, []):
                new = (at.cost + cost, (at.rank, audit), (at.audit, (entry, audit)), stack)
                if stack[0] not in best or new[:2] < best[stack[0]][:2]:
                    best[stack[0]] = new
        order = {key: rank for rank, key in enumerate(sorted({way[1] for way in best.values()}))}
        tops = {top: _Top(cost, order[key], audit, stack) for top, (cost, key, audit, stack) in best.items()}
        for count in ("blank", "duplicate", "truncated", "illegal"):
            total[count] += held[count]
        if held["head"] is not None:
            total["illegal"] += tail is not None and tail + held["head"] not in _LEGAL
            tail = held["tail"]
        if held["first_turn"] is not None:
            n_turns += held["n_turns"] - (last == held["first_turn"])
            first = held["first_turn"] if first is None else first
            last = held["last_turn"]
    if n_turns:
        total["gaps"] = last - first + 1 - n_turns
    ends = [(at.cost + c, at.rank, e, at) for at in tops.values() for c, e, s in with_inserts(at.stack) if s[0] in ACCEPTED]
    cost, _, added, best_top = min(ends, key=lambda x: x[:3])
    parts, link = [], best_top.audit
    while link is not None:
        link, part = link
        parts.append(part)
    parts.reverse()
    parts[-1] = (parts[-1][0], parts[-1][1] + added)
    return total | {"cost": cost, "audit": "".join(a for _, a in parts)}, parts


def _judging(conv_type: str):
    """Segments of a conversation to its verdict (seg -1) and the edits of each segment."""
    names = ["conv_id", "seg", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "entry"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            out = []
            for row in batch.to_pylist():
                total, parts = verdict([s["summary"] for s in row["segments"]])
                out.append((row["conv_id"], -1, *(total[k] for k in names[2:9]), None))
                for held, (entry, audit) in zip(row["segments"], parts, strict=True):
                    out.append((row["conv_id"], held["seg"], *[None] * 6, audit, entry))
            yield _batch(out, names, batch.schema.field("conv_id").type)

    return run


class Repair(NamedTuple):
    """Stored results: verdicts and edits of segments (``verdicts``), and the turns that were read."""

    verdicts: DataFrame
    turns: DataFrame
    conv_type: str


def repair(turns: DataFrame) -> Repair:
    """Parses conversations: rows with conv_id, turn (a number), role, text and ``times``.

    ``times`` says how many equal turns a row stands for; with 0 there is none, but the conversation is
    known. Turns go by number, null first, then by role and text. A null role or text counts as one blank. A null
    conv_id is a conversation. A role is known by its first character; an empty one can't be kept. Turns
    without anything but blanks, and those whose role and text occurred earlier, must be deleted. No rows
    give no conversations. Other columns aren't read.
    """
    spark = turns.sparkSession
    conv_type = dict(turns.dtypes)["conv_id"]
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.col("times").cast("long").alias("times"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    key = F.struct(F.xxhash64(name, "role", "text").alias("a"), F.xxhash64(F.lit("b"), name, "role", "text").alias("b"))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    rows = rows.select("conv_id", "turn", "role", F.left("text", F.lit(24)).alias("prefix"), F.lit(False).alias("mark"), key.alias("key"), "text", "times")
    said = rows.filter("times > 0").select("conv_id", "turn", "role", "prefix", "key")
    # a turn that is said twice is rare, its first place is one row for each
    again = said.groupBy("key").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    marks = spread_join(said, again, "key", "_n", F.col("turn")).filter(place > F.col("_first"))
    marks = marks.select("conv_id", "turn", "role", "prefix", F.lit(True).alias("mark"), "key", F.lit(None).cast("string").alias("text"), F.lit(1).cast("long").alias("times"))
    order = ("conv_id", "turn", "role", "prefix")
    dealt = rows.unionByName(marks).repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order, F.desc("mark"), "text").withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, "turns")
    columns = f"kind string, conv_id {conv_type}, seg int, at long, role string, text string, times long, summary struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>"
    map_arrow(dealt, _parsing(conv_type), columns).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(columns).parquet(path)
    segments = stored.filter("kind = 'segment'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", "summary"))).alias("segments"))
    found = map_arrow(segments, _judging(conv_type), f"conv_id {conv_type}, seg int, {VERDICT}, entry int")
    path = scratch_path(spark, "verdicts")
    found.write.parquet(path)
    turns = stored.filter("kind = 'turn'").select("conv_id", "seg", "at", "role", "text", "times")
    return Repair(spark.read.schema(found.schema).parquet(path), turns, conv_type)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows sorted by conversation, segment and number, edits first, to (edit, role, text) for each edit.

    The row itself comes as the first of the tuple; verdicts come as they are, without an edit.
    """
    audit, at, expected, held = "", 0, "u", None

    def inserted():
        nonlocal at, expected
        while at < len(audit) and audit[at] == "I":
            at += 1
            yield held, "I", ROLES[expected], ""
            expected = "a" if expected == "u" else "u"

    for batch in in_slices(batches):
        for row in batch.to_pylist():
            if row["audit"] is not None:
                yield from inserted()
                audit, at, held = row["audit"], 0, row
                if row["entry"] is None:
                    audit = ""
                    yield row, "", None, None
                else:
                    expected = "a" if row["entry"] == 2 else "u"
                continue
            for _ in range(row["times"]):
                yield from inserted()
                edit = audit[at]
                at += 1
                role = row["role"] if edit != "R" else ROLES[expected]
                if edit != "D":
                    expected = "a" if role[:1] == "u" else "u"
                yield row, edit, role, row["text"]
    yield from inserted()


def _together(found: Repair, verdicts: bool) -> DataFrame:
    """Turns and edits in one frame, not yet dealt out."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    edits = found.verdicts if verdicts else found.verdicts.filter("seg >= 0")
    edits = edits.withColumns({"at": F.lit(-1).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "times": F.lit(0).cast("long")})
    missing = {c: F.lit(None).cast("long") for c in counts} | {"audit": F.lit(None).cast("string"), "entry": F.lit(None).cast("int")}
    return found.turns.withColumns(missing).unionByName(edits)


def edited_turns(found: Repair) -> DataFrame:
    """One row per edit: conv_id, seg, nth, edit (K, R, D or I), role, text; what is deleted has its old role.

    ``seg`` and ``nth`` give the order. A segment is one group of rows, so a long conversation isn't one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, nth, last = None, [], 0, None
        names = ["conv_id", "seg", "nth", "edit", "role", "text"]

        def seen():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        for row, edit, role, text in _edited(seen()):
            here = (row["conv_id"], row["seg"])
            nth = nth + 1 if here == last else 0
            last = here
            out.append((*here, nth, edit, role, text))
            if len(out) == 512:
                yield _batch(out, names, schema.field("conv_id").type)
                out = []
        if out:
            yield _batch(out, names, schema.field("conv_id").type)

    rows = _together(found, False).repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "at")
    return map_arrow(rows, run, f"conv_id {found.conv_type}, seg int, nth long, edit string, role string, text string")


def verdicts_with_digest(found: Repair) -> DataFrame:
    """One row per conversation: conv_id, the counts, cost, audit and the SHA-256 of its repaired turns.

    What is digested is ``role:text`` of every turn that stays, joined by line feeds; the turns are read one
    after the other and not kept.
    """
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, verdict_row, digest, any_turn = None, [], None, None, False

        def seen():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        def ended():
            if verdict_row is not None:
                out.append((*(verdict_row[k] for k in names[:8]), digest.hexdigest()))

        for row, edit, role, text in _edited(seen()):
            if not edit:
                ended()
                verdict_row, digest, any_turn = row, hashlib.sha256(), False
            elif edit != "D":
                digest.update((("\n" if any_turn else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                any_turn = True
            if len(out) >= 512:
                yield _batch(out, names, schema.field("conv_id").type)
                out.clear()
        ended()
        if out:
            yield _batch(out, names, schema.field("conv_id").type)

    rows = _together(found, True).repartition("conv_id").sortWithinPartitions("conv_id", "seg", "at")
    return map_arrow(rows, run, f"conv_id {found.conv_type}, {VERDICT}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn, ready for ``repair``.

    Of twenty turns one is dropped, one emptied, one loses its sentence ends, one is said twice and one gets
    the role of the user. Nulls count as one blank.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 0, "").when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
