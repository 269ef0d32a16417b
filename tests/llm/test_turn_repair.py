"""Conversation repair against all edits there are, and against a plain shortest path, on odd and split conversations."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.turn_repair import damaged, edited_turns, repair, verdicts_with_digest

LEGAL = re.compile("(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")
SCHEMA = "conv_id long, turn long, role string, text string, times int, seg int, cost string, audit string, kind string"


def faults(rows):
    """(role, text, must be deleted, cut off) of sorted turns, and the counts."""
    seen, out, counts = set(), [], dict(blank=0, duplicate=0, truncated=0, illegal=0)
    for at, (role, text) in enumerate(rows):
        said = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        if at:
            counts["illegal"] += rows[at - 1][0][:1] + role[:1] not in ("su", "ua", "au")
        out.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    return out, counts


def choices(turn):
    role, text, must, cut = turn
    yield 3, "D", None
    if not must:
        if role:
            yield cut, "K", (role, text)
        for other in ("user", "assistant"):
            yield 2 + cut, "R", (other, text)


INSERTS = [[]] + [[("user", "")], [("assistant", "")]] + [[(a, ""), (b, "")] for a, b in product(("user", "assistant"), repeat=2)]


def every_edit(turns):
    """The best of all ways to edit a few turns, with up to two inserts at each place."""
    best = None
    for gaps in product(INSERTS, repeat=len(turns) + 1):
        for edits in product(*[list(choices(t)) for t in turns]):
            kept, audit, cost = [], "", 0
            for gap, edit in zip(gaps, [*edits, None], strict=True):
                kept += gap
                audit += "I" * len(gap)
                cost += 2 * len(gap)
                if edit:
                    cost, audit = cost + edit[0], audit + edit[1]
                    kept += [edit[2]] if edit[2] else []
            if LEGAL.fullmatch("".join(r[:1] for r, _ in kept)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, kept)
    return best


def shortest(turns):
    """The same by relaxing whole audits over (initials so far without pairs)."""

    def follow(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def insert(ways):
        for _ in range(2):
            for state, (cost, audit, kept) in list(ways.items()):
                for role in ("user", "assistant"):
                    after, new = follow(state, role[0]), (cost + 2, audit + "I", [*kept, (role, "")])
                    if after and (after not in ways or new[:2] < ways[after][:2]):
                        ways[after] = new
        return ways

    ways = insert({"": (0, "", [])})
    for turn in turns:
        after = {}
        for state, (cost, audit, kept) in ways.items():
            for price, edit, left in choices(turn):
                to = state if left is None else follow(state, left[0][:1])
                new = (cost + price, audit + edit, kept + ([left] if left else []))
                if to is not None and (to not in after or new[:2] < after[to][:2]):
                    after[to] = new
        ways = insert(after)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def expected(rows, best=shortest):
    """{conv_id: the whole row}"""
    talks = defaultdict(list)
    for conv, turn, role, text, times in rows:
        talks[conv] += [(turn is not None, turn or 0, " " if role is None else role, " " if text is None else text)] * times
    out = {}
    for conv, held in talks.items():
        held.sort()
        numbers = [t for numbered, t, _, _ in held if numbered]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        turns, counts = faults([h[2:] for h in held])
        cost, audit, kept = best(turns)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), cost, audit, digest, kept)
    return out


def random_talks(seed, n, longest):
    rng = np.random.default_rng(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No", "Why?", "  ", "", "so\n", "ok! ", None]
    rows = []
    for conv in range(n):
        for _ in range(rng.integers(1, longest + 1)):
            turn = None if rng.random() < 0.1 else int(rng.integers(0, 6))
            weights = [0.35, 0.35, 0.15, 0.05, 0.05, 0.05]
            text = texts[rng.integers(0, 8)] if rng.random() < 0.4 else f"{rng.integers(0, 999)}."
            rows.append((None if conv == 0 else conv, turn, roles[rng.choice(6, p=weights)], text, int(rng.choice([0, 1, 1, 1, 2]))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "a", "k") for r in rows], SCHEMA).repartition(5)


def check(spark, rows, best=shortest):
    wanted = expected(rows, best)
    found = repair(frame(spark, rows))
    got = {r.conv_id: r for r in verdicts_with_digest(found).collect()}
    assert set(got) == set(wanted)
    for conv, (gaps, blank, duplicate, truncated, illegal, cost, audit, digest, _) in wanted.items():
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == (gaps, blank, duplicate, truncated, illegal)
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, digest)
    edits = defaultdict(list)
    for r in sorted(edited_turns(found).collect(), key=lambda r: (r.seg, r.nth)):
        edits[r.conv_id].append(r)
    for conv, (*_, audit, _, kept) in wanted.items():
        assert "".join(r.edit for r in edits[conv]) == audit
        assert [(r.role, r.text) for r in edits[conv] if r.edit != "D"] == kept


def test_against_every_edit():
    for rows in np.array_split(np.arange(12), 12):
        talk = random_talks(int(rows[0]) + 50, 2, 3)
        for conv in {r[0] for r in talk}:
            turns, _ = faults([(r[2] or " ", r[3] or " ") for r in talk if r[0] == conv][:2])
            assert shortest(turns) == every_edit(turns) or shortest(turns)[:2] == every_edit(turns)[:2]


@pytest.mark.parametrize("seed", [0, 1])
def test_random_conversations(spark, seed):
    check(spark, random_talks(seed, 150, 9))


def test_one_conversation_in_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [(7, i // 2, r, t, n) for i, (_, _, r, t, n) in enumerate(random_talks(5, 60, 9))] + random_talks(6, 5, 3)
        rows = [r for r in rows if r[0] == 7] + [(c, *rest) for c, *rest in rows if c != 7]
        found = repair(frame(spark, rows))
        assert found.turns.filter("conv_id = 7").select("seg").distinct().count() > 5
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_dropped_and_repeated(spark):
    assert verdicts_with_digest(repair(frame(spark, []))).collect() == []
    assert edited_turns(repair(frame(spark, []))).collect() == []
    long = "Ein sehr langer Satz. " * 20000
    rows = [(1, 0, "user", "x", 0), (2, 0, "user", "Hi.", 300), (3, None, "assistant", long, 1), (3, None, "assistant", long, 1), (None, None, None, None, 1)]
    check(spark, rows)
    nothing = next(r for r in verdicts_with_digest(repair(frame(spark, rows))).collect() if r.conv_id == 1)
    assert nothing[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage_counts_nulls_as_a_blank(spark):
    import zlib

    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, *range(15)) for r, x in (("assistant", "Hm. So?!"), (None, None))]
    for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        fault = zlib.crc32(key.encode()) % 20
        assert r.times == {0: 0, 3: 2}.get(fault, 1)
        assert r.text in {0: ("",), 1: ("",), 2: ("Hm So", " ")}.get(fault, ("Hm. So?!", " "))
        assert r.role in {0: ("",), 4: ("user",)}.get(fault, ("assistant", " "))
        assert BLANK.fullmatch(r.text) or r.text.startswith("Hm")
    assert damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).filter(F.lit(True)).count() == 0
