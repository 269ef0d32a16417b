"""Phrase index against brute force: exact phrases, parts of any size, proximity, odd rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import phrase_index
from millrace.llm.phrase_index import index_of, marked, matches, windows_of
from tests.llm.rows import documents, nothing, pairs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(items, n):
    out = defaultdict(set)
    for item, text in items:
        held = words(text)
        for at in range(max(len(held) - n, 0) + 1 if held else 0):
            out[tuple(held[at : at + n])].add("" if item is None else str(item))
    return out


def brute(docs, items, n=10):
    """(doc_id, n_words, hit words, items) of each document."""
    found, wanted = [], windows(items, n)
    lengths = {len(w) for w in wanted}
    for doc, text in docs:
        held, hit, names = words(text), set(), set()
        for size, at in product(lengths, range(len(held))):
            owners = wanted.get(tuple(held[at : at + size])) if at + size <= len(held) else None
            if owners:
                hit |= set(range(at, at + size))
                names |= owners
        found.append((doc, len(held), tuple(sorted(hit)), tuple(sorted(names))))
    return Counter(found)


def got(frame):
    rows = frame.collect()
    for r in rows:
        ends = [x for s in r.spans for x in (s.start, s.end)]
        assert ends == sorted(set(ends))  # in order and apart
    return Counter((r.doc_id, r.n_words, tuple(w for s in r.spans for w in range(s.start, s.end)), tuple(r["items"])) for r in rows)


def random_tables(seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "B", "é", "Zwei", "1", "x9", "ß"]

    def text(least, most):
        joints = rng.choice([" ", "\n", "-", "..", "\x7f", "_"], 80)
        return "".join(f"{vocabulary[w]}{joints[i]}" for i, w in enumerate(rng.integers(0, 7, rng.integers(least, most))))

    docs = [(int(rng.integers(0, 30)), text(0, 60)) for _ in range(60)] + [(None, text(30, 60)), (5, None), (6, "")]
    items = [(int(rng.integers(0, 8)), text(0, 12)) for _ in range(12)] + [(None, docs[0][1]), (3, "a"), (4, None), (7, "...")]
    return docs, items


@pytest.mark.parametrize(("seed", "part", "size"), [(0, 1 << 17, 1 << 20), (1, 7, 200), (2, 1, 64)])
def test_marked_equals_brute_force(spark, seed, part, size):
    docs, items = random_tables(seed)
    index = index_of(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), size)
    wanted = windows_of(spark.createDataFrame(items, "item_id long, text string"), 4)
    assert got(marked(index, wanted, part=part)) == brute(docs, items, 4)


def test_blocks_are_bounded(spark):
    frame = spark.createDataFrame([(i, "word " * 5000) for i in range(200)], "doc_id long, text string").repartition(2)
    rows = index_of(frame).collect()
    assert len(rows) >= 5 and max(len(r.doc_ids) for r in rows) * 25_000 <= phrase_index.BLOCK_BYTES + 25_000
    assert len({r.block for r in rows}) == len(rows)


def test_odd_rows(spark):
    items = [(1, "THE quick, brown fox jumps over the lazy dog near the river"), (2, "Kurz!"), (3, None), (4, " \n"), (None, "no id at all")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id int, terms string")
    wanted = windows_of(table)
    assert got(marked(index_of(documents(spark)), wanted)) == brute(pairs(spark), items)
    assert marked(index_of(nothing(spark)), wanted).collect() == []
    assert {r.n_words for r in marked(index_of(documents(spark)), windows_of(table.limit(0))).collect() if r["items"] or r.spans} == set()
    assert matches(index_of(nothing(spark)), wanted).collect() == []


def test_windows_stay_within_a_document(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three four"), (3, "one two three four")], "doc_id long, text string").coalesce(1)
    wanted = windows_of(spark.createDataFrame([("i", "one two three four")], "item_id string, text string"))
    assert [r.doc_id for r in matches(index_of(docs), wanted).collect()] == [3]


def test_places_of_phrases(spark):
    docs, items = random_tables(3)
    index = index_of(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = matches(index, windows_of(spark.createDataFrame(items, "item_id long, text string"), 3), part=5).collect()
    wanted, expected = windows(items, 3), Counter()
    for doc, text in docs:
        held = words(text)
        for at in range(len(held)):
            for window, owners in wanted.items():
                if tuple(held[at : at + len(window)]) == window:
                    expected.update((doc, item, at, at + len(window)) for item in owners)
    assert Counter((r.doc_id, r.item_id, r.start, r.end) for r in rows) == expected


@pytest.mark.parametrize("slop", [0, 2])
def test_words_close_together_in_any_order(spark, slop):
    docs, items = random_tables(4)
    index = index_of(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = matches(index, windows_of(spark.createDataFrame(items, "item_id long, text string"), 3), slop=slop).collect()
    near = Counter((r.doc_id, r.item_id) for r in rows)
    wanted, expected = windows(items, 3), set()
    for doc, text in docs:
        held = words(text)
        for window, owners in wanted.items():
            size = len(window) + slop
            if any(set(window) <= set(held[at : at + size]) for at in range(len(held))):
                expected |= {(doc, item) for item in owners}
    assert set(near) == expected
    for r in rows:
        assert r.end - r.start <= 3 + slop


def test_digests_do_not_depend_on_what_is_around():
    texts = ["Ab cd", None, "", "ab", "cd--AB", "é" * 300, "x" * 3]
    held = phrase_index.words_of(pa.array(texts))
    assert np.diff(held.firsts).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(zip(flat, held.digests.tolist(), strict=True))) == len(set(flat)) == len(set(held.digests.tolist()))
    again = phrase_index.words_of(pa.array(["zz " + "ab cd"]).slice(0, 1))
    assert again.digests[1:].tolist() == held.digests[:2].tolist()
