"""Whole rows are shuffled only where their ids don't tell already what becomes of them."""

from __future__ import annotations

from collections import Counter

import pytest

from millrace.llm import mixing, ngram_join


@pytest.mark.parametrize(("listed", "most"), [(1000, 200), (1, 600)])
def test_rows_of_a_sure_number_of_copies_meet_no_group(spark, monkeypatch, listed, most):
    """The first draws of a source are in and the last ones out whatever their quality; a source not listed asks for all."""
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(600)] + [(None, "no id", None), (None, None, "s0"), (3, "again", "s0"), (3, "again", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 600, 2)], "doc_id long, quality int")
    asked, join = [], mixing.spread_join
    monkeypatch.setattr(mixing, "BOUNDED", listed)
    monkeypatch.setattr(mixing, "spread_join", lambda left, *rest: asked.append(left.count()) or join(left, *rest))
    found = Counter(map(tuple, mixing.mixed_rows(docs, labels).collect()))
    with_weights, quality = mixing.with_quality(docs, labels)
    wanted = Counter()
    for r in mixing.mix(with_weights, quality).collect():
        wanted[r.doc_id, r.text, r.source] += r.copies
    assert found == +wanted
    assert asked and 0 < asked[0] <= most


def test_rows_that_stay_are_not_joined(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own {i} text of words {i * 7} and {i * 11} more") for i in range(200)] + [(900, text), (901, text + " end"), (None, text), (None, "no id"), (5, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    maybe, passed = ngram_join._maybe, []

    def watched(frame, key, wanted):
        found = maybe(frame, key, wanted)
        if key == "_own":
            passed.append(found.filter("_maybe").count())
        return found

    monkeypatch.setattr(ngram_join, "_maybe", watched)
    kept = Counter(map(tuple, ngram_join.one_of_each(docs, 5, (4, 5)).collect()))
    # 5 names the near copies; rows without an id stay together with the one that names itself
    gone = {900, 901}
    assert kept == Counter(x for x in rows if x[0] not in gone)
    assert passed == [2]
