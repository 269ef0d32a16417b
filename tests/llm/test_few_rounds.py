"""Links and pairs that are few are done with at once, whatever the number of partitions."""

from __future__ import annotations

import pytest

from millrace.llm import graph, ngram_join
from millrace.llm.shared import scratch_mark, written_since


def _purposes(mark: int) -> str:
    return " ".join(written_since(mark))


def test_few_links_of_many_parts_end_in_one_task(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long").repartition(7)
    mark = scratch_mark()
    assert {r.node: r.label for r in graph.components(links).collect()} == dict.fromkeys(range(201), 0)
    assert "last-links" in _purposes(mark) and "star" not in _purposes(mark)


def test_many_links_still_meet_by_stars(spark, monkeypatch):
    monkeypatch.setattr(graph, "AT_ONCE", 20)
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 900 + i) for i in range(1, 90)], "a long, b long").repartition(7)
    mark = scratch_mark()
    assert {r.node: r.label for r in graph.components(links).collect()} == dict.fromkeys(range(201), 0) | dict.fromkeys(range(900, 990), 900)
    assert "star" in _purposes(mark)


def _crowd(spark):
    """Sets of four words: one is in all of them, four neighbours share a second one."""
    return spark.createDataFrame([(i, f"common group{i - i % 4} own{i} other{i}") for i in range(160)], "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("round_from", [0, ngram_join.PAIRS_AT_ONCE])
def test_pivots_are_drawn_again_only_for_many_pairs(spark, round_from):
    mark = scratch_mark()
    found = ngram_join.similar_components(_crowd(spark), words=1, similar=(1, 4), dense=2, pivots=1, round_from=round_from)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 4 for i in range(160)}
    draws = _purposes(mark).count("/draws-")
    assert draws == 1 if round_from else draws > 1
