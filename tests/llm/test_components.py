"""Components that grow by more links, and languages found without passing other columns through Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.llm import graph, language
from millrace.llm.shared import scratch_mark


def _labels(frame):
    return {r.node: r.label for r in frame.collect()}


def test_few_links_are_put_together_at_once(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long").coalesce(1)
    mark = scratch_mark()
    assert _labels(graph.components(links)) == dict.fromkeys(range(51), 0)
    assert scratch_mark() - mark == 1


def test_components_joined_by_more_links(spark):
    draw = random.Random(5)
    first = [(draw.randrange(400), draw.randrange(400)) for _ in range(150)] + [(500, 500 + i) for i in range(1, 300)]
    more = [(draw.randrange(450), draw.randrange(900)) for _ in range(80)] + [(3, 3)]
    frames = [spark.createDataFrame(x, "a long, b long").repartition(3) for x in (first, more, [])]
    labels = graph.components(frames[0])
    whole = graph.components(frames[0].unionByName(frames[1].filter("a != b")))
    assert _labels(graph.joined(labels, frames[1])) == _labels(whole)
    assert _labels(graph.joined(labels, frames[2])) == _labels(labels)
    assert _labels(graph.joined(graph.components(frames[2]), frames[0])) == _labels(labels)


def test_only_texts_are_passed_to_be_scored_and_once(spark, capsys):
    rows = [(i, f"the river and the {i} stones of it" if i % 2 else f"der fluss und die {i} steine darin", "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame([*rows, (90, "123", None), (91, None, "en")], "doc_id long, text string, lang string")
    found = language.detect(docs, language.fit(docs)).filter(F.col("lang_pred") != language.UNDETERMINED)
    assert {(r.doc_id, r.lang_pred) for r in found.collect()} == {(i, lang) for i, _, lang in rows}
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
