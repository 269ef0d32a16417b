"""Links between members of groups whose first members are far apart."""

from __future__ import annotations

from millrace.llm import ngram_join


def test_members_are_linked_though_the_first_of_their_groups_differ(spark):
    """Two texts with one prefix and otherwise apart, and a near copy of each: whichever is the first of its
    group, both near copies are found."""
    prefix = [f"p{i}" for i in range(11)]
    rests = [[f"r{k}x{i}" for i in range(89)] for k in range(2)]
    texts = [prefix + rest for rest in rests] + [["new" + str(k), *prefix[1:], *rest] for k, rest in enumerate(rests)]
    # texts that make all but the prefix frequent, so that it comes first in the order of all
    texts += [rests[k] + [f"own{k}x{j}x{i}" for i in range(60)] for k in range(2) for j in range(24)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.component_id for r in ngram_join.similar_components(docs, words=1).collect()}
    assert found == {i: {2: 0, 3: 1}.get(i, i) for i in range(len(texts))}
