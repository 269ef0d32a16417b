"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import map_arrow, split_join, stored

#: Links that a task puts together at once.
AT_ONCE = 1 << 18


def _forest(links: list[tuple[int, int]]) -> dict[int, int]:
    """Each node of some links to the smallest one these connect it with."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        above = parent.setdefault(x, x)
        while above != x:
            parent[x] = parent[above]
            x, above = above, parent[above]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links to stars that connect the same nodes; a task holds a bounded part of its links at once.

    Each part has a number of its own.
    """
    part = TaskContext.get().partitionId() << 32

    def stars(links: list[tuple[int, int]]) -> pa.RecordBatch:
        found = [(x, y) for x, y in _forest(links).items() if x != y]
        columns = [[x for x, _ in found], [y for _, y in found], [part] * len(found)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["u", "v", "part"])

    held: list[tuple[int, int]] = []
    for batch in batches:
        held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        if len(held) >= AT_ONCE:
            yield stars(held)
            held, part = [], part + 1
    yield stars(held)


def _to_minimum(sym: DataFrame, total: int) -> DataFrame:
    """Links (u, v) with the smallest node that u is linked with, u included, as m; a hub is cut into pieces."""
    least = sym.groupBy("u").agg(F.min("v").alias("_v"), F.count("*").alias("_links")).withColumn("m", F.least("u", "_v"))
    return split_join(sym, least.select("u", "m", "_links"), "u", "_links", F.col("v"), total)


def _settled(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _put_together(links: DataFrame, purpose: str) -> DataFrame:
    return stored(map_arrow(links, _forests, "u long, v long, part long"), purpose)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the label is the smallest node it is connected with.

    Tasks first put the links they hold together; links that were few enough for one part of one task are
    stars then. Otherwise two steps alternate until nothing changes: all larger neighbours of a node are linked
    to its smallest one, then all smaller ones. The links never grow in number and end as stars, after about the
    logarithm of the number of nodes; once they are no more than a task puts together at once, one task ends it.
    Links to oneself and repeated links don't matter; no links give no rows.
    """
    forests = _put_together(links.select("a", "b"), "links")
    edges = forests.select("u", "v")
    least, most = forests.agg(F.min("part"), F.max("part")).first()
    known = _settled(edges) if least != most else (0, 0)
    while known[0]:
        if known[0] < AT_ONCE:
            edges = _put_together(edges.coalesce(1), "last-links").select("u", "v")
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = _to_minimum(both, 2 * known[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(larger.filter("u > v").distinct(), "large-star")
        found = _to_minimum(edges, known[0])
        smaller = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        edges = stored(smaller.filter("u > v").distinct(), "small-star")
        now = _settled(edges)
        if now == known:
            break
        known = now
    centres = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres.withColumn("label", F.col("node")))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) of components, with more links (a, b) between any nodes.

    Only the links go through ``components`` again, between the labels of what they link; a label of very
    many nodes is cut into pieces when its new name is given to them.
    """
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("_a")), "a", "left")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_b")), "b", "left")
    between = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a != b")
    found = stored(components(between), "joined")
    sizes = stored(labels.groupBy("label").agg(F.count("*").alias("_nodes")), "label-sizes")
    names = found.select(F.col("node").alias("label"), F.col("label").alias("_name"))
    renamed = sizes.join(names, "label", "left").select("label", "_nodes", F.coalesce("_name", "label").alias("_name"))
    total = sizes.agg(F.sum("_nodes")).first()[0] or 0
    old = split_join(labels, renamed, "label", "_nodes", F.col("node"), total, sizes).select("node", F.col("_name").alias("label"))
    new = found.join(sizes, F.col("node") == sizes["label"], "left_anti")
    return stored(old.unionByName(new), "labels")
