"""Mixes sources to target weights.

How much a source gives is a target in words. A source below its target is repeated: complete epochs come
first, and what is still missing is a weighted sample without replacement after Efraimidis and Spirakis.
Each document draws an exponential key, divided by its quality weight; in the order of the keys documents
are taken until their sizes add up to the rest.

The order within a source isn't one sort: keys are dealt into cells, sums of cells give each cell the
words before it, and only within a cell rows are sorted. A source with a third of all rows is so spread
over as many tasks as it has cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import WORD, from_row, n_words, spread_join, stored, whole_row

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
#: Words to take, as a share of all words there are.
SHARE = 1.5
#: Most times that a source, and so a document, is taken.
EPOCHS = 2
#: Cells of a source.
CELLS = 1024
#: Quality weights of documents labelled good and bad; others weigh 1.
GOOD, BAD = 2.0, 0.5
#: Sources whose bounds are broadcast, those of most documents.
BOUNDED = 1000
#: Hexadecimal digits of the digest that a document's draw is made of.
DIGITS = 13


def draw(doc_id: Column, seed: str = "") -> Column:
    """A number above 0 and up to 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (number + 1) / float(16**DIGITS)


def _key(doc_id: Column, quality: Column | None, seed: str) -> Column:
    """The exponential key of a document; the smaller, the sooner it is taken."""
    weight = F.coalesce(F.lit(1.0) if quality is None else quality.cast("double"), F.lit(1.0))
    return -F.log(draw(doc_id, seed)) / weight


def _epochs() -> Column:
    """How often all documents of a source are taken, by its target."""
    return F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")


def source_targets(sources: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target`` to a table of one row per ``source`` and its ``source_size``.

    Sources in their order, null last, get the weights in turn. Targets share the wanted words by weight;
    one that would exceed ``epochs`` times its source stops there and the excess goes to the others by
    weight, until none exceeds. That fixed point follows from one sort: the smaller the most a source can
    give for each unit of weight, the sooner it stops. Both windows see one narrow row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("_weight", weight.cast("long")).withColumn("_most", F.col("source_size") * epochs)
    by_most = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, everything = by_most.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    summed = ranked.select(
        "*",
        F.coalesce(F.sum("_most").over(before), F.lit(0)).alias("_most_before"),
        F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_weight_before"),
        F.sum("_weight").over(everything).alias("_weights"),
        (F.sum("source_size").over(everything) * share).alias("_words"),
    )
    unit = (F.col("_words") - F.col("_most_before")) / (F.col("_weights") - F.col("_weight_before"))
    stops = unit * F.col("_weight") > F.col("_most")
    tried = summed.withColumn("_unit", unit).withColumn("_stops", stops)
    level = F.min(F.when(~F.col("_stops"), F.struct("_most_before", "_unit"))).over(everything)["_unit"]
    target = F.when(F.col("_stops"), F.col("_most").cast("double")).otherwise(F.least(F.col("_most").cast("double"), level * F.col("_weight")))
    return tried.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    quality: Column | None = None,
    size: Column | None = None,
    seed: str = "",
    doc_id: str = "doc_id",
    source: str = "source",
    cells: int = CELLS,
) -> DataFrame:
    """Adds to each row ``size``, ``source_size``, ``target`` of its source, ``copies`` and ``taken`` words.

    ``size`` is the text's number of words unless given, ``quality`` a weight above 0, otherwise 1. Whole
    documents are taken: the one at the end of the budget is in if its middle is. Equal keys go by id, then
    by size; of repeated rows it doesn't matter which is taken. A null source is a source of its own, a
    null id draws like any other, null and empty texts have size 0 and nothing taken, and an empty table
    gives no rows. Columns of the input that have one of the new names are replaced.
    """
    size = n_words(F.col("text")) if size is None else size
    key = _key(F.col(doc_id), quality, seed)
    # 1 - exp(-key) grows with the key and lies in [0, 1)
    cell = F.least(F.floor((1 - F.exp(-F.col("_key"))) * cells), F.lit(cells - 1)).cast("int")
    rows = docs.select(
        whole_row(docs).alias("_row"), F.col(doc_id).alias("_id"), F.col(source).alias("_name"), size.cast("long").alias("size"), key.alias("_key")
    ).withColumn("_cell", cell)

    sums = rows.groupBy(F.col("_name").alias("_source"), F.col("_cell").alias("_at")).agg(F.sum("size").alias("_words"))
    sources = sums.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sources).select(F.col("source").alias("_target_of"), "source_size", "target")
    earlier = Window.partitionBy("_source").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_source", "_at", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(targets, F.col("_source").eqNullSafe(F.col("_target_of"))).drop("_target_of")

    within = Window.partitionBy("_name", "_cell").orderBy("_key", "_id", "size")
    rows = rows.withColumn("_before", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    same = F.col("_name").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_at"))
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    middle = F.col("_start") + F.col("_before") + F.col("size") / 2
    chosen = rows.join(starts, same).withColumn("_epochs", _epochs())
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("_epochs") + (middle <= rest).cast("int"))
    new = ("size", "source_size", "target", "copies", "taken")
    mixed = chosen.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return mixed.select(*from_row(docs, new), *new)


def with_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, Column]:
    """The documents with one more column, and the quality weight that it holds."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    quality = label_quality(labels).withColumnRenamed("_quality", name)
    return docs.join(quality, docs[doc_id] == quality["_labelled"], "left").drop(quality["_labelled"]), F.col(name)


def label_quality(labels: DataFrame) -> DataFrame:
    """One row per labelled id: weight 2 for good, 1/2 for bad; the best of repeated labels holds."""
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return good.select(F.col("doc_id").alias("_labelled"), F.when(F.col("q") > 0, GOOD).otherwise(BAD).alias("_quality"))


def _bounds(groups: DataFrame) -> DataFrame:
    """One row per source with words: its epochs, the largest key that is taken once more and the smallest that is not.

    Only the sources of most documents are listed, so the table may be broadcast whatever the input.
    """
    sized = groups.filter("_group.c > 0")
    once_more = F.col("_least") + (F.col("_more") > 0).cast("int") > F.col("_epochs")
    left_out = F.col("_least") == F.col("_epochs")
    bounds = sized.groupBy(F.col("_group.b").alias("_source")).agg(
        F.max("_epochs").alias("_epochs"), F.max(F.when(once_more, F.col("_key"))).alias("_last_in"), F.min(F.when(left_out, F.col("_key"))).alias("_first_out"), F.sum("_rows").alias("_docs")
    )
    return bounds.orderBy(F.desc("_docs"), "_source").limit(BOUNDED).drop("_docs")


def mixed_rows(docs: DataFrame, labels: DataFrame, seed: str = "", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents as often as the mix takes them: a document taken twice is there twice, with all its columns.

    What is mixed are ids, sources and sizes. Rows that agree in these are one group with one number of
    copies, or, at the end of a budget, with one more for some of them, in the order of their texts. A row
    that its source takes alike with the best and the worst quality is copied where it is. The other
    rows are shuffled once, to meet their group; a large group is cut into pieces. Nulls, repeated rows,
    empty texts and empty tables are as in :func:`mix`.
    """
    key = F.struct(F.col("_id").alias("a"), F.col("_name").alias("b"), n_words(F.col("_text")).alias("c"))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("_n"))
    rows, quality = with_quality(narrow, labels)
    taken = mix(rows, quality, F.col("_n"), seed).withColumn("_group", F.struct(F.col("doc_id").alias("a"), F.col("source").alias("b"), F.col("size").alias("c")))
    taken = taken.withColumns({"_key": _key(F.col("doc_id"), quality, seed), "_epochs": _epochs()})
    groups = taken.groupBy("_group").agg(
        F.count("*").alias("_rows"), F.min("copies").alias("_least"), F.sum("copies").alias("_sum"), F.max("_key").alias("_key"), F.max("_epochs").alias("_epochs")
    )
    groups = stored(groups.withColumn("_more", F.col("_sum") - F.col("_least") * F.col("_rows")), "copies")
    bounds = _bounds(groups)
    whole = docs.select(whole_row(docs).alias("_row"), F.col(doc_id).alias("_id"), F.col(source).alias("_name"), F.col(text).alias("_text"))
    known = whole.join(F.broadcast(bounds), F.col("_name").eqNullSafe(F.col("_source")), "left")
    worst, best = (_key(F.col("_id"), F.lit(x), seed) for x in (BAD, GOOD))
    surely_in = F.col("_first_out").isNull() | (worst < F.col("_first_out"))
    surely_out = F.col("_last_in").isNull() | (best > F.col("_last_in"))
    # no copies are known of a source that is not listed
    copies = F.when(~F.coalesce(F.col("_text").rlike(WORD), F.lit(False)), 0).when(surely_in, F.col("_epochs") + 1).when(surely_out, F.col("_epochs"))
    known = known.withColumn("_copies", F.when(F.col("_epochs").isNotNull(), copies))
    sure = known.filter("_copies IS NOT NULL").select("_row", "_copies")
    unsure = known.filter("_copies IS NULL").select("_row", key.alias("_group"), "_text")
    groups = groups.filter("_sum > 0").drop("_sum", "_key", "_epochs")
    found = spread_join(unsure, groups, "_group", "_rows", F.xxhash64(F.col("_row")))
    alike = found.filter("_more = 0").select("_row", F.col("_least").alias("_copies"))
    order = Window.partitionBy("_group").orderBy(F.xxhash64("_text"), "_text")
    some = found.filter("_more > 0").withColumn("_nth", F.row_number().over(order))
    apart = some.select("_row", (F.col("_least") + (F.col("_nth") <= F.col("_more")).cast("int")).alias("_copies"))
    every = sure.unionByName(alike).unionByName(apart)
    return every.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))).select(*from_row(docs))
