"""Similar documents by a prefix join of their word n-grams, in groups.

A document is the set of its distinct shingles, as 64-bit digests. All sets are ordered alike, shingles of
many documents last. Two sets that are similar enough share a shingle within a short prefix of this order,
and so many of their prefixes that counting them rules most other pairs out:

1. Documents with the same set are one class, classes with the same prefix and size are one group.
2. Groups that share a shingle in their prefixes, in places and sizes that allow the similarity, are pairs.
   Pairs are checked by the shingles common to the prefixes, and their first members by their whole sets.
   Within a group all members are verified against the first.
3. Pairs of groups are expanded into those pairs of members that these links leave apart, and verified. Groups
   share prefixes only: that their first members differ elsewhere says nothing of the others.
4. A shingle of many groups doesn't make all of their pairs: each is held against a few pivots, as often as
   that spares work; then what is still outside the largest part there is held against the others.

All links that could change a component are verified, so components are exact. Links between documents of
one component are not all listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components, joined
from millrace.llm.shared import FEW, from_row, in_slices, map_arrow, split_join, stored, strings, whole_row

WORDS = 3
#: Least similarity as a fraction of whole numbers.
SIMILAR = (9, 10)
#: Groups that share a shingle are all paired up to this number, and held against pivots beyond.
DENSE = 32
PIVOTS = 4
#: Most rounds of pivots: after the first only what is outside the largest part of its shingle asks. They end when
#: a task could make the pairs that are left, or when a round spared less than a quarter of them.
ROUNDS = 8
#: Bits of the digest by which shingles are counted.
COUNTED_BITS = 22
#: Bits of a set's sketch: each tells whether an odd number of its shingles falls there.
SKETCH_BITS = 512
#: Pairs of a crowded shingle that one task makes.
PAIRS_AT_ONCE = 1_000_000
#: Bits of the filter that keeps texts in question, and bytes of a text that are digested at once.
FILTER_BITS, PORTION = 23, 1 << 16

SETS = "doc_id long, n_shingles long, digest binary, prefix array<long>, sketch array<long>"

_SHIFT = np.uint64(33)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
_GAPS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX[3]
    return x ^ (x >> _SHIFT)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX[0])
_WEIGHTS = _powers(int(_MIX[1]), PORTION)
_BACK = _powers(pow(int(_MIX[1]), -1, 1 << 64), PORTION)


def word_digests(text: bytes) -> np.ndarray:
    """A 64-bit digest of each word: its letters weighed by their places and added up, then mixed.

    Sums run on over a portion of the text; a word's is the difference of two, weighed back to its start.
    """
    letters = np.frombuffer(text, np.uint8)
    gap = np.ones(len(letters) + 2, dtype=np.int8)
    gap[1:-1] = _GAPS[letters]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        upto = int(np.searchsorted(ends, first + PORTION, side="right"))
        if upto == at:  # a word longer than a portion
            out[at] = xxhash.xxh3_64_intdigest(text[first : ends[at]])
            at += 1
            continue
        part = _LETTERS[letters[first : ends[upto - 1]]]
        part *= _WEIGHTS[: len(part)]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part)])
        begin, end = starts[at:upto] - first, ends[at:upto] - first
        out[at:upto] = _mixed((sums[end] - sums[begin]) * _BACK[begin] + (end - begin).astype(np.uint64))
        at = upto
    return out


def shingles_of(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingles: A-Z in lower case, words parted by ASCII white space; fewer words make one shingle."""
    digests = word_digests(text.encode("utf-8", "surrogatepass").lower())
    if not len(digests):
        return digests
    size = min(words, len(digests))
    n = len(digests) - size + 1
    mixed = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        mixed = _mixed(mixed) + digests[i : i + n] * _MIX[i % 3]
    found = np.sort(_mixed(mixed))
    new = np.ones(n, dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def needed(n, similar: tuple[int, int] = SIMILAR):
    """Least intersection with a set that isn't larger, for a set of n: the share of n, rounded up."""
    p, q = similar
    return (p * n + q - 1) // q


def _frequent(words: int):
    """Documents to the buckets of shingles that this task met more than once, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTED_BITS, dtype=np.int32)
        low = np.uint64((1 << COUNTED_BITS) - 1)
        for batch in in_slices(batches):
            sets = [shingles_of(x, words) for x in strings(batch.column(0))]
            if sets:
                np.add.at(counts, (np.concatenate(sets) & low).astype(np.int64), 1)
        met = np.flatnonzero(counts > 1)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met], pa.int32())], ["bucket", "n"])

    return run


def _sets(words: int, by_frequency: Broadcast, similar: tuple[int, int]):
    """Documents to the size, digest, prefix and sketch of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = by_frequency.value
        low = np.uint64((1 << COUNTED_BITS) - 1)
        for batch in in_slices(batches):
            sizes, digests, prefixes, sketches = [], [], [], []
            for text in strings(batch.column(1)):
                found = shingles_of(text, words)
                n = len(found)
                size = n - needed(n, similar) + 1 if n else 0
                order = np.argsort(classes[(found & low).astype(np.int64)], kind="stable")[:size]
                sizes.append(n)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                prefixes.append(found[order].view(np.int64))
                odd = np.bincount(((found >> _SHIFT) % SKETCH_BITS).astype(np.int64), minlength=SKETCH_BITS) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (prefixes, sketches)]
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "digest", "prefix", "sketch"])

    return run


def _whole_sets(words: int):
    """Texts of classes to their sets; a text that isn't the class's gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 128):
            found = []
            for number, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2)), strict=True):
                own = shingles_of(text, words)
                if xxhash.xxh3_128_digest(own.tobytes()) == digest:
                    found.append((number, own.view(np.int64)))
            arrays = [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["class", "shingles"])

    return run


def _overlap(n: Column, m: Column, similar: tuple[int, int]) -> Column:
    """Least intersection of sets of n and m that are similar enough."""
    p, q = similar
    return F.ceil(p * (n + m) / F.lit(p + q)).cast("long")


def _may_match(similar: tuple[int, int]) -> Column:
    """Whether two groups that share a shingle may be similar, by their sizes and its places in them."""
    p, q = similar
    left, right = F.col("n"), F.col("n2")
    after = F.least(left - F.col("pos"), right - F.col("pos2"))
    return (q * F.least(left, right) >= p * F.greatest(left, right)) & (after >= _overlap(left, right, similar))


def _alike(left: str, right: str, similar: tuple[int, int]) -> Column:
    """Whether sets of n and n2 may be similar by two columns with their sketches."""
    differ = sum((F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return differ <= F.col("n") + F.col("n2") - 2 * _overlap(F.col("n"), F.col("n2"), similar)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _classes_by_frequency(rows: DataFrame, words: int) -> np.ndarray:
    """For each bucket of shingles the order of magnitude of its count over all documents, in quarters of a
    power of two; four megabytes whatever the input. Any order gives the same links; frequent shingles last
    give few pairs."""
    met = map_arrow(rows.select("text"), _frequent(words), "bucket int, n int").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = met.select("bucket", (F.log2("n") * 4).cast("tinyint").alias("class")).filter("class > 0").toArrow()
    classes = np.zeros(1 << COUNTED_BITS, dtype=np.int8)
    classes[found["bucket"].to_numpy()] = found["class"].to_numpy()
    return classes


def _maybe(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Adds ``_maybe``: whether a row's id may be among the wanted ``_id``; true for all that are and, by a filter
    of fixed size, few others.

    The filter is a bitmap of digests, a megabyte at most, so it is broadcast; it spares the shuffle of
    texts nobody asks for. What passes is joined with the wanted ids afterwards.
    """
    place = F.pmod(F.xxhash64(F.coalesce(F.col("_of"), F.lit(0))), F.lit(1 << FILTER_BITS))
    bits = wanted.select(F.col("_id").alias("_of")).withColumn("_place", place)
    maps = bits.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    asked = rows.withColumn("_of", F.col(key)).withColumn("_place", place)
    joined = asked.join(F.broadcast(maps), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    position = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    return joined.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias("_maybe"))


def _among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose id may be among the wanted ones."""
    return _maybe(rows, "doc_id", wanted).filter("_maybe").drop("_maybe")


def _attached(pairs: DataFrame, side: str, table: DataFrame, columns: dict[str, str], total: int) -> DataFrame:
    """Pairs with columns of one side's class; a class of very many pairs is cut into pieces.

    Of few pairs the classes are broadcast, so that only what they ask for is shuffled.
    """
    if total <= FEW:
        asked = table.join(F.broadcast(pairs.select(F.col(side).alias("class"))), "class", "left_semi")
        return pairs.join(asked.select(F.col("class").alias(side), *[F.col(x).alias(y) for x, y in columns.items()]), side)
    weights = pairs.groupBy(F.col(side).alias("_of")).agg(F.count("*").alias("_weight"))
    right = weights.join(table, F.col("_of") == F.col("class")).select(F.col("_of").alias(side), "_weight", *[F.col(x).alias(y) for x, y in columns.items()])
    return split_join(pairs, right, side, "_weight", F.col("b" if side == "a" else "a"), total, weights.withColumnRenamed("_of", side)).drop("_weight")


def _likely(pairs: DataFrame, classes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of classes, with their sizes, that their prefixes and sketches allow, and whether both do.

    A class that stands for ``several`` with its prefix keeps what its prefix allows.

    If two sets of n and m, m the larger, share o shingles, all but n - o and m - o of their own are shared;
    so prefixes longer than that by k have k shingles in common. A bit in which their sketches differ takes a
    shingle that only one of them has, and there are n + m - 2 o of those.
    """
    p, q = similar
    total = pairs.count()
    if not total:
        return pairs.selectExpr("a", "b", "0L AS n", "0L AS n2", "true AS alike")
    both = _attached(pairs, "a", classes, {"n": "n", "sketch": "k1", "several": "s1"}, total)
    both = _attached(both, "b", classes, {"n": "n2", "sketch": "k2", "several": "s2"}, total)
    larger = F.greatest("n", "n2")
    both = both.withColumn("alike", _alike("k1", "k2", similar)).filter((F.col("alike") | F.col("s1") | F.col("s2")) & (q * F.least("n", "n2") >= p * larger))
    # few pairs are left, so the longer prefixes are attached to those only
    sketched = stored(both.select("a", "b", "n", "n2", "alike"), "sketched")
    total = sketched.count()
    both = _attached(_attached(sketched, "a", classes, {"prefix": "p1"}, total), "b", classes, {"prefix": "p2"}, total)
    common = _overlap(F.col("n"), F.col("n2"), similar) + 1 - F.ceil(p * larger / F.lit(q)).cast("long")
    both = both.filter(F.size(F.array_intersect("p1", "p2")) >= common)
    return stored(both.select("a", "b", "n", "n2", "alike"), "likely")


def _verified(likely: DataFrame, classes: DataFrame, rows: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs whose whole sets are similar enough. Texts are read again for the classes in question only."""
    p, q = similar
    total = likely.count()
    if not total:
        return likely.select("a", "b")
    wanted = likely.select(F.col("a").alias("class")).unionByName(likely.select(F.col("b").alias("class"))).distinct()
    wanted = stored(classes.join(wanted, "class", "left_semi").select("class", "digest", F.col("least_id").alias("_id")), "wanted")
    texts = _among(rows, wanted).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("class", "digest", "text")
    sets = map_arrow(texts, _whole_sets(words), "class long, shingles array<long>")
    sets = stored(sets.groupBy("class").agg(F.first("shingles").alias("shingles")), "shingles")
    both = _attached(_attached(likely, "a", sets, {"shingles": "s1"}, total), "b", sets, {"shingles": "s2"}, total)
    inner = F.size(F.array_intersect("s1", "s2"))
    return stored(both.filter(q * inner >= p * (F.col("n") + F.col("n2") - inner)).select("a", "b"), "verified")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def similar_components(
    docs: DataFrame,
    words: int = WORDS,
    similar: tuple[int, int] = SIMILAR,
    dense: int = DENSE,
    pivots: int = PIVOTS,
    doc_id: str = "doc_id",
    text: str = "text",
    round_from: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """One row per row: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Two documents are linked when the intersection of their sets is at least ``similar`` of the union. A
    null text, or one without words, has no shingle, is linked with nothing and is its own component; so
    is any document without a link. Repeated rows are in one component like equal texts. A null id is a
    document like others, but never names a component that has another. An empty table gives no rows, other
    columns aren't read. ``doc_id`` must be an integer column. Pivots are drawn anew only where that may spare
    more than ``round_from`` pairs; it changes no result.
    """
    rows = _rows(docs, doc_id, text)
    by_frequency = rows.sparkSession.sparkContext.broadcast(_classes_by_frequency(rows, words))
    sets = stored(map_arrow(rows, _sets(words, by_frequency, similar), SETS), "sets")
    by_frequency.destroy()  # the sets are written
    filled = sets.filter("n_shingles > 0")
    first = filled.groupBy("digest").agg(
        F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_docs")
    )
    signature = F.struct(F.xxhash64("n", "prefix").alias("x"), F.xxhash64("prefix", F.lit("second"), "n").alias("y"))
    numbered = first.withColumns({"signature": signature, "class": F.monotonically_increasing_id()})
    classes = stored(numbered, "classes")  # what is written keeps its numbers

    def links_of(pairs: DataFrame) -> DataFrame:
        return _verified(_likely(stored(pairs, "pairs"), classes.withColumn("several", F.lit(False)), similar), classes, rows, words, similar)

    groups = classes.groupBy("signature").agg(
        F.min("class").alias("lead"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.min_by("sketch", "class").alias("sketch"), F.count("*").alias("n_members")
    )
    groups = stored(groups, "groups")
    large = groups.filter("n_members > 1").select("signature", "lead", "n", "n_members")
    members = split_join(classes.select("signature", F.col("class").alias("member")), large, "signature", "n_members", F.col("member"), classes.count())
    members = stored(members.select("lead", "member", "n"), "members")

    shared = _shared_places(groups)
    crowded = stored(shared.filter(F.col("m") > dense).drop("m"), "crowded")
    sparse = shared.filter(F.col("m") <= dense).drop("m")
    other = sparse.select("shingle", F.col("lead").alias("lead2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"))
    pairs = sparse.join(other, "shingle").filter((F.col("lead") < F.col("lead2")) & _may_match(similar)).select(F.col("lead").alias("a"), F.col("lead2").alias("b"))
    pairs = pairs.distinct().unionByName(_against_pivots(crowded, crowded, pivots, 0, similar))

    # first members of groups against each other, and all members against the first of their group
    leads = groups.select(F.col("lead").alias("class"), "n", "prefix", "sketch", (F.col("n_members") > 1).alias("several"))
    likely = _likely(stored(_ordered(pairs), "pairs"), leads, similar)
    stars = members.filter("lead < member").select(F.col("lead").alias("a"), F.col("member").alias("b"), "n", F.col("n").alias("n2"))
    first_pairs = likely.filter("alike").drop("alike").unionByName(stars)
    links = _verified(stored(first_pairs, "first"), classes, rows, words, similar)
    labels = stored(components(links), "labels")

    # what is still apart: members of groups, and in crowded places
    rest = _across_groups(likely, members, labels).unionByName(_within_groups(members, labels))
    if crowded.count():
        expanded = crowded.join(members.select(F.col("lead").alias("_lead"), "member"), F.col("lead") == F.col("_lead"), "left")
        places = stored(expanded.withColumn("lead", F.coalesce("member", "lead")).select(*crowded.columns), "places")
        before = None
        for seed in range(1, ROUNDS + 1):
            apart = _apart(places, labels)
            outside = apart.filter("label != main")
            spared, made = outside.agg(F.sum("_m"), F.count("*") * 2 * pivots).first()
            spent = (spared or 0) <= max(made, round_from) or (before and 4 * spared > 3 * before)
            if seed == ROUNDS or spent:
                break
            before = spared
            found = links_of(_ordered(_against_pivots(outside, apart, pivots, seed, similar)))
            if not found.count():
                break
            labels = joined(labels, found)
        rest = rest.unionByName(_outside_against_all(apart, classes, similar))
    more = links_of(_ordered(rest))
    if more.count():
        labels = joined(labels, more)
    return _named(sets, classes, labels)


def _shared_places(groups: DataFrame) -> DataFrame:
    """Places of the groups' prefixes whose shingle stands in others too, in m of them."""
    places = groups.select("lead", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "shingle"))
    counts = stored(places.groupBy("shingle").agg(F.count("*").alias("m")).filter("m > 1"), "shingle-counts")
    total = groups.agg(F.sum(F.size("prefix"))).first()[0] or 0
    return stored(split_join(places, counts, "shingle", "m", F.col("lead"), total), "shared")


def _apart(places: DataFrame, labels: DataFrame) -> DataFrame:
    """Places whose shingle stands in several components, with their label, the main one there, and how many places there are."""
    marked = places.join(labels, F.col("lead") == F.col("node"), "left")
    marked = stored(marked.withColumn("label", F.coalesce("label", "lead")).drop("node"), "marked")
    per_label = marked.groupBy("shingle", "label").agg(F.count("*").alias("_n"))
    main = F.max(F.struct("_n", "label"))
    parts = per_label.groupBy("shingle").agg(main["label"].alias("main"), main["_n"].alias("_main"), F.sum("_n").alias("_m"), F.count("*").alias("_parts"))
    parts = stored(parts.filter("_parts > 1").drop("_parts"), "parts")
    apart = split_join(marked, parts, "shingle", "_m", F.col("lead"), marked.count())
    return stored(apart.select("shingle", "lead", "n", "pos", "label", "main", "_main", "_m"), "apart")


def _outside_against_all(apart: DataFrame, classes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs of places of a shingle with different labels whose sketches allow them; a shingle of very many is cut into pieces."""
    asked = classes.select(F.col("class").alias("lead"), "sketch")
    if apart.count() <= FEW:
        asked = asked.join(F.broadcast(apart.select("lead")), "lead", "left_semi")
    apart = stored(apart.join(asked, "lead"), "apart-sketched")
    pieces = F.ceil((F.col("_m") - F.col("_main")) * F.col("_m") / PAIRS_AT_ONCE).cast("int")
    outside = apart.filter("label != main").withColumn("_piece", F.pmod(F.xxhash64("lead"), pieces).cast("int"))
    other = apart.select("shingle", F.col("lead").alias("lead2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("label").alias("label2"),
                         F.col("sketch").alias("sketch2"), (F.col("label") == F.col("main")).alias("in_main2"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece"))
    once = F.col("in_main2") | (F.col("lead") < F.col("lead2"))
    cross = outside.join(other, ["shingle", "_piece"]).filter((F.col("label") != F.col("label2")) & once & _may_match(similar) & _alike("sketch", "sketch2", similar))
    return cross.select(F.col("lead").alias("a"), F.col("lead2").alias("b"))


def _against_pivots(asking: DataFrame, among: DataFrame, pivots: int, seed: int, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of what asks and some of those with the same shingle, drawn alike at every shingle."""
    asking = asking.select("shingle", "lead", "n", "pos")
    draws = [F.xxhash64("lead", F.lit(seed * pivots + i)) for i in range(pivots)]
    least = among.groupBy("shingle").agg(F.count("*").alias("_many"), *[F.min(x).alias(f"_d{i}") for i, x in enumerate(draws)])
    tops = stored(least.select("shingle", "_many", F.array(*[F.col(f"_d{i}") for i in range(pivots)]).alias("_least")), "draws")
    is_pivot = F.exists(F.zip_with("_draws", "_least", lambda x, y: x == y), lambda x: x)
    drawn = among.select("shingle", "lead", "n", "pos", F.array(*draws).alias("_draws"))
    drawn = split_join(drawn, tops, "shingle", "_many", F.col("lead"), among.count()).filter(is_pivot)
    pivot = F.struct(F.col("lead").alias("lead2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"))
    lists = drawn.groupBy("shingle").agg(F.collect_set(pivot).alias("_pivots"))
    asked = asking.groupBy("shingle").agg(F.count("*").alias("_asked"))
    lists = stored(asked.join(lists, "shingle"), "pivots")
    against = split_join(asking, lists, "shingle", "_asked", F.col("lead"), asking.count()).select("*", F.explode("_pivots").alias("_p"))
    against = against.select("lead", "n", "pos", "_p.*").filter((F.col("lead") != F.col("lead2")) & _may_match(similar))
    return against.select(F.col("lead").alias("a"), F.col("lead2").alias("b"))


def _across_groups(likely: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of members of two likely groups, one of several members, whose components differ.

    Groups are joined by their components first, so members that are connected already make no pairs.
    """
    several = members.select("lead").distinct()
    touching = likely.join(several, F.col("a") == F.col("lead"), "left_semi").unionByName(likely.join(several, F.col("b") == F.col("lead"), "left_semi"))
    touching = stored(touching.select("a", "b").distinct(), "touching")
    single = touching.select(F.col("a").alias("lead")).unionByName(touching.select(F.col("b").alias("lead"))).distinct()
    single = single.join(several, "lead", "left_anti").withColumn("member", F.col("lead"))
    tags = single.unionByName(members.select("lead", "member")).join(labels, F.col("member") == F.col("node"), "left")
    tags = stored(tags.select("lead", "member", F.coalesce("label", "member").alias("label")), "tags")
    parts = tags.select("lead", "label").distinct()
    apart = touching.join(parts.select(F.col("lead").alias("a"), F.col("label").alias("x")), "a")
    apart = apart.join(parts.select(F.col("lead").alias("b"), F.col("label").alias("y")), "b").filter("x != y")
    wide = apart.join(tags.select(F.col("lead").alias("a"), F.col("label").alias("x"), F.col("member").alias("m1")), ["a", "x"])
    wide = wide.join(tags.select(F.col("lead").alias("b"), F.col("label").alias("y"), F.col("member").alias("m2")), ["b", "y"])
    return wide.filter("m1 != a OR m2 != b").select(F.col("m1").alias("a"), F.col("m2").alias("b"))


def _within_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of members of one group that are still apart: what is outside its largest part against the others."""
    marked = members.join(labels, F.col("member") == F.col("node"), "left")
    marked = stored(marked.select("lead", "member", F.coalesce("label", "member").alias("label")), "marked-members")
    sizes = marked.groupBy("lead", "label").agg(F.count("*").alias("_n"))
    main = sizes.groupBy("lead").agg(F.max(F.struct("_n", "label"))["label"].alias("main"), F.sum("_n").alias("_m"), F.count("*").alias("_parts"))
    apart = stored(split_join(marked, main.filter("_parts > 1"), "lead", "_m", F.col("member"), marked.count()), "apart-in-groups")
    other = apart.select("lead", F.col("member").alias("member2"), F.col("label").alias("label2"))
    cross = apart.filter("label != main").join(other, "lead").filter("label != label2")
    return cross.select(F.col("member").alias("a"), F.col("member2").alias("b"))


def _named(sets: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with the smallest id of their component."""
    marked = classes.select("class", "digest", "least_id", "n_docs").join(labels, F.col("class") == F.col("node"), "left")
    marked = stored(marked.select("digest", "least_id", "n_docs", "label"), "labelled")
    linked = marked.filter("label IS NOT NULL").withColumnRenamed("label", "_label")
    names = linked.groupBy("_label").agg(F.min("least_id").alias("_name"), F.count("*").alias("_classes"))
    linked = split_join(linked, names, "_label", "_classes", F.col("digest"), linked.count())
    named = linked.select("digest", "n_docs", "_name").unionByName(marked.filter("label IS NULL").select("digest", "n_docs", F.col("least_id").alias("_name")))
    filled = split_join(sets.filter("n_shingles > 0").drop("prefix", "sketch"), named, "digest", "n_docs", F.col("doc_id"), sets.count(), marked.select("digest", "n_docs"))
    empty = sets.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.select("doc_id", "n_shingles", F.col("_name").alias("component_id")).unionByName(empty)


def one_of_each(docs: DataFrame, words: int = WORDS, similar: tuple[int, int] = SIMILAR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that name their component, with all their columns; rows with the same id stay together.

    Those that go are fewer than those that stay, so only rows that may go are shuffled, to meet the ids that do.
    """
    found = similar_components(docs, words, similar, doc_id=doc_id, text=text)
    names = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    going = stored(found.groupBy("doc_id").agg(names.alias("_stays")).filter("NOT _stays").select(F.col("doc_id").alias("_id")), "going")
    rows = _maybe(docs.select(whole_row(docs).alias("_row"), F.col(doc_id).cast("long").alias("_own")), "_own", going)
    asked = rows.filter("_maybe").join(going, F.col("_own").eqNullSafe(F.col("_id")), "left_anti")
    return rows.filter("NOT _maybe").unionByName(asked).select(*from_row(docs))
