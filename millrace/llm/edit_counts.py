"""Token counts that follow edits without encoding whole texts again.

A document is cut where the ids of both sides don't depend on each other. The pieces are the leaves of a
segment tree: each node knows the characters and tokens below it. An edit walks down by characters to the
leaves it touches; those and one leaf of context on each side are cut and encoded again, and sums change
only on the way up to the root. A document's text and its edits meet in one row, so rows are independent.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import from_row, in_slices, map_arrow, named
from millrace.llm.tokens import Encoder, encoder, segments

#: Pieces in a leaf when a tree is built.
LEAF = 16

#: What is kept of a document's tree.
TREE = "struct<chars:array<int>,tokens:array<int>>"
EDITS = "array<struct<start:long,end:long,replacement:string>>"


class CountTree:
    """Characters and tokens of a text, in a binary tree over leaves of a few pieces each."""

    def __init__(self, coder: Encoder, text: str, leaf: int = LEAF):
        self.coder, self.leaf = coder, leaf
        self._build(text)

    def _build(self, text: str) -> None:
        pieces = segments(text)
        self.reencoded = 0
        self.n_pieces = len(pieces)
        leaves = [pieces[i : i + self.leaf] for i in range(0, len(pieces), self.leaf)] or [[]]
        self.width = 1 << (len(leaves) - 1).bit_length()
        self.texts = ["".join(x) for x in leaves] + [""] * (self.width - len(leaves))
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, x in enumerate(leaves):
            self.chars[self.width + i] = len(self.texts[i])
            self.tokens[self.width + i] = self._count(x)
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    @classmethod
    def stored(cls, coder: Encoder, text: str, chars: list[int], tokens: list[int], leaf: int = LEAF) -> CountTree:
        """A tree from what was kept of its leaves; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.coder, tree.leaf, tree.reencoded, tree.n_pieces = coder, leaf, 0, 0
        tree.width = 1 << (max(len(chars), 1) - 1).bit_length()
        spare = [0] * (tree.width - len(chars))
        tree.chars, tree.tokens = [0] * tree.width + chars + spare, [0] * tree.width + tokens + spare
        ends = list(accumulate(chars))
        tree.texts = [text[end - n : end] for end, n in zip(ends, chars, strict=True)] + [""] * len(spare)
        for node in range(tree.width - 1, 0, -1):
            tree._sum(node)
        return tree

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves, to be kept."""
        return self.chars[self.width :], self.tokens[self.width :]

    def _count(self, pieces: list[str]) -> int:
        if len(pieces) == 1:
            return len(self.coder.encode(pieces[0])) // 4
        known = self.coder.first
        return sum(len(known[x]) for x in pieces) // 4

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and how many stand before that leaf; the last one for the end."""
        node, before = 1, 0
        while node < self.width:
            left = self.chars[2 * node]
            node *= 2
            if at >= before + left and self.chars[node + 1]:
                before += left
                node += 1
        return node - self.width, before

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Puts ``replacement`` in the place of characters ``start`` to ``end``."""
        first, before = self.find(start)
        last, _ = self.find(max(start, end))
        while first > 0:  # one leaf of context, past any that edits have emptied
            first -= 1
            before -= len(self.texts[first])
            if self.texts[first]:
                break
        while last < self.width - 1:
            last += 1
            if self.texts[last]:
                break
        region = "".join(self.texts[first : last + 1])
        region = region[: start - before] + replacement + region[end - before :]
        pieces = segments(region)
        if any(x in region for x in "\x1c\x1d\x1e\x1f") or (len(pieces) == 1 and self.width > 1):
            whole = "".join(self.texts[:first]) + region + "".join(self.texts[last + 1 :])
            done = self.reencoded
            self._build(whole)
            self.reencoded = done + self.n_pieces
            return
        n = last - first + 1
        each = -(-len(pieces) // n)
        for i in range(n):
            own = pieces[i * each : (i + 1) * each]
            self.texts[first + i] = "".join(own)
            self.chars[self.width + first + i] = len(self.texts[first + i])
            self.tokens[self.width + first + i] = self._count(own)
        self.reencoded += len(pieces)
        low, high = (self.width + first) // 2, (self.width + last) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2


def usable_edits(edits: list[dict] | None, n_chars: int) -> list[tuple[int, int, str]]:
    """Edits from the last to the first, so that offsets into the text as it came stay right.

    Offsets are cut to the text; an edit without one of them, or one that begins within the one before it,
    doesn't count; a null replacement deletes.
    """
    known = [x for x in edits or [] if x is not None and x["start"] is not None and x["end"] is not None]
    out: list[tuple[int, int, str]] = []
    reached = 0
    for x in sorted(known, key=lambda x: (x["start"], x["end"], x["replacement"] or "")):
        start, end = min(max(x["start"], 0), n_chars), min(max(x["end"], 0), n_chars)
        if start >= reached and end >= start:
            out.append((start, end, x["replacement"] or ""))
            reached = end
    return out[::-1]


def count_tokens(docs: DataFrame, tokenizer: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """Adds ``n_tokens`` as the text came, ``n_edits``, and after the edits ``n_tokens_after``,
    ``n_chars_after``, ``n_segments`` and ``n_reencoded``, the pieces that were encoded again.

    ``edits`` is a column of start, end and replacement, with offsets in code points of the text as it came.
    A null text counts as empty, null or no edits leave a count as it was, and rows are independent, so
    repeated ones get the same. An empty table gives no rows; columns named like the results are replaced.
    Texts with one of the characters U+001C to U+001F are one piece.
    """
    new = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_segments", "n_reencoded")
    gone = (*new, text, edits)
    kept = F.struct(F.lit(0).alias("_"), *[named(x) for x in docs.columns if x not in gone])
    rows = docs.select(kept.alias("_row"), F.col(text).cast("string").alias("_text"), F.col(edits).cast(EDITS).alias("_edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in in_slices(batches):
            found = []
            for whole, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tree = CountTree(coder, whole or "")
                n_tokens, n_pieces = tree.n_tokens, tree.n_pieces
                todo = usable_edits(changes, tree.n_chars)
                for change in todo:
                    tree.edit(*change)
                found.append((n_tokens, len(todo), tree.n_tokens, tree.n_chars, n_pieces, tree.reencoded))
            columns = [pa.array([x[i] for x in found], pa.int64()) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_row", *new])

    schema = rows.select("_row", *[F.lit(0).cast("long").alias(x) for x in new]).schema
    return map_arrow(rows, run, schema).select(*from_row(docs, gone), *new)


def with_trees(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens`` and ``tree``, the lengths and counts of its leaves, to be stored with the documents.

    A null text counts as empty. Repeated rows get the same, an empty table gives no rows, and columns
    named like the results are replaced.
    """
    new = ("n_tokens", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in in_slices(batches):
            trees = [CountTree(coder, x or "") for x in batch.column(1).to_pylist()]
            yield _with_trees(batch.column(0), [t.n_tokens for t in trees], trees)

    rows = docs.select(F.struct(F.lit(0).alias("_"), *[named(x) for x in docs.columns if x not in new]).alias("_row"), F.col(text).cast("string").alias("_text"))
    schema = rows.select("_row", F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast(TREE).alias("tree")).schema
    return map_arrow(rows, run, schema).select(*from_row(docs, new), *new)


def _with_trees(kept: pa.Array, n_tokens: list[int], trees: list[CountTree], **more: pa.Array) -> pa.RecordBatch:
    leaves = [{"chars": chars, "tokens": tokens} for chars, tokens in (t.leaves() for t in trees)]
    kind = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])
    columns = {"_row": kept, "n_tokens": pa.array(n_tokens, pa.int64()), "tree": pa.array(leaves, kind)} | more
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def edited(docs: DataFrame, tokenizer: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """Documents with their stored trees after ``edits``: the new text, ``n_tokens``, ``tree``, ``n_edits`` and ``n_reencoded``.

    ``docs`` has the columns that :func:`with_trees` adds. Only the leaves that an edit touches, and one on
    each side, are encoded; the result is ready for the next edits. Edits count as in :func:`count_tokens`. A
    null text stays null without edits and is empty with some. A tree that is null, or isn't that of its
    text, is built anew, which counts as encoding all of it. Repeated rows get the same, an empty table
    gives no rows, other columns pass through, but those named like the results, and the edits, go.
    """
    new = ("n_tokens", "tree", "n_edits", "n_reencoded")
    gone = (*new, text, edits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in in_slices(batches):
            trees, texts, n_edits = [], [], []
            for whole, changes, kept in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                plain = whole or ""
                if kept and kept["chars"] is not None and kept["tokens"] is not None and sum(kept["chars"]) == len(plain):
                    tree = CountTree.stored(coder, plain, kept["chars"], kept["tokens"])
                else:
                    tree = CountTree(coder, plain)
                    tree.reencoded = tree.n_pieces
                todo = usable_edits(changes, tree.n_chars)
                for change in todo:
                    tree.edit(*change)
                trees.append(tree)
                texts.append(tree.text() if todo else whole)
                n_edits.append(len(todo))
            more = {"n_edits": pa.array(n_edits, pa.int64()), "n_reencoded": pa.array([t.reencoded for t in trees], pa.int64()), "_text": pa.array(texts, pa.string())}
            yield _with_trees(batch.column(0), [t.n_tokens for t in trees], trees, **more)

    kept = F.struct(F.lit(0).alias("_"), *[named(x) for x in docs.columns if x not in gone])
    rows = docs.select(kept.alias("_row"), F.col(text).cast("string").alias("_text"), F.col(edits).cast(EDITS).alias("_edits"), F.col("tree").cast(TREE).alias("_tree"))
    zero = F.lit(0).cast("long")
    schema = rows.select("_row", zero.alias("n_tokens"), F.col("_tree").alias("tree"), zero.alias("n_edits"), zero.alias("n_reencoded"), "_text").schema
    return map_arrow(rows, run, schema).select(*from_row(docs, gone), F.col("_text").alias(text), *new)


def with_edits(docs: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Adds the edits of a table (doc_id, start, end, replacement) to the documents, as a column ``edits``."""
    kinds = {"start": "long", "end": "long", "replacement": "string"}
    change = F.struct(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])
    name = "_edited"
    while name in docs.columns:
        name += "_"
    lists = edits.groupBy(F.col("doc_id").alias(name)).agg(F.collect_list(change).alias("edits"))
    rows = docs.drop("edits")
    return rows.join(lists, rows[doc_id].eqNullSafe(lists[name]), "left").drop(lists[name])


def replacing(text: Column, pattern: str, replacement: str) -> Column:
    """Edits that put ``replacement`` in the place of every match of a pattern without groups."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, x: F.struct(gap.alias("gap"), F.length(x).cast("long").alias("n")))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(EDITS).alias("edits"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        change = F.struct(start.alias("start"), (start + x["n"]).alias("end"), F.lit(replacement).alias("replacement"))
        return F.struct((start + x["n"]).alias("at"), F.concat(state["edits"], F.array(change)).alias("edits"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, empty, step, lambda state: state["edits"]))
