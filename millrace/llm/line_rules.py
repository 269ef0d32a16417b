"""Quality rules that clean line by line and then look at what is left.

Each line is held against rules on punctuation, navigation and boilerplate. Lines that fail go; a document
that loses too large a part of its text goes as a whole, and so does one that fails the base rules on
length and repetition. All of it is column expressions: one pass, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import GAP, WORD, from_row, whole_row

#: Base rules: fewest words, and the largest percentage of words in repeated windows of eight.
LEAST_WORDS, MOST_REPEATED = 20, 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: A line of so many words needs the end of a sentence somewhere.
SENTENCE_WORDS = 8
#: One mark of a kind for so many words, at least MARKS of them, is too much.
WORDS_A_MARK, MARKS = 5, 3
#: Largest percentage of the characters in words that a document may lose.
MOST_LOST = 30
#: Lines with one of these, in any case, are boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "terms of service",
    "terms of use",
    "use of cookies",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _marks(line: Column, pattern: str) -> Column:
    return F.length(line) - F.length(F.regexp_replace(line, pattern, ""))


def line_fails(line: Column) -> Column:
    """True for a line that a rule removes; an empty one stays."""
    words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1

    def many(pattern: str) -> Column:
        return let(_marks(line, pattern), lambda n: (n >= MARKS) & (n * WORDS_A_MARK > words))

    unfinished = (words >= SENTENCE_WORDS) & ~line.rlike(r"[.!?…。！？]")
    crowded = line.rlike(r"[#*$%&<>!|»›•]") & (many("[#*$%&<>]") | many("!") | many("[|»›•]"))
    stock = F.lower(line).rlike("|".join(BOILERPLATE))
    return unfinished | crowded | stock


def _pairs(hashes: Column, apart: int) -> Column:
    """Digests of each element and the one so far behind it."""
    return let(
        hashes,
        lambda h: F.zip_with(
            F.slice(h, 1, F.greatest(F.size(h) - apart, F.lit(0))),
            F.slice(h, 1 + apart, F.greatest(F.size(h) - apart, F.lit(0))),
            lambda a, b: F.xxhash64(a, b),
        ),
    )


def repeated_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit digests, and sorted only in texts where two are equal.
    """
    windows = F.transform(words, lambda w: F.xxhash64(w))
    for apart in (1, 2, 4):
        windows = _pairs(windows, apart)

    def covered(places: Column) -> Column:
        n = F.size(places)
        steps = F.zip_with(F.slice(places, 1, n - 1), F.slice(places, 2, n - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step).cast("long")

    def repeated(order: Column) -> Column:
        def same(at: Column, x: Column) -> Column:
            return F.coalesce(F.get(order, at)["h"] == x["h"], F.lit(False))

        found = F.transform(order, lambda x, i: F.when(same(i - 1, x) | same(i + 1, x), x["i"]))
        return let(F.sort_array(F.array_compact(found)), covered)

    def counted(g: Column) -> Column:
        order = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(let(order, repeated))

    return let(windows, counted)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base columns, ``cleaned`` text, ``n_lines_removed``, ``chars_removed`` and ``kept``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed`` look
    at the whole text as it came. A null text counts as empty: it has no words, so it fails. Repeated rows
    are judged each, an empty table gives no rows, and columns named like the results are replaced.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    new += ("cleaned", "n_lines_removed", "chars_removed", "kept")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        def duplicates(x: Column) -> Column:
            return (F.size(x) - F.size(F.array_distinct(x))).cast("long")

        kept = F.filter(lines, lambda x: ~line_fails(x))
        return F.struct(
            let(F.filter(lines, lambda x: x.rlike(WORD)), duplicates).alias("n_dup_lines"),
            F.size(lines).alias("n_lines"),
            let(kept, lambda x: F.struct(F.size(x).alias("n"), F.array_join(x, "\n").alias("text"))).alias("left"),
        )

    def chars(x: Column) -> Column:
        return F.length(F.regexp_replace(x, GAP, "")).cast("long")

    rows = docs.select(
        whole_row(docs).alias("_row"),
        let(words, of_words).alias("_w"),
        let(F.split(whole, "\n"), of_lines).alias("_l"),
        chars(whole).alias("word_chars"),
        _marks(whole, SYMBOLS).cast("long").alias("n_symbols"),
    )
    rows = rows.select(
        "_row",
        "_w.n_words",
        "word_chars",
        "n_symbols",
        "_l.n_dup_lines",
        "_w.n_repeat_words",
        F.col("_l.left.text").alias("cleaned"),
        (F.col("_l.n_lines") - F.col("_l.left.n")).cast("long").alias("n_lines_removed"),
    )
    few = F.col("n_words") < LEAST_WORDS
    rows = rows.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    removed = F.when(F.col("n_lines_removed") == 0, F.lit(0)).otherwise(F.col("word_chars") - chars(F.col("cleaned")))
    rows = rows.withColumn("chars_removed", removed.cast("long"))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (100 * F.col("chars_removed") <= MOST_LOST * F.col("word_chars")))
    return rows.select(*from_row(docs, new), *new)
