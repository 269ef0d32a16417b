"""Small tables with every odd row: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size int, target string, kept string, n_words int, _row string, _id string, _text string, _key int, label string, digest string, `a.b` int"
)
LONG = "Ein sehr langer Satz mit vielen verschiedenen Teilen %d. "


def rows() -> list[tuple]:
    prose = "The quick brown fox jumps over the lazy dog near the river bank and sleeps there. " * 2
    texts = [
        (1, prose + "One more line.", "en", "a"),
        (2, prose + "One more line.", "en", "a"),
        (2, prose + "One more line.", "en", "a"),
        (3, "", "en", "a"),
        (4, None, "en", None),
        (5, None, None, None),
        (6, "".join(LONG % i for i in range(4000)), "de", "b"),
        (7, "kurz", "de", "b"),
        (7, "kurz", "de", "b"),
        (8, " \n\t ", None, "b"),
        (9, "12345 !!! ###", "en", ""),
        (10, "Zwei\nZeilen\nZeilen\n\n", "de", ""),
        (11, prose + "Another line at last.", "en", "c"),
        (None, "no id at all", "en", "c"),
        (None, "no id at all", "en", "c"),
        (12, "é " * 30 + "\x1c a  b", "fr", "c"),
    ]
    return [(i, t, x, s, None if t is None else len(t), 5, "t", "k", 3, "r", "i", "x", 9, "l", "d", 1) for i, t, x, s in texts]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def pairs(spark: SparkSession) -> list[tuple]:
    """(doc_id, text) of the odd rows."""
    return [(r[0], r[1]) for r in rows()]
