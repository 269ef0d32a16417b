"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, language, mixing, ngram_join, packing
from millrace.llm.queries import WORD_VOCABULARY
from millrace.llm.shared import discard_unread, scratch_mark, stored, table, written_since

#: SQL can't express a trained language model or a packing.
ORACLE_SQL = None

#: Documents are near copies when their sets of five words running have four fifths of their union in common.
NEAR_WORDS, NEAR = 5, (4, 5)
#: Words that a packing worker remembers, fewer than alone: it shares its executor with what the stages before left.
PACKED_WORDS = 60_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those that are undetermined go."""
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.detect(docs, model).filter(F.col("lang_pred") != language.UNDETERMINED).drop("lang_pred", "score")


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.without_copies(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similar ones link, the one with the smallest id."""
    return ngram_join.one_of_each(docs, NEAR_WORDS, NEAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a document taken twice is there twice."""
    return mixing.mixed_rows(docs, table(spark, sf_dir, "labels"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY), remembered=PACKED_WORDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch folders of stages that ran; what the next stage doesn't read any more goes.
_left: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """A stage that first discards what the stages before it left in the shared folder, as their rows are
    written by then; a frame that still reads it keeps it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _left[:] = discard_unread(spark, _left, docs)
        mark = scratch_mark()
        found = stage(spark, docs, sf_dir)
        _left.extend(written_since(mark))
        return found

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language ID", _tidy(known_language)),
    ("exact dedup", _tidy(no_copies)),
    ("n-gram Jaccard join", _tidy(one_of_similar)),
    ("mixing sources to target weights", _tidy(mixed)),
    ("best-fit packing", _tidy(packed)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
