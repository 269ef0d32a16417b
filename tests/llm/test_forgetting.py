"""What a worker remembers of words: bounded by its task, and no part of the result."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import language, packing, tokens
from millrace.llm.queries import WORD_VOCABULARY

TEXTS = ["Plain words, ascii AND not: Größe été naïve.", "a\n b", "a \n", "tab\t x  two", "x  y", "x z", "Word word. word, (word)", "", " lead", "trail "]


@pytest.mark.parametrize("name", [WORD_VOCABULARY, "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    path = public_tokenizers.path(name)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, 3)
    for text in TEXTS:
        assert memoryview(encoder.encode(text)).cast("I").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_worker_forgets_words_when_it_finds_languages(spark, monkeypatch):
    model = language.fit(spark.createDataFrame([(1, "the river", "en")], "doc_id long, text string, lang string"))
    ran = []
    monkeypatch.setattr(language.F, "arrow_udf", lambda run, schema: ran.append(run) or (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        language.detect(spark.createDataFrame([(1, "the river")], "doc_id long, text string"), model)
    tokens.encoder(public_tokenizers.path(WORD_VOCABULARY))
    assert tokens.encoder.cache_info().currsize
    list(ran[0](iter([])))
    assert not tokens.encoder.cache_info().currsize


def test_the_pipeline_packs_with_fewer_words_remembered(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(packing, "pack", lambda docs, path, **options: asked.append(options))
    corpus_pipeline.packed(spark, None, "")
    assert asked[0]["remembered"] < tokens.REMEMBERED


def test_packing_is_the_same_whatever_is_remembered(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words " * (i % 9)) for i in range(60)], "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path(WORD_VOCABULARY)
    assert packing.pack(docs, path, remembered=2).collect() == packing.pack(docs, path, remembered=9000).collect()
