"""The registered queries against their SQL or a brute-force version, and the pipeline stage by stage."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import language, mixing, queries
from tests.comparing import compare, database
from tests.llm.test_operators import brute_components, crc

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    equal, report = compare(spark, connection, FOLDER, name)
    assert equal, report


def ids_by_document(documents, vocabulary, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, end] for r in documents}


def test_packing(spark, documents):
    ids = ids_by_document(documents, queries.WORD_VOCABULARY, 0)
    rows = queries.op1_pack(spark, FOLDER).collect()
    wanted = Counter((k, i // 2048, i, len(v[i : i + 2048]), crc(v[i : i + 2048])) for k, v in ids.items() for i in range(0, len(v), 2048))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [at for at, _ in sorted(held)] == ends[:-1] and ends[-1] <= 2048
    assert len(places) <= -(-sum(map(len, ids.values())) // 2048) * 1.02 + 1


def test_language_of_unseen_documents(spark, documents):
    rows = {r.doc_id: r for r in queries.op3_language(spark, FOLDER).collect()}
    assert set(rows) == {r.doc_id for r in documents}
    out = [r for r in documents if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in out} == {k for k, r in rows.items() if r.held_out}
    assert sum(rows[r.doc_id].lang_pred == r.lang for r in out) >= 0.95 * len(out)


def test_edit_counts(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_VOCABULARY))
    rows = {r.doc_id: r for r in queries.op7_edit_counts(spark, FOLDER).collect()}
    assert len(rows) == len(documents)
    for doc in documents:
        after, n = re.subn(queries.PERSONAL, "<redacted>", doc.text, flags=re.ASCII)
        r = rows[doc.doc_id]
        counts = [len(tokenizer.encode(x, add_special_tokens=False).ids) for x in (doc.text, after)]
        assert (r.n_tokens, r.n_edits, r.n_tokens_after) == (counts[0], n, counts[1])


def test_token_files(spark, documents):
    ids = ids_by_document(documents, queries.BYTE_VOCABULARY, 2)
    wanted, at = {}, 0
    for doc in sorted(ids):
        wanted[doc] = (at, len(ids[doc]), crc(ids[doc]))
        at += len(ids[doc])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op8_token_files(spark, FOLDER).collect()} == wanted


def test_similar_documents(spark, documents):
    rows = queries.op9_ngram_join(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components([(r.doc_id, r.text) for r in documents])


def test_pipeline_stage_by_stage(spark, documents):
    names = ["language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.createDataFrame([*documents, (-1, None, "en", "src0", 0), (-2, "123 !", None, None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)

    found = stages[names[0]](spark, docs, FOLDER)
    assert found.columns == columns
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in documents}

    found = stages[names[1]](spark, found, FOLDER)
    assert found.columns == columns
    largest = {}
    for r in documents:
        largest[r.text] = max(largest.get(r.text, r.doc_id), r.doc_id)
    assert {r.doc_id for r in found.collect()} == set(largest.values())

    rows = [(r.doc_id, r.text) for r in found.collect()]
    found = stages[names[2]](spark, found, FOLDER)
    assert found.columns == columns
    assert {r.doc_id for r in found.collect()} == {component for _, _, component in brute_components(rows, 5, 80)}

    before = found.collect()
    mixed = stages[names[3]](spark, found, FOLDER)
    assert mixed.columns == columns
    rows, quality = mixing.with_quality(found, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    wanted = Counter({tuple(r[:5]): r.copies for r in mixing.mix(rows, quality).select(*columns, "copies").collect() if r.copies})
    after = mixed.collect()
    assert Counter(map(tuple, after)) == wanted and set(map(tuple, before)) >= set(wanted)
    share = sum(len((r.text or "").split()) for r in after) / sum(len((r.text or "").split()) for r in before)
    assert abs(share - mixing.SHARE) < 0.05

    ids = ids_by_document(after, queries.WORD_VOCABULARY, 0)
    packed = stages[names[4]](spark, mixed, FOLDER).collect()
    times = Counter(r.doc_id for r in after)
    pieces = Counter({(k, i // 2048, i, len(v[i : i + 2048]), crc(v[i : i + 2048])): times[k] for k, v in ids.items() for i in range(0, len(v), 2048)})
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    filled = Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048


def near_copies(rows, k=5, share=0.8):
    """The smallest id of each component of documents linked by their k-word shingles."""
    grams = []
    for _, text in rows:
        words = text.split()
        grams.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
    label = [doc for doc, _ in rows]
    for i, a in enumerate(grams):
        for j in range(i):
            if len(a & grams[j]) >= share * len(a | grams[j]):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return set(label)


def test_pipeline_takes_one_of_near_copies(spark):
    rng = np.random.default_rng(5)
    rows = []
    for base in range(10):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 100)]
        for changed in range(5):  # 2 apart: 86 of 106 shingles of 5 words in common, 92 of 104 of 3
            copy = list(words)
            for at in rng.choice(np.arange(6, 94, 6), changed, replace=False):
                copy[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((1000 - 10 * base - changed, " ".join(copy)))
    words = [f"v{x}" for x in range(100)]
    rows += [(2000, " ".join(words)), (2001, " ".join([*words[:30], "x", *words[31:60], "y", *words[61:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.one_of_similar(spark, docs, FOLDER).collect()}
    assert kept == near_copies(rows)
    assert 2001 not in kept


def test_language_equals_brute_force(spark, documents):
    """Scores worked out from plain counts of all training documents."""
    letters = regex.compile(r"\p{L}+")
    train = [r for r in documents if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    languages = sorted({r.lang for r in train})
    words = {x: Counter(w for r in train if r.lang == x for w in letters.findall(r.text.lower())) for x in languages}
    grams = {x: defaultdict(Counter) for x in languages}
    for x, held in words.items():
        for word, n in held.items():
            marked = f"\x02{word}\x03"
            for size in language.GRAMS:
                for at in range(len(marked) - size + 1):
                    grams[x][size][marked[at : at + size]] += n
    assert max(map(len, words.values())) <= language.KEPT  # so that nothing is left out

    def shares(counts):
        known = set().union(*counts.values())
        return known, {x: {k: np.log((c[k] + 0.5) / (sum(c.values()) + 0.5 * len(known))) for k in known} for x, c in counts.items()}

    known, by_word = shares(words)
    by_gram = {size: shares({x: grams[x][size] for x in languages}) for size in language.GRAMS}

    def score(text):
        found = letters.findall((text or "").lower())
        if not found:
            return "und", 0.0
        total = {x: np.log(sum(r.lang == x for r in train) / len(train)) for x in languages}
        for word in found:
            if word in known:
                for x in languages:
                    total[x] += by_word[x][word]
                continue
            marked = f"\x02{word}\x03"
            for size in language.GRAMS:
                parts = [marked[at : at + size] for at in range(len(marked) - size + 1)]
                parts = [p for p in parts if p in by_gram[size][0]]
                if parts:
                    for x in languages:
                        total[x] += np.mean([by_gram[size][1][x][p] for p in parts])
                    break
        best = max(languages, key=lambda x: total[x])
        return best, 1 / sum(np.exp(total[x] - total[best]) for x in languages)

    rows = {r.doc_id: r for r in queries.op3_language(spark, FOLDER).collect()}
    for r in documents:
        name, share = score(r.text)
        assert rows[r.doc_id].lang_pred == name and abs(rows[r.doc_id].score - share) < 1e-6


def test_numbers_are_no_letters(spark):
    odd = [(1, "² ½ 12"), (2, "Ⅷ"), (3, "ª"), (4, "the ² house"), (5, "٣")]
    model = language.fit(spark.createDataFrame([(9, "the house and the garden", "en")], "doc_id long, text string, lang string"))
    found = {r.doc_id: r.lang_pred for r in language.detect(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert found == {1: "und", 2: "und", 3: "en", 4: "en", 5: "und"}
