"""Operators on odd rows and empty tables, each against a brute-force version."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import chat, edit_counts, exact_dedup, graph, language, line_rules, mixing, ngram_join, packing, rans, unit_dedup
from millrace.llm.shared import spread_join
from millrace.session import scratch_path
from tests.llm.rows import documents, nothing, pairs

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# packing


def test_packing_odd_rows(spark):
    ids_of = library(WORD)
    wanted = Counter()
    for doc, text in pairs(spark):
        ids = [*ids_of(text), 0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            wanted[(doc, piece, at, len(ids[at : at + 64]), crc(ids[at : at + 64]))] += 1
    rows = packing.pack(documents(spark), WORD, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(nothing(spark), WORD).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 3000).astype(int) + 1, 2048)
    slots = packing.plan(Counter(lengths.tolist()))
    assert slots.sequences <= -(-int(lengths.sum()) // 2048) * 1.01 + 1


def test_packing_places_every_piece():
    rng = np.random.default_rng(9)
    for size in (0, 1, 2, 50):
        counts = Counter(rng.integers(1, 33, size).tolist())
        slots = packing.plan(counts, 32)
        placed = Counter()
        for at in range(len(slots.length)):
            same = slots.length == slots.length[at]
            later = slots.first[same & (slots.first > slots.first[at])]
            upto = later.min() if later.size else counts[int(slots.length[at])]
            placed[int(slots.length[at])] += int(upto - slots.first[at])
        assert placed == counts


def test_what_the_program_leaves_does_not_grow(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = np.bincount(np.minimum(rng.lognormal(3.5, 1.0, 5000).astype(int) + 1, 256), minlength=257)
    rest, best_fit = [], packing.best_fit
    monkeypatch.setattr(packing, "best_fit", lambda left, capacity: (rest.append(left.copy()), best_fit(left, capacity))[1])
    for times in (1, 100):
        counts = {i: int(n) * times for i, n in enumerate(lengths) if n}
        slots = packing.plan(counts, 256)
        assert all(n * i < 256 for i, n in enumerate(rest[-1].tolist()))
        assert slots.sequences <= -(-sum(i * n for i, n in counts.items()) // 256) * 1.01 + 1


def test_best_configuration_is_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        prices = np.where(rng.random(13) < 0.5, rng.random(13), 0.0)
        prices[0] = 0

        def most(room, prices=prices):
            return max([0.0, *[prices[i] + most(room - i) for i in range(1, room + 1) if prices[i] > 0]])

        counts = packing.best_configuration(prices, 12)
        assert (counts * np.arange(13)).sum() <= 12
        assert abs((counts * prices).sum() - most(12)) < 1e-9


# mixing


def shares(sizes, weights=(5, 2, 1)):
    """Targets by resharing again and again, as one would by hand."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [x for x in names if x not in stopped]
        left = total - sum(stopped.values())
        now = {x: left * weight[x] / sum(weight[y] for y in free) for x in free}
        over = [x for x in free if now[x] > 2 * sizes[x]]
        if not over:
            return stopped | now
        stopped |= {x: 2.0 * sizes[x] for x in over}


def test_whole_rows_are_taken_as_often_as_the_mix_says(spark):
    """Null and repeated ids, equal rows at the end of a budget, clashing names."""
    rng = np.random.default_rng(8)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 30))), "de", f"s{i % 3}", 1) for i in range(90)]
    rows += [(None, "five words in this text", None, "s0", 2)] * 40 + [(3, "a b", None, None, 3)] * 5 + [(4, None, None, "s1", 4), (5, "", None, None, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumns({"_key": F.lit(1), "_copies": F.lit(2), "size": F.lit("x")}).repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 90, 3)], "doc_id long, quality int")
    with_weights, quality = mixing.with_quality(docs, labels)
    wanted = Counter()
    for r in mixing.mix(with_weights, quality).select(*docs.columns[:5], "copies").collect():
        wanted[tuple(r[:5])] += r.copies
    found = mixing.mixed_rows(docs, labels)
    assert found.columns == docs.columns
    assert Counter(tuple(r[:5]) for r in found.collect()) == +wanted
    assert mixing.mixed_rows(docs.limit(0), labels).collect() == []


def test_mixing_odd_rows(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert Counter(rows) == Counter(mixing.mix(docs.repartition(7)).collect())
    sizes = Counter()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.taken == r.size * r.copies <= 2 * r.size
        sizes[r.source] += r.size
    targets = shares(sizes)
    for source, size in sizes.items():
        own = [r for r in rows if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert abs(own[0].target - targets[source]) < 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        if targets[source] >= size:
            assert all(r.taken >= r.size for r in own)  # complete epochs come first
    assert {r["_row"] for r in rows} == {"r"}
    assert mixing.mix(nothing(spark)).collect() == []


def test_mixing_prefers_quality_and_cells_change_nothing(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"), F.when(F.col("id") < 3000, "a").when(F.col("id") < 3500, "b").otherwise("c").alias("source"))
    quality = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    rows = mixing.mix(docs, quality).collect()
    same = mixing.mix(docs, quality, cells=3).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in same}
    extra = [r.doc_id % 2 for r in rows if r.source == "a" and r.copies == 2]
    assert len(extra) and extra.count(0) > 2 * extra.count(1)


# language


def test_language_odd_rows(spark):
    docs = documents(spark)
    model = language.fit(docs)
    assert model.languages == ["de", "en", "fr"]
    rows = language.detect(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or ""))
    assert next(r for r in rows if r.doc_id == 6).lang_pred == "de"
    empty = language.fit(nothing(spark))
    assert {r.lang_pred for r in language.detect(docs, empty).collect()} == {"und"}
    assert language.detect(nothing(spark), model).collect() == []


def test_language_backs_off_to_shorter_parts(spark):
    rows = [(i, f"straßen {i} bahnhof", "de") for i in range(5)] + [(9 + i, "railway station", "en") for i in range(5)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    score = language.Scorer(model)
    assert score("bahnhofs")[0] == "de"
    assert score("railways")[0] == "en"
    assert score("w")[0] == "en"
    assert score("日本")[0] in ("de", "en")


# line rules


def test_line_rules_odd_rows(spark):
    docs = documents(spark)
    rows = line_rules.clean(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(repeated))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert not (r.kept and r.base_failed)
    assert next(r for r in rows if r.doc_id == 6).n_repeat_words > 30_000
    assert line_rules.clean(nothing(spark)).collect() == []


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("Home | About us | Contact | Help", True),
        ("BUY!! NOW!! IT!! IS!! CHEAP!!", True),
        ("a### b$$$ c%%%", True),
        ("eight words in a row without any end", True),
        ("Please read our Privacy Policy.", True),
        ("A plain sentence, with a comma. And another!", False),
        ("short heading", False),
        ("", False),
        ("5 < 6 and a | b, says the text in a long sentence of its own.", False),
    ],
)
def test_line_rules(spark, line, fails):
    frame = spark.createDataFrame([(line,)], "line string")
    assert frame.select(line_rules.line_fails(F.col("line"))).first()[0] is fails


def test_lines_go_and_documents_that_lose_much(spark):
    good = "This is a sentence of ten words that can stay here. " * 3
    other = "Nothing in these other words is wrong so they stay too. " * 3
    rows = [(1, f"Home | News | Sport | More\n{good}\n{other}"), (2, good + "\n" + "A | B | C | D | E | F | G | H\n" * 30)]
    out = {r.doc_id: r for r in line_rules.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].cleaned == f"{good}\n{other}"
    assert out[1].n_lines_removed == 1
    assert not out[2].kept


# lines that repeat


def test_repeated_units_odd_rows(spark):
    for by in ("line", "paragraph"):
        docs = documents(spark)
        rows = unit_dedup.repeated_units(docs, by=by, least_words=1).collect()
        first, wanted = {}, Counter()
        cut = unit_dedup._lines if by == "line" else unit_dedup._paragraphs
        for doc, text in sorted(pairs(spark), key=lambda x: (x[0] is None, x[0] or 0)):
            for number, (at, unit) in enumerate(cut(text or "")):
                norm = unit_dedup.normalised(unit)
                if norm and (place := first.setdefault(norm, (doc, number))) != (doc, number):
                    wanted[(doc, number, at, at + len(unit), *place)] += 1
        assert Counter((r.doc_id, r.unit, r.start_char, r.end_char, r.keep_doc_id, r.keep_unit) for r in rows) == wanted
    assert unit_dedup.repeated_units(nothing(spark)).collect() == []


def test_short_lines_repeat_too(spark):
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(5))
    rows = [(1, passage + "\nBuy now!"), (2, "Own words.\n" + passage), (3, "buy now\n--"), (4, "--")]
    found = unit_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.unit, r.keep_doc_id, r.keep_unit) for r in found} == {(2, i + 1, 1, i) for i in range(5)} | {(3, 0, 1, 5)}


def test_units_are_cut_out(spark):
    rows = [(1, "Same line here.\nOwn one."), (2, "Other.\nsame LINE  here\nlast"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = unit_dedup.repeated_units(docs, least_words=3)
    assert {r.doc_id: r.text for r in unit_dedup.without_units(docs, removed).collect()} == {1: rows[0][1], 2: "Other.\n\nlast", 3: None}


def test_units_are_cut_out_of_their_own_texts_only(spark):
    """Rows that share an id, or have none, keep what was reported of others."""
    twice = "Some line that stands twice.\nand an end"
    rows = [(None, twice), (None, "completely different text that should survive whole"), (7, "x " + twice), (7, twice), (8, ""), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "r", 1, "s") for i, t in rows], "doc_id long, text string, _row string, unit int, _spans string").repartition(3)
    removed = unit_dedup.repeated_units(docs)
    left = Counter((r.doc_id, r.text) for r in unit_dedup.without_units(docs, removed).collect())
    kept = twice.split("\n")
    assert left == Counter({(None, "\n"): 1, (None, rows[1][1]): 1, (7, "x " + kept[0] + "\n"): 1, (7, twice): 1, (8, ""): 1, (9, None): 1, (None, None): 1})
    assert unit_dedup.without_units(docs, removed.limit(0)).count() == 7
    assert unit_dedup.without_units(docs.limit(0), removed).collect() == []


# exact duplicates


def test_exact_groups_odd_rows(spark):
    members = defaultdict(list)
    for doc, text in pairs(spark):
        members[text or ""].append(doc)
    for partitions in ("1", "2", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            rows = exact_dedup.exact_groups(documents(spark)).collect()
            kept = exact_dedup.without_copies(documents(spark)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        wanted = Counter()
        for text, ids in members.items():
            known = [x for x in ids if x is not None]
            for doc in ids:
                wanted[(doc, max(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == wanted
        stays = Counter(r.text_sha256 for r in rows if r.kept)
        assert set(stays.values()) == {1} and len(stays) == len(members)
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)
        assert Counter(r.doc_id for r in rows if r.kept) == Counter(r.doc_id for r in kept)
        assert {r["a.b"] for r in kept} == {1}
    assert exact_dedup.exact_groups(nothing(spark)).collect() == []
    assert exact_dedup.without_copies(nothing(spark)).collect() == []


def test_one_text_over_many_ranges(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).otherwise("hot").alias("text"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = exact_dedup.exact_groups(docs).collect()
        kept = exact_dedup.without_copies(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r for r in rows if r.group_size > 1]
    assert len(hot) == 400 and {(r.keep_id, r.group_size) for r in hot} == {(499, 400)}
    assert sum(r.kept for r in rows) == len(kept) == 101


# edits


def test_counts_follow_edits(spark):
    ids_of = library(BYTE)
    docs = documents(spark).select("doc_id", "text", "n_words", "_row").withColumn("edits", edit_counts.replacing(F.col("text"), r"[0-9]+", "number"))
    rows = edit_counts.count_tokens(docs, BYTE).collect()
    texts = {doc: text or "" for doc, text in pairs(spark)}
    assert len(rows) == docs.count()
    for r in rows:
        text = texts[r.doc_id]
        after, n = re.subn("[0-9]+", "number", text)
        assert (r.n_tokens, r.n_edits, r.n_chars_after, r.n_tokens_after) == (len(ids_of(text)), n, len(after), len(ids_of(after)))
    assert edit_counts.count_tokens(docs.limit(0), BYTE).collect() == []


def test_edit_table_with_odd_edits(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "x"), (None, "ab")], "doc_id long, text string")
    changes = [(1, 0, 3, "1"), (1, 2, 5, "overlaps"), (1, 4, 7, None), (1, None, 3, "?"), (1, 99, 120, " end"), (2, 0, 0, "new"), (None, 1, 1, "-"), (9, 0, 1, "no such")]
    edits = spark.createDataFrame(changes, "doc_id long, start long, end long, replacement string")
    rows = {r.doc_id: r for r in edit_counts.count_tokens(edit_counts.with_edits(docs, edits), BYTE).collect()}
    ids_of = library(BYTE)
    assert {k: (r.n_edits, r.n_tokens_after) for k, r in rows.items()} == {
        1: (3, len(ids_of("1  three end"))),
        2: (1, len(ids_of("new"))),
        3: (0, len(ids_of("x"))),
        None: (1, len(ids_of("a-b"))),
    }


def test_stored_trees_follow_edits(spark):
    """Edits on stored trees give the counts of the new texts, again and again; only what they touch is encoded."""
    ids_of = library(BYTE)
    texts = [(n, " ".join(f"word{i}" for i in range(n))) for n in (0, 1, 1000, 20_000)] + [(None, None), (5, "a\x1cb c"), (6, "")]
    docs = spark.createDataFrame([(i, t, 7, "t") for i, t in texts], "doc_id long, text string, n_edits int, _tree string").repartition(3)
    held = {i: t for i, t in texts}
    kept = edit_counts.with_trees(docs, BYTE)
    rng = np.random.default_rng(1)
    for turn in range(3):
        edits = []
        for i, text in held.items():
            at = int(rng.integers(0, len(text or "") + 1))
            edits.append((i, at, at + 9, f" new {turn}x"))
            held[i] = (text or "")[:at] + f" new {turn}x" + (text or "")[at + 9 :]
        table = spark.createDataFrame(edits, "doc_id long, start long, end long, replacement string")
        kept = edit_counts.edited(edit_counts.with_edits(kept, table), BYTE)
        rows = {r.doc_id: r for r in kept.collect()}
        assert {i: r.text for i, r in rows.items()} == held
        assert {i: r.n_tokens for i, r in rows.items()} == {i: len(ids_of(t)) for i, t in held.items()}
        assert {r.n_edits for r in rows.values()} == {1} and {r._tree for r in rows.values()} == {"t"}
        # two leaves that are touched, one on each side, and the new pieces; the length of the text doesn't matter
        assert max(rows[20_000].n_reencoded, rows[1000].n_reencoded) <= 4 * edit_counts.LEAF + 4 * (turn + 1)
    none = edit_counts.edited(kept.withColumns({"edits": F.lit(None), "tree": F.lit(None)}), BYTE).collect()
    assert {r.doc_id: r.n_tokens for r in none} == {i: len(ids_of(t)) for i, t in held.items()}
    assert edit_counts.with_trees(docs.limit(0), BYTE).collect() == edit_counts.edited(kept.limit(0).withColumn("edits", F.lit(None)), BYTE).collect() == []


def test_edits_of_documents_with_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (None, "b", "y")], "doc_id long, text string, _edited string")
    edits = spark.createDataFrame([(1, 0, 1, "c"), (None, 0, 1, "d")], "doc_id long, start long, end long, replacement string")
    rows = {r.doc_id: (r._edited, r.edits[0].replacement) for r in edit_counts.with_edits(docs, edits).collect()}
    assert rows == {1: ("x", "c"), None: ("y", "d")}


def test_only_touched_pieces_are_encoded_again():
    from millrace.llm.tokens import Encoder

    tree = edit_counts.CountTree(Encoder(BYTE), " ".join(f"word{i}" for i in range(5000)))
    tree.edit(10_000, 10_004, "other")
    assert tree.reencoded <= 4 * edit_counts.LEAF


# token files


def test_token_files_odd_rows(spark):
    ids_of = library(BYTE)
    path = scratch_path(spark, "test")
    rans.write_ids(documents(spark), BYTE, path, lanes=8, block=1000)
    rows = rans.read_ids(spark, path).collect()
    wanted = Counter((doc, len(ids_of(text)) + 1, crc([*ids_of(text), 2])) for doc, text in pairs(spark))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == wanted
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is None, x or 0))
    rans.write_ids(nothing(spark), BYTE, empty := scratch_path(spark, "test"))
    assert rans.read_ids(spark, empty).collect() == []


def test_blocks_by_checkpoint_and_damage():
    rng = np.random.default_rng(2)
    ids = rng.geometric(0.05, 5000)
    table = rans.Table.of(Counter(ids.tolist()))
    payload = rans.encode_block(table, [1], [5000], ids, lanes=16, span=32)
    block = rans.Block.of(payload, table)
    assert len(block.marks) > 5
    for mark in range(len(block.marks)):
        first = block.marks[mark][0] * 16
        part = block.decode_span(table, mark)
        assert (part == ids[first : first + len(part)]).all()
    broken = bytearray(payload)
    broken[200] ^= 1
    with pytest.raises(rans.Damaged):
        rans.Block.of(bytes(broken), table)
    with pytest.raises(rans.Damaged):
        rans.Block.of(payload, rans.Table.of({1: 1}))


# similar documents


def brute_components(rows, k=3, percent=90):
    sets, parent = [], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, text in rows:
        words = [w.decode() for w in (text or "").encode().lower().split()]
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return Counter((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows))


def test_similar_odd_rows(spark):
    rows = ngram_join.similar_components(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components(pairs(spark))
    assert ngram_join.similar_components(nothing(spark)).collect() == []
    kept = ngram_join.one_of_each(documents(spark)).collect()
    assert {r.doc_id for r in kept} == {r.component_id for r in rows}


@pytest.mark.parametrize(("seed", "dense"), [(1, 64), (2, 3)])
def test_similar_near_copies(spark, seed, dense):
    rng = np.random.default_rng(seed)
    rows, common = [], " ".join(f"c{i}" for i in range(12))
    for base in range(12):
        words = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(15, 120)))]
        for _ in range(int(rng.integers(1, 30))):
            copy = list(words)
            for at in rng.integers(0, len(copy), int(rng.integers(0, 3))):
                copy[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((int(rng.integers(0, 10**6)) * 1000 + len(rows), common.upper() + "\n" + " ".join(copy) if base % 3 else " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.similar_components(docs, dense=dense, pivots=2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (259, 300), (300, 259)]
    frame = spark.createDataFrame(links, "a long, b long")
    labels = {r.node: r.label for r in graph.components(frame).collect()}
    assert labels == {i: 100 for i in range(100, 141)} | {7: 7, 300: 7} | {i: 7 for i in range(200, 260)}


def test_spread_join_keeps_every_row(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    assert spread_join(left, right, "k", "n", F.col("id")).count() == 3000


# chat


def test_chat_round_trip(spark):
    texts = [None, "", "\\", "\\l", "<|turn|>", "</s>[INST] ok [/INST]", "a\\\\<|end|>\n<<SYS>>[x] < [", "\n\n", "plain"]
    rows = [(c, t, role, texts[(c or 0) * 3 + t] if (c or 0) * 3 + t < len(texts) else "end") for c in (0, 1, 2, None) for t, role in enumerate(("user", "assistant", None))]
    rows += [(3, 0, "user", "tie"), (3, 0, "assistant", "tie"), (3, 0, "user", "tie"), (3, None, "a\nb", "null turn")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.parsed(chat.formatted(chat.best_paths(chat.as_replies(frame)))).collect()
    wanted = defaultdict(list)
    for conv, turn, role, text in rows:
        wanted[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    assert len(out) == len(wanted)
    for r in out:
        turns = [(x[3], x[5]) for x in sorted(wanted[r.conv_id])]
        assert [(x.role, x.text) for x in r.turns] == turns
        assert r.loss_text == "".join(text for role, text in turns if role == "assistant")
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == len(turns)
        assert not any(x in r.formatted for x in chat.CONTROL if x != "<|")
    assert chat.formatted(chat.best_paths(chat.as_replies(frame.limit(0)))).collect() == []


def test_chat_ranks_branches(spark):
    rows = [
        (1, 1, None, "user", "r", 0.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 3.0),
        (1, 4, 3, "user", "c", 0.0),
        (1, 5, 3, "user", "d", 5.0),
        (1, 6, 99, "user", "no parent", 0.0),
        (1, 7, 8, "x", "circle", 9.0),
        (1, 8, 7, "x", "circle", 9.0),
        (2, 1, None, "user", "alone", None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, msg_id long, parent_id long, role string, text string, score double")
    paths = defaultdict(list)
    for r in sorted(chat.best_paths(frame, 9).collect(), key=lambda r: r.depth):
        paths[(r.conv_id, r.branch)].append(r.text)
    assert dict(paths) == {(1, 1): ["r", "b", "d"], (1, 2): ["r", "b", "c"], (1, 3): ["r", "a"], (1, 4): ["no parent"], (2, 1): ["alone"]}
    assert {r.text for r in chat.best_paths(frame, 1).collect()} == {"r", "b", "d", "alone"}
