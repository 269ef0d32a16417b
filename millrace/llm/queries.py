"""One query for each operator, over its whole table, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, edit_counts, exact_dedup, language, line_rules, mixing, ngram_join, packing, phrase_index, rans, turn_repair, unit_dedup, whitening
from millrace.llm.shared import n_words, table
from millrace.session import scratch_path

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
#: What the edits of op7 black out: e-mail addresses, internet addresses, long numbers, keys.
PERSONAL = r"[\w.+-]+@[\w-]+\.[\w.]+|\d{1,3}(?:\.\d{1,3}){3}|\d{12,}|[0-9a-f]{32,}"

#: Words of the lines that op5_repeated_lines and its SQL ask for.
LONG_LINE = 20


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), remembered=rans.REMEMBERED)


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("_n"))
    rows, quality = mixing.with_quality(docs, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(rows, quality, F.col("_n"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    found = language.detect(docs.select("doc_id", "text"), language.fit(docs.filter(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_rules.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return cleaned.select("doc_id", *base, "kept", "n_lines_removed", "chars_removed")


def op5_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents"), least_words=LONG_LINE).drop("text_digest")


def op5_all_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents")).drop("text_digest")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("edits", edit_counts.replacing(F.col("text"), PERSONAL, "<redacted>"))
    return edit_counts.count_tokens(docs, public_tokenizers.path(BYTE_VOCABULARY))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    rans.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY), path)
    return rans.read_ids(spark, path)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    path = scratch_path(spark, "chat")
    chat.formatted(chat.best_paths(chat.as_replies(talks))).write.parquet(path)
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return chat.parsed(spark.read.parquet(path)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")))
    return turn_repair.verdicts_with_digest(found)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = phrase_index.index_of(table(spark, sf_dir, "documents"))
    found = phrase_index.marked(index, phrase_index.windows_of(table(spark, sf_dir, "benchmark")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_mix": op2_mix,
    "op3_language": op3_language,
    "op4_line_rules": op4_line_rules,
    "op5_repeated_lines": op5_repeated_lines,
    "op5_all_repeated_lines": op5_all_repeated_lines,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_edit_counts": op7_edit_counts,
    "op8_token_files": op8_token_files,
    "op9_ngram_join": op9_ngram_join,
    "op10_chat": op10_chat,
    "op11_whiten": op11_whiten,
    "op12_repair": op12_repair,
    "op13_decontaminate": op13_decontaminate,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_PHRASE_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, bit by bit."""
    eight = "list_reduce([xor(v, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda m, z: xor(m >> 1, CASE WHEN m & 1 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), lambda v, y: {eight}), 4294967295)"


ORACLES: dict[str, str] = {
    "op2_mix": f"""
WITH q AS (
  SELECT doc_id, CASE WHEN max(quality) > 0 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT documents.doc_id, source, len({_WORDS})::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(documents.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 1)::DOUBLE / 4503599627370496.0::DOUBLE)
      / coalesce(weight, 1.0::DOUBLE) AS key
  FROM documents LEFT JOIN q USING (doc_id)
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 2 * source_size AS most,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s
), p AS (
  SELECT *,
    (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER o, 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS unit
  FROM w
  WINDOW o AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, unit * weight > most AS stops,
    arg_min(unit, most::DOUBLE / weight) FILTER (WHERE NOT (unit * weight > most)) OVER () AS level
  FROM p
), g AS (
  SELECT source, source_size, CASE WHEN stops THEN most::DOUBLE ELSE least(most::DOUBLE, level * weight) END AS target FROM t
), r AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target,
  CASE WHEN size = 0 THEN 0
    ELSE size * (epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM r
""",
    "op4_line_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words, row_number() OVER () AS r FROM documents
), n AS (
  SELECT r, unnest(generate_series(1, len(words) - 7)) AS i, words FROM d WHERE len(words) >= 8
), v AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(words, i, i + 7)) AS times FROM n
), c AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT r, unnest(generate_series(i, i + 7)) AS place FROM v WHERE times > 1) GROUP BY r
), l AS (
  SELECT r, line, length(line) - length(replace(line, ' ', '')) + 1 AS w FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
), m AS (
  SELECT *, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars, regexp_matches(line, '[^\x20\x09-\x0D]') AS has_word,
    length(regexp_replace(line, '[^#*$%&<>]', '', 'g')) AS symbols,
    length(regexp_replace(line, '[^!]', '', 'g')) AS shouts,
    length(regexp_replace(line, '[^|»›•]', '', 'g')) AS bars
  FROM l
), f AS (
  SELECT *, (w >= 8 AND NOT regexp_matches(line, '[.!?…。！？]'))
    OR (symbols >= 3 AND symbols * 5 > w) OR (shouts >= 3 AND shouts * 5 > w) OR (bars >= 3 AND bars * 5 > w)
    OR regexp_matches(lower(line), '{"|".join(line_rules.BOILERPLATE)}') AS fails
  FROM m
), a AS (
  SELECT r, count(*) FILTER (WHERE fails) AS n_lines_removed, coalesce(sum(chars) FILTER (WHERE fails), 0) AS chars_removed,
    count(*) FILTER (WHERE has_word) - count(DISTINCT line) FILTER (WHERE has_word) AS n_dup_lines
  FROM f GROUP BY r
), b AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines_removed::BIGINT AS n_lines_removed, chars_removed::BIGINT AS chars_removed
  FROM d JOIN a USING (r) LEFT JOIN c USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * chars_removed <= 30 * word_chars AS kept
FROM b
""",
    "op5_repeated_lines": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1))::INTEGER AS unit
  FROM documents WHERE text IS NOT NULL
), o AS (
  SELECT *, (coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start_char,
    trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm
  FROM l
), k AS (
  SELECT doc_id, unit, start_char, (start_char + length(line))::BIGINT AS end_char, (length(norm) - length(replace(norm, ' ', '')) + 1)::INTEGER AS n_words,
    norm FROM o WHERE norm <> ''
), g AS (
  SELECT *, first_value(doc_id) OVER p AS keep_doc_id, first_value(unit) OVER p AS keep_unit, count(*) OVER (PARTITION BY norm) AS n_copies
  FROM k WHERE n_words >= 20 WINDOW p AS (PARTITION BY norm ORDER BY doc_id NULLS LAST, unit)
)
SELECT doc_id, unit, start_char, end_char, n_words, keep_doc_id, keep_unit, n_copies FROM g
WHERE NOT (doc_id IS NOT DISTINCT FROM keep_doc_id AND unit = keep_unit)
""",
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op10_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), e AS (
  SELECT *, 17 + length(role) + length(text) + length(role || text) - length(replace(replace(role || text, '\', ''), chr(10), ''))
    - (length(text) - length(replace(text, chr(10), '')))
    + len(regexp_extract_all(text, '<\||</?s>|<</?SYS>>|\[/?INST\]')) + len(regexp_extract_all(role, '<\||</?s>|<</?SYS>>|\[/?INST\]')) AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
}
ORACLES["op12_repair"] = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, crc32k % 20 AS fault, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM (
    SELECT *, {CRC} AS crc32k FROM conversations)
), f AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, (SELECT unnest([1, 2]) AS copy) WHERE fault <> 0 AND (copy = 1 OR fault = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS said, left(role, 1) AS x
  FROM f
), d AS (
  SELECT *, said = '' AS blank, said <> '' AND nth > 1 AS dup, said <> '' AND nth = 1 AND NOT regexp_matches(said, '[.!?]$') AS cut,
    coalesce(lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au'), false) AS wrong
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM o)
), t AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE wrong) AS illegal
  FROM d GROUP BY conv_id
), ins(f, e, c, s) AS (
  VALUES (0, '', 0, 0), (0, 'I', 2, 2), (0, 'II', 4, 4), (1, '', 0, 1), (1, 'I', 2, 2), (1, 'II', 4, 4), (2, '', 0, 2), (2, 'I', 2, 4), (4, '', 0, 4), (4, 'I', 2, 2)
), act(s, x, z) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (4, 'u', 2), (2, 'a', 4)
), w AS (
  SELECT f, '' AS x, e || 'D' AS e, c + 3 AS c, s AS z, true AS del FROM ins
  UNION ALL SELECT f, x, e || 'K', c, z, false FROM ins JOIN act USING (s)
  UNION ALL SELECT f, '', e || 'R', c + 2, z, false FROM ins JOIN act USING (s) WHERE x <> 's'
), p AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, '000000000' AS v FROM t
  UNION ALL
  SELECT p.conv_id, d.i, w.z, min(lpad((left(v, 9)::BIGINT + w.c + CASE WHEN d.cut AND NOT w.del THEN 1 ELSE 0 END)::VARCHAR, 9, '0') || substr(v, 10) || w.e)
  FROM p JOIN d ON d.conv_id = p.conv_id AND d.i = p.i + 1 JOIN w ON w.f = p.s AND (w.del OR (NOT d.blank AND NOT d.dup AND w.x IN ('', d.x)))
  GROUP BY p.conv_id, d.i, w.z
), b AS (
  SELECT conv_id, min(lpad((left(v, 9)::BIGINT + c)::VARCHAR, 9, '0') || substr(v, 10) || e) AS v
  FROM p JOIN t USING (conv_id) JOIN ins ON ins.f = p.s AND ins.s IN (0, 4) WHERE i = n GROUP BY conv_id
), a AS (
  SELECT conv_id, v[9 + k:9 + k] AS e, k, length(replace(v[10:9 + k], 'I', '')) AS i, length(replace(v[10:9 + k], 'D', '')) AS q
  FROM (SELECT *, unnest(generate_series(1, length(v) - 9)) AS k FROM b)
), y AS (
  SELECT a.*, d.text, d.role, coalesce(max(CASE WHEN e = 'K' AND q = 1 AND d.x = 's' THEN 1 END) OVER (PARTITION BY a.conv_id), 0) AS opened
  FROM a LEFT JOIN d ON d.conv_id = a.conv_id AND d.i = a.i
), z AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (q - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired
  FROM y WHERE e <> 'D' GROUP BY conv_id
)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(left(v, 9)::BIGINT, 0) AS cost, coalesce(substr(v, 10), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN t USING (conv_id) LEFT JOIN b USING (conv_id) LEFT JOIN z USING (conv_id)
""".replace("{CRC}", _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))
ORACLES["op13_decontaminate"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_PHRASE_WORDS} AS words FROM documents
), i AS (
  SELECT item_id, {_PHRASE_WORDS} AS words FROM benchmark
), w AS (
  SELECT DISTINCT item_id, list_slice(words, k, k + 9) AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS k FROM i WHERE len(words) > 0)
), p AS (
  SELECT r, k, n, list_slice(words, k, k + n - 1) AS win
  FROM (SELECT r, words, n, unnest(generate_series(1, len(words) - n + 1)) AS k
        FROM d, (SELECT DISTINCT len(win) AS n FROM w) WHERE len(words) >= n)
), m AS (
  SELECT r, k, n, item_id FROM p JOIN w USING (win)
), h AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS place FROM m) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS item FROM m) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
ORACLES["op5_all_repeated_lines"] = ORACLES["op5_repeated_lines"].replace("WHERE n_words >= 20 ", "")
