"""Language of a text from its words, backing off to parts of unseen ones.

A word seen in training scores the logarithm of its frequency in each language. An unseen word scores by
its character n-grams, the longest first: if any of its n-grams of a length is known, their mean counts,
otherwise shorter ones are tried. The language with the largest sum wins.

The model is fitted on a sample of labelled rows of bounded size and keeps a bounded number of words and
n-grams of each language, so it has a proven size and goes to the executors as one broadcast value. All
rows are then scored over their whole texts, without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.shared import from_row, ship_package, stored, whole_row

#: Training rows of each language, about; fewer if there are fewer.
SAMPLE = 3_000
#: Words, and n-grams of each length, that the model keeps of a language.
KEPT = 20_000
#: Lengths of n-grams, in the order in which they are tried; a word's ends count as characters.
GRAMS = (5, 4, 3, 2, 1)
#: Added to each count.
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Words whose scores a worker remembers; beyond it they are worked out again.
REMEMBERED = 400_000
#: Words of a text that are looked up at once.
PORTION = 100_000

_LETTERS = re.compile(r"[^\W\d_]+")
#: Numbers that ``\w`` holds but ``\d`` doesn't, as superscripts, fractions and Roman numerals; a letter has category L.
_NUMBERS = frozenset(c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) in ("Nl", "No"))
_APART = dict.fromkeys(map(ord, _NUMBERS), " ")
_START, _END = "\x02", "\x03"


@dataclass(frozen=True)
class Model:
    """Languages, and for each word and each n-gram its logarithmic frequency in all of them."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray
    prior: np.ndarray


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that training leaves out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _scores(rows: pa.Table, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    at = {x: i for i, x in enumerate(languages)}
    coded = pa.array(rows["unit"].to_pylist(), pa.string()).dictionary_encode()
    units = {x: i for i, x in enumerate(coded.dictionary.to_pylist())}
    counts = np.zeros((len(units), len(languages)))
    columns = np.array([at[x] for x in rows["lang"].to_pylist()], dtype=np.int64)
    np.add.at(counts, (coded.indices.to_numpy(zero_copy_only=False), columns), rows["n"].to_numpy())
    totals = counts.sum(axis=0)
    return units, np.log((counts + SMOOTHING) / (totals + SMOOTHING * max(len(units), 1)))


def fit(labelled: DataFrame, sample: int = SAMPLE, kept: int = KEPT) -> Model:
    """Fits on a table of ``doc_id``, ``text`` and ``lang``; rows with a null in one of the last two don't count.

    Of each language about ``sample`` rows are used, chosen by a digest of their id, and
    ``kept`` words and n-grams of each length, the most frequent. An empty table gives a model without a
    language, for which every text is undetermined.
    """
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per label
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        nothing = np.zeros((0, 0))
        return Model([], {}, nothing, {}, nothing, np.zeros(0))
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, sample / r["n"]))) for r in sizes])
    chance = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = usable.filter(chance < share)
    words = F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")
    counts = stored(chosen.select("lang", F.explode(words).alias("unit")).groupBy("lang", "unit").agg(F.count("*").alias("n")), "words")
    marked = F.concat(F.lit(_START), "unit", F.lit(_END))
    cuts = [F.when(F.length(marked) >= size, F.transform(F.sequence(F.lit(1), F.length(marked) - (size - 1)), _cut(marked, size))) for size in GRAMS]
    parts = counts.select("lang", "n", F.explode(F.flatten(F.array_compact(F.array(*cuts)))).alias("unit"))
    most = _most_frequent(counts, kept)
    rows = _most_frequent(parts.groupBy("lang", "unit").agg(F.sum("n").alias("n")), kept)
    word_at, word_scores = _scores(most, languages)
    gram_at: dict[str, int] = {}
    blocks = []
    for size in GRAMS:
        units, scores = _scores(rows.filter(pc.equal(pc.utf8_length(rows["unit"]), size)), languages)
        gram_at |= {x: len(gram_at) + i for x, i in units.items()}
        blocks.append(scores)
    n = np.array([next(r["n"] for r in sizes if r["lang"] == x) for x in languages], dtype=float)
    return Model(languages, word_at, word_scores, gram_at, np.vstack(blocks), n / n.sum())


def _cut(marked: Column, size: int):
    return lambda start: F.substr(marked, start, F.lit(size))


def _most_frequent(counts: DataFrame, kept: int) -> pa.Table:
    """The ``kept`` most frequent units of each language and length group; a task sends that many of each."""
    group = F.least(F.length("unit"), F.lit(max(GRAMS)))
    order = Window.partitionBy("lang", "_group").orderBy(F.col("n").desc(), "unit")
    ranked = counts.withColumn("_group", group).withColumn("_at", F.row_number().over(order))
    return ranked.filter(F.col("_at") <= kept).select("lang", "unit", "n").toArrow()


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case. Few texts hold numbers that look like letters to ``re``."""
    lower = text.lower()
    if not lower.isascii() and not _NUMBERS.isdisjoint(lower):
        lower = lower.translate(_APART)
    return _LETTERS.findall(lower)


class Scorer:
    """Scores texts with one model; remembers what it worked out for words."""

    def __init__(self, model: Model):
        self.model = model
        self.log_prior = np.log(model.prior)
        self.scores = np.zeros((len(model.words) + REMEMBERED, len(model.languages)))
        self.scores[: len(model.words)] = model.word_scores
        self.at = dict(model.words)

    def _backoff(self, word: str) -> np.ndarray:
        """Mean score of the longest known n-grams of a word; nothing known scores nothing."""
        marked, grams = f"{_START}{word}{_END}", self.model.grams
        for size in GRAMS:
            known = [grams[g] for i in range(len(marked) - size + 1) if (g := marked[i : i + size]) in grams]
            if known:
                return self.model.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.model.languages))

    def _row(self, word: str) -> int:
        at = self.at[word] = len(self.at)
        self.scores[at] = self._backoff(word)
        return at

    def _sums(self, words: list[str]) -> np.ndarray:
        if len(self.at) + len(words) > len(self.scores):
            self.at = dict(self.model.words)
        at = self.at
        rows = [at[w] if w in at else self._row(w) for w in words]
        return self.scores[rows].sum(axis=0)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        sums = self.log_prior.copy()
        for start in range(0, len(words), PORTION):
            sums += self._sums(words[start : start + PORTION])
        best = int(sums.argmax())
        return self.model.languages[best], float(1.0 / np.exp(sums - sums[best]).sum())


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the share of the winner among all languages, to every row.

    A null text, one without a letter, or any text if nothing was learned, is ``und`` with score 0. Equal
    scores go to the language that sorts first. Repeated rows are scored each, an empty table gives no
    rows, and columns of the input named like the results are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens.forget()  # workers that packed before are used again
        score = Scorer(shared.value)
        for texts in batches:
            found = [score(x) for at in range(0, len(texts), 256) for x in texts.slice(at, 256).to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["lang_pred", "score"])

    # only texts go through Python; a filter on the result is not to score them a second time
    find = F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()
    ship_package(spark)
    rows = docs.select(whole_row(docs).alias("_row"), find(F.col(text).cast("string")).alias("_found"))
    return rows.select(*from_row(docs, ("lang_pred", "score")), "_found.lang_pred", "_found.score")
