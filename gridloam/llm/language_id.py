"""Language identification by known words, backing off to ever shorter character n-grams for unknown ones.

A model holds, for each learned language, the log frequency of its words and of the 1- to 5-letter pieces of
words. A text is the sum over its words: a word known in any language counts by its log frequency in each, an
unknown one by its longest pieces that are known. The sums, made into probabilities, give the language and the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What counts as part of a number only, such as a superscript or a fraction, is no letter.
NUMBERS = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
LETTERS = re.compile(rf"[^\W\d_{NUMBERS}]+")
WORDS = re.compile(r"\w+")
UNKNOWN = "und"
LONGEST_PIECE = 5
# How much of an item's frequency is the language's own; the rest is that in all languages together.
OWN_SHARE = 0.9
# Words whose backed-off vectors one task keeps before it starts anew.
KEPT_WORDS = 300_000


@dataclass
class LanguageModel:
    """Languages in order, and the log frequencies by language of words and of pieces of words."""

    languages: list[str]
    known: dict[str, np.ndarray]
    pieces: dict[str, np.ndarray]
    prior: np.ndarray


def runs_of_letters(text: str) -> list[str]:
    """What `LETTERS` finds in a text. Its long class is slow, so only words that are not all letters are taken apart by it."""
    words = WORDS.findall(text)
    if all(map(str.isalpha, words)):
        return words
    return [run for word in words for run in ((word,) if word.isalpha() else LETTERS.findall(word))]


def pieces_of(word: str, size: int) -> list[str]:
    """Pieces of `size` letters of a word between two marks; a size of 1 leaves the marks out."""
    marked = word if size == 1 else f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _counted(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.update((lang, w) for w in runs_of_letters(text.lower()))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in counts.items()], columns=["lang", "item", "n"])


def _cut(words: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in words:
        counts: Counter = Counter()
        for lang, word, n in zip(batch["lang"], batch["item"], batch["n"]):
            for size in range(1, LONGEST_PIECE + 1):
                for piece in pieces_of(word, size):
                    counts[lang, piece] += n
        yield pd.DataFrame([(lang, p, n) for (lang, p), n in counts.items()], columns=["lang", "item", "n"])


def _most_frequent(counts: DataFrame, kept: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    summed = counts.groupBy("lang", "item").agg(F.sum("n").alias("n"))
    return summed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kept).drop("rank")


def _by_language(counts: list, languages: list[str]) -> dict[str, np.ndarray]:
    """Log frequencies by language, each mixed with a tenth of the frequency in all together: an item that a language
    lacks has the same floor in every such language, however much text each was learned from."""
    place = {lang: i for i, lang in enumerate(languages)}
    table: dict[str, np.ndarray] = {}
    for r in counts:
        table.setdefault(r["item"], np.zeros(len(languages)))[place[r["lang"]]] += r["n"]
    total = np.sum(list(table.values()), axis=0) if table else np.zeros(len(languages))
    every = max(total.sum(), 1.0)
    return {item: np.log(OWN_SHARE * n / np.maximum(total, 1.0) + (1 - OWN_SHARE) * n.sum() / every) for item, n in table.items()}


def fit_languages(texts: DataFrame, text: str = "text", lang: str = "lang", *, sample_per_language: int = 4000, words_kept: int = 40_000, pieces_kept: int = 40_000, most_items: int = 16_000_000) -> LanguageModel:
    """Learn from the rows whose text and language are known.

    The model is fitted on about `sample_per_language` different texts of each language, chosen by a hash of the text,
    each counted once; a language with fewer has all of them counted. It keeps `words_kept` words and `pieces_kept`
    pieces of each language, fewer where the languages are so many that together they would pass `most_items`; these
    bound it whatever the input, and no language is left out that has a letter in its sample. How frequent a language is
    follows from all rows. An empty input gives a model without languages, which answers `und`.
    """
    rows = texts.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    hashed = F.xxhash64("text")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(hashed).alias("different")).collect()
    if not sizes:
        return LanguageModel([], {}, {}, np.zeros(0))
    each = max(1, most_items // (2 * len(sizes)))
    shares = rows.sparkSession.createDataFrame([(r["lang"], sample_per_language / r["different"] * (1 << 20)) for r in sizes], "lang string, share double")
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod(hashed, F.lit(1 << 20)) < F.col("share")).select("lang", "text").distinct()
    schema = "lang string, item string, n long"
    known = _most_frequent(chosen.mapInPandas(_counted, schema), min(words_kept, each)).persist()
    try:
        pieces = _most_frequent(known.mapInPandas(_cut, schema), min(pieces_kept, each)).collect()
        known_rows = known.collect()
    finally:
        known.unpersist()
    heard = {r["lang"] for r in known_rows}
    count = {r["lang"]: r["n"] for r in sizes if r["lang"] in heard}
    languages = sorted(count)
    prior = np.log(np.array([count[k] for k in languages], float) / max(sum(count.values()), 1))
    return LanguageModel(languages, _by_language(known_rows, languages), _by_language(pieces, languages), prior)


def word_vector(model: LanguageModel, word: str) -> np.ndarray:
    """A word's log frequency in each language: its own, or the mean of its longest known pieces; zeros if none is known."""
    found = model.known.get(word)
    if found is not None:
        return found
    for size in range(min(LONGEST_PIECE, len(word) + 2), 0, -1):
        got = [model.pieces[p] for p in pieces_of(word, size) if p in model.pieces]
        if got:
            return np.add.reduce(got) / len(got)
    return np.zeros(len(model.languages))


def identified(model: LanguageModel, text: str | None, kept: dict[str, np.ndarray]) -> tuple[str, float]:
    """The language and its probability; `und` and 0 without a letter. Ties go to the first language by name."""
    counts = Counter(runs_of_letters(text.lower())) if text else None
    if not counts or not model.languages:
        return UNKNOWN, 0.0
    vectors = list(map(model.known.get, counts))
    for i, word in enumerate(counts):
        if vectors[i] is None:
            v = kept.get(word)
            if v is None:
                v = kept[word] = word_vector(model, word)
            vectors[i] = v
    total = model.prior + np.fromiter(counts.values(), float, len(counts)) @ np.array(vectors)
    best = int(np.argmax(total))
    return model.languages[best], 1.0 / math.fsum(np.exp(np.minimum(total - total[best], 0.0)))


def language_of(spark, model: LanguageModel, text: Column) -> Column:
    """A struct of `lang_pred` and `score` for each text. NULL and texts without a letter give `und` and 0."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept: dict[str, np.ndarray] = {}
        for batch in texts:
            yield pd.DataFrame([identified(shared.value, t, kept) for t in batch], columns=["lang_pred", "score"])
            if len(kept) > KEPT_WORDS:
                kept.clear()

    return found(text)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score` (0 to 1) added, or put in place of columns of those names."""
    got = docs.withColumn("_llm_language", language_of(docs.sparkSession, model, F.col(f"`{text}`")))
    return got.withColumns({c: F.col(f"_llm_language.{c}") for c in ("lang_pred", "score")}).drop("_llm_language")
