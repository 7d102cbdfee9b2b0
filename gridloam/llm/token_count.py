"""Token counts without tokens: a Viterbi search over a unigram vocabulary that carries only score and count.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character. The best way to reach a
character is kept as its score and number of pieces. The rules are those of the `Unigram` model of the tokenizers
library: among equal scores the path that starts its last piece earliest wins; a character that is no piece
costs ten more than the worst piece, and counts as its bytes where the vocabulary has byte pieces, else a run of
such characters counts as one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "\u2581"
UNKNOWN_PENALTY = 10.0
KEPT_PARTS = 500_000


class Vocabulary:
    """Pieces with scores, read from a sentencepiece model file or given as a list. Earlier pieces win a tie of names."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0) -> None:
        self.pieces, self.unknown = pieces, unknown

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id())

    def __getstate__(self):
        return {"pieces": self.pieces, "unknown": self.unknown}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for piece, score in self.pieces:
            if piece:
                found.add_word(piece, (len(piece), score))
        found.make_automaton()
        return found

    @cached_property
    def unknown_score(self) -> float:
        return min(s for _, s in self.pieces) - UNKNOWN_PENALTY

    @cached_property
    def has_bytes(self) -> bool:
        names = {p for p, _ in self.pieces}
        return all(f"<0x{b:02X}>" in names for b in range(256))

    @cached_property
    def parts(self) -> re.Pattern | None:
        """Cuts a text where no piece can cross, if adding up the parts is exact: no piece has a space after a
        letter, the space is a piece, and scores are whole numbers."""
        inside = any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in self.pieces)
        exact = all(float(s).is_integer() and abs(s) < 1 << 31 for _, s in self.pieces)
        if inside or not exact or not any(p == SPACE for p, _ in self.pieces):
            return None
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    @cached_property
    def letters(self) -> set[str]:
        return {p for p, _ in self.pieces if len(p) == 1}

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best path over a text whose spaces are marked.

        The automaton lists the pieces that end at a character longest first, so a later one must be better to win.
        """
        score, count = [0.0] + [-math.inf] * len(text), [0] * (len(text) + 1)
        if self.letters.issuperset(text):
            for end, (length, s) in self.automaton.iter(text):
                reached = score[end + 1 - length] + s
                if reached > score[end + 1]:
                    score[end + 1], count[end + 1] = reached, count[end + 1 - length] + 1
            return score[-1], count[-1]
        found = self.automaton.iter(text)
        end, piece = next(found, (None, None))
        run = [False] * (len(text) + 1)
        for at, letter in enumerate(text):
            while end == at:
                length, s = piece
                reached = score[at + 1 - length] + s
                if reached > score[at + 1]:
                    score[at + 1], count[at + 1] = reached, count[at + 1 - length] + 1
                end, piece = next(found, (None, None))
            if letter not in self.letters and score[at] + self.unknown_score > score[at + 1]:
                score[at + 1], run[at + 1] = score[at] + self.unknown_score, True
                count[at + 1] = count[at] + (len(letter.encode("utf-8", "surrogatepass")) if self.has_bytes else not run[at])
        return score[-1], count[-1]

    def counted(self, text: str | None, kept: dict[str, int]) -> int:
        """Number of pieces of a text (a space marked in front, as the model does); 0 for NULL and empty texts."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if self.parts is None:
            return self.count(marked)[1]
        found = self.parts.findall(marked)
        for p in set(found):
            if p not in kept:
                kept[p] = self.count(p)[1]
        return sum(map(kept.__getitem__, found))


def token_count(spark, vocabulary: Vocabulary, text: Column) -> Column:
    """The number of tokens of each text."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept: dict[str, int] = {}
        for batch in batches:
            yield pd.Series([shared.value.counted(t, kept) for t in batch], dtype="int64")
            if len(kept) > KEPT_PARTS:
                kept.clear()

    return counted(text)


def with_token_count(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """`docs` with the number of tokens of each text in `out`."""
    return docs.withColumn(out, token_count(docs.sparkSession, vocabulary, F.col(f"`{text}`")))
