"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are its words, its word pairs, and runs of up to three word shapes (letter case, attached marks,
repetition of the word before), hashed into `2 ** bits` places and scaled to unit length. A score is the sigmoid of
a sparse dot product.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[^\W\d_A-Z]+")
KEPT_WORDS = 500_000
REPEATED = np.uint64(0x5BD1E995)
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int


def word_code(word: str) -> int:
    """The hash of a word in the upper half, that of its shape in the lower: `The!!` has the shape `Aa!!`."""
    shape = re.sub(r"\d+", "0", LOWER.sub("a", UPPER.sub("A", word)))
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) << 32 | zlib.crc32(shape.encode("utf-8", "surrogatepass"))


def features(text: str | None, bits: int, codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; both empty without words."""
    found = (text or "").split()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    for w in set(found):
        if w not in codes:
            codes[w] = word_code(w)
    both = np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    shape = shape.copy()
    shape[1:][word[1:] == word[:-1]] = REPEATED
    parts = [word * MULTIPLY, (word[:-1] * MULTIPLY + word[1:] + np.uint64(1)) * MULTIPLY]
    run = shape
    for n in range(1, 4):
        parts.append((run + np.uint64(n << 40)) * MULTIPLY)
        run = (run[:-1] * MULTIPLY + shape[n:]) if len(shape) > n else shape[:0]
    scaled = []
    # Words and shapes each make up half of a text's length, so that many rare words do not drown the shapes.
    for group in (np.concatenate(parts[:2]), np.concatenate(parts[2:])):
        place, count = np.unique(group >> np.uint64(64 - bits), return_counts=True)
        value = count.astype(float)
        scaled.append((place.astype(np.int64), value / np.sqrt(2 * (value @ value))))
    return np.concatenate([p for p, _ in scaled]), np.concatenate([v for _, v in scaled])


def trained(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, passes: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Weights and bias after at least `passes` over the rows in the given order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits
    rows = [(np.append(p, bias), np.append(v, 1.0), y) for p, v, y in rows]

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    # A small sample is gone over more often.
    for _ in range(max(passes, min(60, 20_000 // max(len(rows), 1)))):
        for place, value, label in rows:
            w = weights(place)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            step = (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / alpha
            np.add.at(z, place, g - step * w)
            np.add.at(n, place, g * g)
    w = weights(np.arange(len(z)))
    return w[:bias], float(w[bias])


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 12_000, bits: int = 18, passes: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> QualityModel:
    """Learn from the labelled rows among `docs`.

    Fitted on about `sample` labelled ids chosen by a hash of the id; that bounds what one task trains on, whatever
    the input. Ids labelled more than once count by the mean, NULL ids and labels not at all. Without labelled rows
    every score is a half.
    """
    marked = labels.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{label}`").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    share = sample / max(marked.count(), 1)
    chosen = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(share * (1 << 20))).groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    rows = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "id")

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[str, int] = {}
        for b in batches:
            got = [features(t, bits, codes) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "label": b["label"], "place": [p.tobytes() for p, _ in got], "value": [v.tobytes() for _, v in got]})

    def learned(group: pd.DataFrame) -> pd.DataFrame:
        order = [zlib.crc32(i.encode()) for i in group["id"]]
        group = group.assign(order=order).sort_values(["order", "id", "label"])
        data = [(np.frombuffer(p, np.int64), np.frombuffer(v), int(y)) for p, v, y in zip(group["place"], group["value"], group["label"])]
        w, b = trained(data, bits, passes, alpha, beta, l1, l2)
        return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "bias": [b]})

    got = rows.mapInPandas(encoded, "id string, label int, place binary, value binary").withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learned, "weights binary, bias double").first()
    if got is None:
        return QualityModel(np.zeros(1 << bits, np.float32), 0.0, bits)
    return QualityModel(np.frombuffer(got["weights"], np.float32), got["bias"], bits)


def scored(model: QualityModel, text: str | None, codes: dict[str, int]) -> float:
    place, value = features(text, model.bits, codes)
    return float(1.0 / (1.0 + np.exp(-np.clip(model.weights[place] @ value + model.bias, -35, 35))))


def quality_of(spark, model: QualityModel, text: Column) -> Column:
    """The score (0 to 1) of each text; NULL and empty texts get what the bias alone says."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes: dict[str, int] = {}
        for batch in texts:
            yield pd.Series([scored(shared.value, t, codes) for t in batch], dtype=float)
            if len(codes) > KEPT_WORDS:
                codes.clear()

    return found(text)


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """`docs` with `score` and `predicted` (1 where the score reaches `threshold`) added or put in place."""
    return docs.withColumn("score", quality_of(docs.sparkSession, model, F.col(f"`{text}`"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
