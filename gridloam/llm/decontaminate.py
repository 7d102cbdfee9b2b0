"""Benchmark decontamination with suffix arrays of the training texts.

Training texts are taken shard by shard (a bounded number of bytes). Each shard gets a suffix array over its words,
kept to the suffixes that begin like some benchmark text. Every benchmark suffix is looked up in it by binary search,
which gives its longest verbatim matches and where they are. Documents with a match of a window are contaminated.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloam.llm.batches import byte_set, mixed, text_bytes, words

WINDOW = 10
# Bytes of benchmark text searched for at once; a larger benchmark is searched block by block.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
# Word bytes: digits, letters and everything beyond ASCII.
LETTERS = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
MATCH = T.ArrayType(T.StructType([T.StructField("doc_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("item_id", T.StringType()), T.StructField("item_word", T.IntegerType())]))
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("matches", MATCH)])


@dataclass
class TestTexts:
    """Benchmark items as word numbers (1 and up, in the order of `vocabulary`) and their searchable suffixes."""

    ids: list[str | None]
    vocabulary: np.ndarray
    numbers: list[np.ndarray]
    starts: np.ndarray
    begin: int

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], window: int) -> TestTexts:
        hashes, _, first = words(*text_bytes(pa.array([t for _, t in items], pa.large_string())), LETTERS)
        vocabulary = np.unique(hashes)
        parts = [np.searchsorted(vocabulary, hashes[a:b]) + 1 for a, b in zip(first, first[1:])]
        kept = [(i, p) for (i, _), p in zip(items, parts) if len(p)]
        # Suffixes are told apart by their first words: no more of them than the shortest item has.
        begin = min([4, *(len(p) for _, p in kept)])
        starts = [_grams(p, begin) for _, p in kept]
        return cls([i for i, _ in kept], vocabulary, [p for _, p in kept], np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.uint64), begin)


def _grams(numbers: np.ndarray, size: int) -> np.ndarray:
    n = max(len(numbers) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mixed(out + numbers[k : k + n].astype(np.uint64))
    return out


def _is_in(values: np.ndarray, sorted_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values, at


def _common(a: bytes, b: bytes) -> int:
    """Words of four bytes that two keys have in common at the start."""
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, ">u4", n), np.frombuffer(b, ">u4", n)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def matches_in(texts: pa.Array, tests: TestTexts, window: int) -> tuple[np.ndarray, list[list[tuple]]]:
    """For each text of one shard its number of words and its longest matches (those not extendable to the left)."""
    hashes, _, first = words(*text_bytes(texts), LETTERS)
    found: list[list[tuple]] = [[] for _ in range(len(texts))]
    counts = np.diff(first)
    if not len(hashes) or not tests.ids:
        return counts, found
    known, at = _is_in(hashes, tests.vocabulary)
    numbers = np.where(known, at + 1, 0).astype(np.uint32)
    last = first[1:][np.searchsorted(first, np.arange(len(hashes)), "right") - 1]
    # A match runs on no further than the next unknown word or the text's end.
    unknown = np.append(np.flatnonzero(numbers == 0), len(numbers))
    stop = np.minimum(unknown[np.searchsorted(unknown, np.arange(len(numbers)))], last)
    where = np.flatnonzero(stop - np.arange(len(numbers)) >= tests.begin)
    if not len(where):
        return counts, found
    near = np.zeros(len(where), np.uint64)
    for k in range(tests.begin):
        near = mixed(near + numbers[where + k].astype(np.uint64))
    where = where[_is_in(near, tests.starts)[0]]
    longest = max(map(len, tests.numbers))
    text = numbers.astype(">u4").tobytes()
    suffixes = sorted((text[4 * p : 4 * min(int(stop[p]), p + longest)], p) for p in where.tolist())
    keys = [k for k, _ in suffixes]
    for item, own in zip(tests.ids, tests.numbers):
        key = own.astype(">u4").tobytes()
        size = min(window, len(own))
        for q in range(len(own) - size + 1):
            rest = key[4 * q :]
            head = rest[: 4 * size]
            k = bisect_left(keys, head)
            while k < len(keys) and keys[k].startswith(head):
                p = suffixes[k][1]
                doc = int(np.searchsorted(first, p, "right")) - 1
                if not (q and p > first[doc] and numbers[p - 1] == own[q - 1]):
                    found[doc].append((p - int(first[doc]), _common(keys[k], rest), item, q))
                k += 1
    return counts, found


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield sorted(((r["id"], r["text"]) for r in block.collect()), key=lambda r: (r[0] is None, r))


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", *, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with `n_words` and `matches`: the longest runs of words shared with a benchmark item, at least `window`
    words (or a whole item of fewer) each, with their places.

    Words are runs of digits, letters and non-ASCII characters, A-Z as a-z. NULL texts have no words. The benchmark is
    collected in blocks of about `block_bytes`, each broadcast and searched for in one more pass within the same tasks.
    Items without words match nothing. Columns of the two names are put in place.
    """
    spark, first = docs.sparkSession, True
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        searched = _searcher(spark.sparkContext.broadcast(TestTexts.of(items, window)), window)
        new = searched(F.col(f"`{text}`"))
        before = F.array().cast(MATCH) if first else F.col("_llm_found.matches")
        first = False
        docs = docs.withColumn("_llm_new", new)
        docs = docs.withColumn("_llm_found", F.struct(F.col("_llm_new.n_words").alias("n_words"), F.concat(before, F.col("_llm_new.matches")).alias("matches"))).drop("_llm_new")
    return docs.withColumns({"n_words": F.col("_llm_found.n_words"), "matches": F.col("_llm_found.matches")}).drop("_llm_found")


def _searcher(shared, window: int):
    @F.arrow_udf(FOUND)
    def searched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _searched(batch, shared.value, window)

    return searched


def _searched(batch: pa.Array, tests: TestTexts, window: int) -> pa.Array:
    counts, matches = [], []
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch), 0))
    cut = np.flatnonzero(np.diff(np.cumsum(lengths) // SHARD_BYTES)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)]):
        n, found = matches_in(batch.slice(a, b - a), tests, window)
        counts.append(n)
        matches.extend(found)
    values = [m for row in matches for m in row]
    flat = pa.StructArray.from_arrays([pa.array([m[i] for m in values], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int32()))], names=["doc_word", "n_words", "item_id", "item_word"])
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in matches])]).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["n_words", "matches"])


def words_hit(matches: Column) -> Column:
    """The number of a document's words inside any match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["doc_word"].alias("start"), (m["doc_word"] + m["n_words"]).alias("end"))))
    start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto"))

    def add(a: Column, s: Column) -> Column:
        return F.struct((a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).alias("hit"), F.greatest(a["upto"], s["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda a: a["hit"]).cast("long")


def items_hit(matches: Column) -> Column:
    """The ids of the items matched, each once, sorted as text. An item without an id has none to list."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(matches, lambda m: m["item_id"]), lambda i: i.isNotNull())))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that share no window with a benchmark item, with their own columns only."""
    columns = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    got = with_matches(inner, benchmark, f"c{columns.index(text)}", **options).where(F.size("matches") == 0)
    return got.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
