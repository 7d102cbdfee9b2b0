"""Texts inside tasks: Arrow batches cut to a bounded number of bytes, and words found and hashed with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text worked on at once; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def row_key(id_column: str, text_column: str):
    """A column that tells rows apart by id and text. Rows equal in both share it, and share every result."""
    return F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))


def picked(df: DataFrame, **columns) -> DataFrame:
    """The named columns under fixed names, so that other columns of any name do no harm."""
    return df.select(*(c.alias(name) if not isinstance(c, str) else F.col(f"`{c}`").alias(name) for name, c in columns.items()))


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """`batch` in pieces of at most `limit` bytes of text each, or one row."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
    total, start = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text starts (one more entry for the end). NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values stirred so that every bit depends on every other."""
    h = (h ^ (h >> np.uint64(33))) * MIX_A
    h = (h ^ (h >> np.uint64(33))) * MIX_B
    return h ^ (h >> np.uint64(33))


# Each byte's share in a word's hash, A-Z as a-z.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
STEP = np.uint64(0xD6E8FEB86659FD93)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, True for the bytes in `ranges` (ends included)."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are the longest runs of bytes in `letters`, A-Z taken as a-z; none spans two texts.

    Returns a 64-bit hash per word, the word's first byte, and where each text's words start (one more entry for
    the end).
    """
    inside = letters[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, first
    word = np.cumsum(inside & ~before) - 1
    at = np.flatnonzero(inside)
    place = at - starts[word[at]]
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, STEP))
    values = BYTE_VALUES[data[at]] * powers[place]
    begins = np.searchsorted(at, starts)
    return mixed(np.add.reduceat(values, begins)), starts, first


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each run of `size` words inside one text, and where each text's runs start."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    n = len(hashes) - size + 1
    if n <= 0 or not ends[-1]:
        return np.zeros(0, np.uint64), ends
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mixed(out * STEP + hashes[k : k + n] + np.uint64(k))
    text = np.repeat(np.arange(len(count)), count)
    return out[np.arange(ends[-1]) - ends[text] + first[text]], ends
