"""Best-fit packing of documents into sequences of a fixed number of tokens, in bulk-synchronous rounds.

Documents are cut into pieces that fit. A round range-sorts the waiting pieces together with the gaps left in
open sequences and sweeps each range: a gap takes the largest piece before it that no smaller gap has taken. What
a range cannot match inside itself is matched across ranges by rank, as brackets are. Gaps shrink, and the next round
begins. Longer pieces go first; a class of pieces that no gap can hold opens new sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloam.session import written

END_OF_DOCUMENT = 2
CAPACITY = 1024
# Rows that one range of a sweep holds, about.
RANGE_ROWS = 200_000
KEPT_CHUNKS = 300_000
# A space between two characters that are not white space: no token reaches across its left side.
CUT = re.compile(r"(?<=\S) (?=\S)")
SWEPT = "kind string, item long, length long, bin long, room long, part int, rank long"


def byte_bpe(tokenizer_file: str) -> tiktoken.Encoding:
    """The byte-level BPE of a `tokenizers` file in a faster encoder: same vocabulary, same ids."""
    with open(tokenizer_file, encoding="utf-8") as f:
        described = json.load(f)
    # Fixed rule of byte-level vocabularies: printable Latin-1 characters stand for their bytes, those from 256 on for
    # the other bytes in order.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"]: t["id"] for t in described.get("added_tokens", ())}
    ranks = {bytes(byte[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Chunks(dict):
    """Token ids of chunks that follow a space, each encoded when it is first met. Chunks with white space at an end
    have none: whether a token reaches across depends on what stands next to them."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk != chunk.strip():
            raise KeyError(chunk)
        if len(self) >= KEPT_CHUNKS:
            self.clear()
        ids = self[chunk] = self.encode(" " + chunk)
        return ids


class ChunkEncoder:
    """Token ids of texts as little-endian 32-bit bytes. Chunks between spaces are encoded once and kept."""

    def __init__(self, tokenizer_file: str) -> None:
        self.bpe = byte_bpe(tokenizer_file)
        self.special = re.compile("|".join(map(re.escape, self.bpe.special_tokens_set)) or r"(?!)")
        self.kept = Chunks(self.ids)

    def ids(self, text: str) -> bytes:
        ids = self.bpe.encode(text, allowed_special="all") if self.special.search(text) else self.bpe.encode_ordinary(text)
        return array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head, *chunks = text.split(" ")
        try:
            if chunks and head != head.strip():
                raise KeyError(head)
            return self.ids(head) + b"".join(map(self.kept.__getitem__, chunks))
        except KeyError:
            head, *chunks = CUT.split(text)
            return self.ids(head) + b"".join([self.ids(" " + c) for c in chunks])


def cut_lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of `n` tokens: whole if they fit, else full pieces after a first that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def token_pieces(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: the document's id, `piece` from 0, `start`, `length`, `ids_crc32` (and `ids` if asked for).

    A NULL text is an empty one; every document ends with its own end token, so none is without a piece.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_file)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                out = []
                for k, text in enumerate(batch.column("text").to_pylist()):
                    ids = encoder.encode(text) + end
                    for p, (start, length) in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        out.append((k, p, start, length, zlib.crc32(own), own if keep_ids else None))
                k, p, start, length, crc, own = zip(*out)
                columns = [batch.column("id").take(pa.array(k, pa.int32())), pa.array(p, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [id_column, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(own, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(pieces, f"`{id_column}` {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def _ranges(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    n = max(1, -(-rows // RANGE_ROWS))
    dealt = df.repartition(1) if n == 1 else df.repartitionByRange(n, *keys)
    return dealt.sortWithinPartitions(*keys)


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Match the sorted pieces and gaps of one range. What stays alone gets its rank: gaps by size, pieces likewise."""
    waiting: list[tuple] = []
    alone = 0
    part = None
    for b in batches:
        out = []
        for part, is_gap, who, size in zip(b["part"], b["is_gap"], b["who"], b["size"]):
            if not is_gap:
                waiting.append((who, size))
            elif waiting:
                item, length = waiting.pop()
                out.append(("pair", item, length, who, size, part, 0))
            else:
                out.append(("gap", -1, 0, who, size, part, alone))
                alone += 1
        yield pd.DataFrame(out, columns=["kind", "item", "length", "bin", "room", "part", "rank"])
    yield pd.DataFrame([("item", item, length, -1, 0, part, k) for k, (item, length) in enumerate(waiting)], columns=["kind", "item", "length", "bin", "room", "part", "rank"])


def _across(swept: DataFrame) -> DataFrame:
    """Match across ranges what was alone in its own: pieces open brackets, gaps of later ranges close them."""
    totals = swept.groupBy("part").agg(F.count_if(F.col("kind") == "item").alias("items"), F.count_if(F.col("kind") == "gap").alias("gaps")).orderBy("part").collect()
    if len(totals) < 2:
        return swept
    depth, bases = 0, []
    for t in totals:
        bases.append((t["part"], depth, depth - t["gaps"]))
        depth += t["items"] - t["gaps"]
    base = swept.sparkSession.createDataFrame(bases, "part int, at_gaps long, at_items long")
    alone = swept.where("kind != 'pair'").join(F.broadcast(base), "part")
    is_item = F.col("kind") == "item"
    level = F.when(is_item, F.col("at_items") + F.col("rank") + 1).otherwise(F.col("at_gaps") - F.col("rank"))
    # In a range lone gaps come before lone pieces. It has at most one of each at a level, so a level holds no more rows than there are ranges, twice.
    order = Window.partitionBy("level").orderBy("part", "kind")
    seen = alone.withColumn("level", level).withColumns({c: f.over(order) for c, f in (("next", F.lead("kind")), ("next_bin", F.lead("bin")), ("next_room", F.lead("room")), ("last", F.lag("kind")))})
    matched = is_item & (F.col("next") == "gap")
    kept = seen.where(F.coalesce(is_item | (F.col("last") != "item"), F.lit(True)))
    joined = kept.withColumns({"kind": F.when(matched, F.lit("pair")).otherwise(F.col("kind")), "bin": F.when(matched, F.col("next_bin")).otherwise(F.col("bin")), "room": F.when(matched, F.col("next_room")).otherwise(F.col("room"))})
    return swept.where("kind = 'pair'").unionByName(joined.select(*swept.columns))


def _opener(capacity: int):
    """Put sorted pieces one after another into new sequences; a sequence is named after its first piece."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bin_, used = -1, capacity + 1
        for b in batches:
            out = []
            for item, length in zip(b["item"], b["length"]):
                if used + length > capacity:
                    bin_, used = item, 0
                out.append((item, length, bin_, used))
                used += length
            yield pd.DataFrame(out, columns=["item", "length", "bin", "offset"])

    return opened


def _filled(waiting: DataFrame, gaps: DataFrame, least: int, n_waiting: int, capacity: int) -> tuple[list[DataFrame], DataFrame, DataFrame, int]:
    """Match waiting pieces, none shorter than `least`, with gaps round by round: what was placed, what waits still, the gaps left, and how many wait."""
    placed = []
    while n_waiting:
        fit = gaps.where(F.col("room") >= least)
        rows = waiting.select(F.lit(0).alias("is_gap"), F.col("item").alias("who"), F.col("length").alias("size")).unionByName(fit.select(F.lit(1).alias("is_gap"), F.col("bin").alias("who"), F.col("room").alias("size")))
        dealt = _ranges(rows, n_waiting + fit.count(), "size", "is_gap", "who").select("*", F.spark_partition_id().alias("part"))
        swept = written(_across(written(dealt.mapInPandas(_sweep, SWEPT), "swept")), "round")
        pairs = swept.where("kind = 'pair'")
        placed.append(pairs.select("item", "length", "bin", (capacity - F.col("room")).alias("offset")))
        shrunk = pairs.select("bin", (F.col("room") - F.col("length")).alias("room")).where("room > 0")
        gaps = gaps.where(F.col("room") < least).unionByName(swept.where("kind = 'gap'").select("bin", "room")).unionByName(shrunk)
        waiting = swept.where("kind = 'item'").select("item", "length")
        n_pairs, n_waiting, roomy = swept.agg(F.count_if(F.col("kind") == "pair"), F.count_if(F.col("kind") == "item"), F.max(F.when(F.col("kind") == "pair", F.col("room") - F.col("length")))).first()
        if not n_pairs or roomy < least:
            break
    return placed, waiting, gaps, n_waiting


def _bundled(short: DataFrame, n: int, limit: int) -> DataFrame:
    """Short pieces put together up to `limit`: item, length, bundle and offset in it."""
    made = _ranges(short, n, "length", "item").mapInPandas(_opener(limit), "item long, length long, bin long, offset long")
    return written(made.withColumnRenamed("bin", "bundle"), "bundles")


def _sums(bundles: DataFrame) -> DataFrame:
    return bundles.groupBy(F.col("bundle").alias("item")).agg(F.sum("length").alias("length"))


def packed(pieces: DataFrame, item: str = "item", length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """`sequence_id` and `offset` for each piece (`item`: unique long ids; lengths from 1 to `capacity`).

    Returns item, length, sequence_id and offset. Sequences are gapless from offset 0. An empty input gives no rows.
    """
    small = capacity // 16
    all_items = pieces.select(F.col(f"`{item}`").alias("item"), F.col(f"`{length}`").cast("long").alias("length"))
    # Short pieces are bundled first, so that one gap needs few rounds to be filled.
    short = all_items.where(F.col("length") <= small)
    n_short, n_all, longest = (all_items.agg(F.count_if(F.col("length") <= small), F.count(F.lit(1)), F.max("length")).first())
    if longest is not None and longest > capacity:
        raise ValueError(f"a piece of {longest} does not fit into {capacity}")
    bundles = _bundled(short, n_short, 2 * small)
    items = written(all_items.where(F.col("length") > small).unionByName(_sums(bundles)), "items")

    half = capacity // 2
    big = items.where(F.col("length") > half)
    placed = [big.select("item", "length", F.col("item").alias("bin"), F.lit(0).cast("long").alias("offset"))]
    gaps = big.select(F.col("item").alias("bin"), (capacity - F.col("length")).alias("room")).where("room > 0")
    alone = []
    edges = [capacity // k for k in range(2, 9)] + [small, 0]
    for upper, lower in zip(edges, edges[1:]):
        waiting = items.where((F.col("length") > lower) & (F.col("length") <= upper))
        least, n_waiting = waiting.agg(F.min("length"), F.count(F.lit(1))).first()
        pairs, waiting, gaps, n_waiting = _filled(waiting, gaps, least, n_waiting, capacity)
        placed += pairs
        if n_waiting and upper <= 2 * small:
            # Bundles that no gap holds open no sequences yet: their pieces may fit singly.
            names = bundles.select(F.col("bundle").alias("item")).distinct()
            alone.append(waiting.join(names, "item", "left_semi").select(F.col("item").alias("bundle")))
            waiting = written(waiting.join(names, "item", "left_anti"), "waiting")
            n_waiting = waiting.count()
        if n_waiting:
            opened = written(_ranges(waiting, n_waiting, "length", "item").mapInPandas(_opener(capacity), "item long, length long, bin long, offset long"), "opened")
            placed.append(opened)
            gaps = gaps.unionByName(opened.groupBy("bin").agg((capacity - F.sum("length")).alias("room")).where("room > 0"))
        gaps = written(gaps, "gaps")

    inner = bundles.unionByName(_single(all_items.where(F.col("length") > small)))
    out = [_housed(inner, placed)]
    if alone:
        left = alone[0] if len(alone) == 1 else alone[0].unionByName(alone[1])
        out += _singly(written(bundles.join(left, "bundle", "left_semi").select("item", "length"), "left"), gaps, small, capacity)
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def _single(items: DataFrame) -> DataFrame:
    return items.select("item", "length", F.col("item").alias("bundle"), F.lit(0).cast("long").alias("offset"))


def _housed(inner: DataFrame, placed: list[DataFrame]) -> DataFrame:
    """Pieces of the bundles that have been placed."""
    homes = placed[0]
    for p in placed[1:]:
        homes = homes.unionByName(p.select(*homes.columns))
    homes = homes.select(F.col("item").alias("bundle"), F.col("bin").alias("sequence_id"), F.col("offset").alias("base"))
    return inner.join(homes, "bundle").select("item", "length", "sequence_id", (F.col("base") + F.col("offset")).alias("offset"))


def _singly(left: DataFrame, gaps: DataFrame, small: int, capacity: int) -> list[DataFrame]:
    """Place short pieces whose bundles fitted nowhere: in ever smaller bundles, at last singly; what no gap holds opens
    sequences. After each step gaps are smaller than the bundles, so a gap takes a few of the next at most."""
    out, limit = [], small
    while True:
        n, tokens, least = left.agg(F.count(F.lit(1)), F.sum("length"), F.min("length")).first()
        if not n:
            return out
        room = gaps.agg(F.max("room")).first()[0] or 0
        if room < least or not limit:
            break
        # Pieces longer than half the limit stay single; those longer than any gap wait for the end.
        tiny = left.where(F.col("length") <= limit // 2)
        made = _bundled(tiny, n, limit)
        inner = written(made.unionByName(_single(left.where((F.col("length") > limit // 2) & (F.col("length") <= room)))), "inner")
        units = written(_sums(inner).where(F.col("length") <= room), "units")
        shortest, n_units = units.agg(F.min("length"), F.count(F.lit(1))).first()
        limit //= 2
        if not n_units:
            continue
        pairs, _, gaps, _ = _filled(units, gaps, shortest, n_units, capacity)
        gaps = written(gaps, "gaps")
        housed = written(_housed(inner, pairs), "housed")
        out.append(housed)
        left = written(left.join(housed.select("item"), "item", "left_anti"), "left")
    # As many ranges as the pieces would have had in bundles, so that few sequences stay open at a range's end.
    rows = max(tokens // (2 * small), n // 8)
    opened = written(_ranges(left, rows, "length", "item").mapInPandas(_opener(capacity), "item long, length long, bin long, offset long"), "opened")
    return [*out, opened.select("item", "length", F.col("bin").alias("sequence_id"), "offset")]


def packed_documents(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents, each with `sequence_id` and `offset`. Repeated rows are packed one by one."""
    pieces = written(token_pieces(docs, tokenizer_file, id_column, text, capacity).withColumn("item", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select("*", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    return full.unionByName(rest.join(packed(rest, capacity=capacity).drop("length"), "item")).drop("item")
