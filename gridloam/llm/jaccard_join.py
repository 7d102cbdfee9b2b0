"""Similarity join of documents on sets of 5-word shingles, with prefix filters under several token orders.

Under any one order of all tokens, two sets that are similar enough share a token among the first few of each. The
order puts tokens that many documents hold last (frequencies come from a counting sketch over all documents) and gives
the candidate pairs. Every set has a sketch of one bit for each token or two, and no similar sets differ in more bits
than in tokens; a pair that does is dropped before any set is fetched. Documents with equal sets are one class, and
pairs within a component already found are not compared again, so that a group of n copies costs n, not n * n; no link
between different components is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloam.llm.batches import byte_set, mixed, row_key, slices, text_bytes, windows, words
from gridloam.llm.components import components
from gridloam.operators.skew import fits_broadcast
from gridloam.session import written

SHINGLE = 5
PERCENT = 75
# Word bytes: all but space, tab, line feed, vertical tab, form feed and carriage return.
LETTERS = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# The sketch: so many counters whatever the input, kept in so many slices.
COUNTER_BITS, SLICE_BITS = 22, 16
# A sketch has at least as many bits, and otherwise one to two for each token of its set.
BITS = 512
# Neighbours in size are compared first, for the first tokens of each set only; the rest is for the second pass.
FIRST_TOKENS = 8
# Passes over neighbours, each in orders of its own, before what is left is compared pair by pair; none once that is at
# most so many pairs for each posting left.
NEIGHBOUR_PASSES = 3
FEW_PAIRS = 16
POSTINGS_PER_BUCKET = 500_000
ORDERS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of each text, with repeats, and the text each belongs to. A text with fewer
    than five words is one shingle, one without words none."""
    hashes, _, first = words(*text_bytes(texts), LETTERS)
    found, ends = windows(hashes, first, SHINGLE)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    for n in range(1, SHINGLE):
        few = np.flatnonzero(np.diff(first) == n)
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for k in range(n):
                whole = mixed(whole * ORDERS[0] + hashes[first[few] + k] + np.uint64(100 * n + k))
            found, owner = np.concatenate([found, whole]), np.concatenate([owner, few])
    return found, owner


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many first tokens of a set of `n` any similar set must meet."""
    return n - -(-n * PERCENT // 100) + 1


def ordered_sets(texts: pa.Array, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of each text in the first order; where each text's start; its size; its class."""
    found, owner = shingles(texts)
    level = levels[(found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64)
    place = level << np.uint64(58) | mixed(found ^ ORDERS[0]) >> np.uint64(6)
    # By place, then by text: as one lexsort, but the second sort is by few small numbers.
    order = np.argsort(place)
    order = order[np.argsort(owner[order].astype(np.min_scalar_type(len(texts))), kind="stable")]
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    size = np.bincount(owner, minlength=len(texts))
    start = np.concatenate([[0], np.cumsum(size)])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(found + ORDERS[1]))])
    return found, start, size, mixed(total[start[1:]] - total[start[:-1]] + size.astype(np.uint64)).view(np.int64)


def _levels(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How far above the common noise each counter of the sketch is (0: a rare token), and the number of shingles."""
    size = 1 << SLICE_BITS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.int64)
        for whole in batches:
            for b in slices(whole, "text"):
                at = (shingles(b.column("text"))[0] >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                np.add.at(counts, at, 1)
        parts = counts.reshape(-1, size)
        kept = [k for k in range(len(parts)) if parts[k].any()]
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in kept], pa.binary())], ["slice", "counts"])

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in group["counts"])
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "slice int, counts binary"
    parts = rows.select("text").mapInArrow(counted, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    partly = parts.groupBy("slice", "part").applyInPandas(summed, schema)
    levels, total = np.zeros(1 << COUNTER_BITS, np.uint8), 0
    for r in partly.groupBy("slice").applyInPandas(summed, schema).collect():
        counts = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
        common = float(np.median(counts))
        excess = (counts - common) / (4 * np.sqrt(common) + 4)
        levels[r["slice"] * size : (r["slice"] + 1) * size] = np.where(excess > 1, np.minimum(2 + np.log2(np.maximum(excess, 1)), 40), 0).astype(np.uint8)
        total += int(counts.sum())
    return levels, total


def _postings(shared, buckets: int):
    """Prefix tokens of each class, packed by bucket. A frequent token is dealt over buckets, more the more frequent."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "prefix"):
                key, one = np.unique(np.asarray(b.column("key")), return_index=True)
                prefixes = b.column("prefix").take(pa.array(one))
                length = np.asarray(pc.binary_length(prefixes)).astype(np.int64) // 8
                token = np.frombuffer(b"".join(prefixes.to_pylist()), np.uint64)
                owner = np.repeat(np.arange(len(key)), length)
                owner_key, owner_size = key[owner], np.asarray(b.column("n_shingles"))[one][owner]
                rank = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
                level = shared.value[(token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64)
                salt = mixed(token ^ owner_key.view(np.uint64)) & ((np.uint64(1) << level) - np.uint64(1))
                bucket = (mixed(token + salt * ORDERS[2]) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, ends = np.unique(bucket[order], return_index=True)
                ends = np.append(ends, len(order))
                cut = [order[i:j] for i, j in zip(ends, ends[1:])]
                hot = (level > 0).astype(np.uint8)
                columns = [pa.array(bucket, pa.int32())]
                columns += [pa.array([values[c].tobytes() for c in cut], pa.binary()) for values in (token, owner_key, owner_size.astype(np.int32), rank.astype(np.int32), hot)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "token", "key", "size", "rank", "hot"])

    return packed


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the postings whose token others may hold too, each with the nearest in size before it if the token
    is among the first of both."""
    kinds = (("token", np.int64), ("key", np.int64), ("size", np.int32), ("rank", np.int32), ("hot", np.uint8))
    token, key, size, rank, hot = (np.concatenate([np.frombuffer(v, t) for v in group[c]]) for c, t in kinds)
    order = np.lexsort((key, size, token))
    token, key, size, rank, hot = token[order], key[order], size[order], rank[order], hot[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    token, key, size, rank, hot = token[new], key[new], size[new], rank[new], hot[new]
    same = np.zeros(len(token) + 1, bool)
    same[1:-1] = token[1:] == token[:-1]
    kept = same[:-1] | same[1:] | (hot > 0)
    early = np.maximum(rank, np.roll(rank, 1)) < FIRST_TOKENS
    before = np.where(same[:-1] & early, np.roll(key, 1), key)
    return pd.DataFrame({"token": token[kept], "key": key[kept], "size": size[kept], "rank": rank[kept], "before": before[kept], "size_before": np.roll(size, 1)[kept]})


def _sets_of(docs: DataFrame, members: DataFrame, keys: DataFrame) -> DataFrame:
    """Token sets of classes, from the text of one member each (equal rows may give a set twice): the tokens stirred,
    sorted. Documents are shuffled only if the classes are too many to be broadcast."""
    chosen = written(members.join(keys, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row")), "chosen")
    texts = docs.select("row", "text").join(F.broadcast(chosen) if fits_broadcast(chosen) else chosen, "row").select("key", "text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                found, start, _, _ = ordered_sets(b.column("text"), np.zeros(1 << COUNTER_BITS, np.uint8))
                second = [np.sort(mixed(found[i:j] ^ ORDERS[1])).tobytes() for i, j in zip(start, start[1:])]
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(second, pa.binary())], ["key", "tokens"])

    return texts.mapInArrow(made, "key long, tokens binary")


def similar(a: bytes, b: bytes) -> bool:
    """Whether two whole sets are similar."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.loc[[similar(*r) for r in zip(b["a"], b["b"])], ["u", "v"]]

    left = sets.select(F.col("key").alias("u"), F.col("tokens").alias("a"))
    right = sets.select(F.col("key").alias("v"), F.col("tokens").alias("b"))
    return pairs.join(left, "u").join(right, "v").mapInPandas(check, "u long, v long")


def sketches(found: np.ndarray, start: np.ndarray) -> list[bytes]:
    """Of each set, as bits: whether an odd number of its tokens falls on each bit."""
    size = np.diff(start)
    bits = np.array([max(BITS, 1 << int(n).bit_length()) for n in size], np.int64)
    begin = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(size)), size)
    at = (mixed(found ^ ORDERS[2]) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64) + begin[owner]
    packed = np.packbits((np.bincount(at, minlength=begin[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[i:j] for i, j in zip((begin // 8).tolist(), (begin[1:] // 8).tolist())]


def folded(sketch: bytes, size: int) -> bytes:
    """The sketch that the same set has in `size` bytes, no more than it has now."""
    return sketch if len(sketch) == size else np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0).tobytes()


def may_be_similar(a: bytes, b: bytes, total: int) -> bool:
    """Whether two sketches allow their sets, of `total` tokens together, to be similar. Each token that only one set
    holds turns one bit, so sets differ in at least as many tokens as their sketches in bits."""
    size = min(len(a), len(b))
    differ = (int.from_bytes(folded(a, size), "little") ^ int.from_bytes(folded(b, size), "little")).bit_count()
    return (100 + PERCENT) * differ <= (100 - PERCENT) * total


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of candidate pairs those whose sketches allow them to be similar."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.loc[[may_be_similar(*r) for r in zip(b["a"], b["b"], b["n"] + b["m"])], ["u", "v"]]

    left = classes.select(F.col("key").alias("u"), F.col("sketch").alias("a"), F.col("n_shingles").alias("n"))
    right = classes.select(F.col("key").alias("v"), F.col("sketch").alias("b"), F.col("n_shingles").alias("m"))
    return pairs.join(left, "u").join(right, "v").mapInPandas(check, "u long, v long")


def _met_early():
    """Whether the common token is early enough in the smaller set; of two sets of one size in either."""

    def early(size: str, place: str):
        return F.col(place) < F.col(size) - F.ceil(F.col(size) * (2 * PERCENT) / (100 + PERCENT)) + 1

    return F.when(F.col("s1") < F.col("s2"), early("s1", "p1")).when(F.col("s1") > F.col("s2"), early("s2", "p2")).otherwise(early("s1", "p1") & early("s2", "p2"))


def _near_in_size(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _mixed_up(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings of the tokens whose sets lie in several components: each with its root, and of the token the component
    that holds most of its sets (`main`) and their number (`held`)."""
    labelled = postings.select("token", "key", "size", "rank").join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("token")
    labelled = written(labelled.join(several, "token", "left_semi"), "labelled")
    held = labelled.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.sum("n").alias("held"), F.max(F.struct("n", "root"))["root"].alias("main"))
    return written(labelled.join(held, "token"), "mixed")


def _crossing(mixed_up: DataFrame) -> DataFrame:
    """All pairs of sets of one token in different components, near in size and with the token early enough."""
    other = mixed_up.where("root != main").select("token", F.col("key").alias("k1"), F.col("size").alias("s1"), F.col("rank").alias("p1"), F.col("root").alias("r1"))
    every = mixed_up.select("token", "main", F.col("key").alias("k2"), F.col("size").alias("s2"), F.col("rank").alias("p2"), F.col("root").alias("r2"))
    once = (F.col("r2") == F.col("main")) | (F.col("k1") < F.col("k2"))
    return other.join(every, "token").where((F.col("r1") != F.col("r2")) & once & _near_in_size("s1", "s2") & _met_early())


def _crossing_neighbours(mixed_up: DataFrame, step: int) -> DataFrame:
    """Of those the pairs that stand next to each other in an order of the token's own; dealt over parts, other ones at
    each step, so that no token is one task's work and sets apart in one step may meet in the next."""
    order = Window.partitionBy("token", F.pmod(F.xxhash64("key", F.lit(step)), F.lit(64))).orderBy(F.xxhash64("key", "token", F.lit(step)), "key")
    before = {f"{c}1": F.lag(name).over(order) for c, name in (("k", "key"), ("s", "size"), ("p", "rank"), ("r", "root"))}
    pairs = mixed_up.withColumns(before).withColumnsRenamed({"key": "k2", "size": "s2", "rank": "p2", "root": "r2"})
    return pairs.where((F.col("r1") != F.col("r2")) & _near_in_size("s1", "s2") & _met_early())


def _linked(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per row of `docs`: id, row, n_shingles, root (of its component of classes) and component_id."""
    spark = docs.sparkSession
    id_type = docs.select(f"`{id_column}`").schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), row_key(id_column, text).alias("row"))
    levels, total = _levels(rows)
    shared = spark.sparkContext.broadcast(levels)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                found, start, size, key = ordered_sets(b.column("text"), shared.value)
                ends = start[:-1] + np.where(size > 0, prefix_length(size), 0)
                first = [found[i:j].tobytes() for i, j in zip(start.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), pa.array(size, pa.int64()), pa.array(key, pa.int64()), pa.array(sketches(found, start), pa.binary()), pa.array(first, pa.binary())], ["id", "row", "n_shingles", "key", "sketch", "prefix"])

    members = written(rows.mapInArrow(classed, f"id {id_type}, row long, n_shingles long, key long, sketch binary, prefix binary"), "members")
    buckets = max(1, -(-total // (4 * POSTINGS_PER_BUCKET)))
    postings = members.select("key", "n_shingles", "prefix").mapInArrow(_postings(shared, buckets), "bucket int, token binary, key binary, size binary, rank binary, hot binary")
    live = written(postings.groupBy("bucket").applyInPandas(_shared, "token long, key long, size int, rank int, before long, size_before int"), "postings")

    sketched = members.join(live.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"))
    sketched = written(sketched, "sketches")
    near = live.where("before != key").where(_near_in_size("size", "size_before"))
    first = written(_possible(near.select(F.least("key", "before").alias("u"), F.greatest("key", "before").alias("v")).distinct(), sketched), "pairs")
    named = rows.select("row", "text")
    sets = written(_sets_of(named, members, first.select(F.col("u").alias("key")).unionByName(first.select(F.col("v").alias("key"))).distinct()), "sets")
    links = written(_verified(first, sets), "links")
    roots = written(components(links), "roots")

    # What is left: pairs that share a token but lie in different components so far. Where these are many, first again
    # neighbours only, in other orders and for all tokens, which joins a large group at the cost of its size; then every
    # pair. A token whose sets are all in one component is done with, for components only grow.
    seen, mixed_up, step, last = first, live, 0, False
    while True:
        mixed_up = _mixed_up(mixed_up, roots)
        left = mixed_up.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col("root") != F.col("main"), F.col("held"))).alias("pairs")).first()
        if not left["rows"]:
            break
        last = last or left["pairs"] <= FEW_PAIRS * left["rows"]
        crossed = (_crossing(mixed_up) if last else _crossing_neighbours(mixed_up, step)).select(F.least("k1", "k2").alias("u"), F.greatest("k1", "k2").alias("v")).distinct()
        fresh = written(_possible(crossed.join(seen, ["u", "v"], "left_anti"), sketched), "pairs")
        joined = False
        if not fresh.isEmpty():
            keys = fresh.select(F.col("u").alias("key")).unionByName(fresh.select(F.col("v").alias("key"))).distinct()
            more = written(_verified(fresh, written(_sets_of(named, members, keys), "sets")), "links")
            links, seen = links.unionByName(more), seen.unionByName(fresh)
            joined = not more.isEmpty()
        if joined:
            roots = written(components(links), "roots")
        if last:
            break
        step += 1
        last = not joined or step == NEIGHBOUR_PASSES

    classes = members.where("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least"))
    rooted = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    final = rooted.join(whole, "root").select("key", "root", "component_id")
    out = members.join(final, "key", "left")
    return out.select("id", "row", "n_shingles", "root", F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def linked_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, `n_shingles`, and `component_id`, the smallest id reachable by links.

    Words are runs of bytes other than white space, A-Z as a-z; two documents link when 100 * intersection >= 75 *
    union. A NULL, empty or blank text has no shingles and links with nothing, its component is its own id. Rows
    without an id take part; a component of such rows only has none. Sets are compared by 64-bit hashes of shingles.
    """
    return _linked(docs, id_column, text).select(F.col("id").alias(id_column), "n_shingles", "component_id")


def one_per_component(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest id of each component, and every row without shingles. Rows equal in id and text count
    as copies of each other; rows without an id stay only where their component has no other."""
    linked = written(_linked(docs, id_column, text).where("n_shingles > 0"), "linked")
    best = linked.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("best"))
    judged = linked.join(best, "root")
    dropped = written(judged.where("row != best").select(F.col("row").alias("_llm_row")).distinct(), "dropped")
    again = written(judged.where("row = best").groupBy(F.col("row").alias("_llm_row")).count().where("count > 1").select("_llm_row"), "again")
    keyed = docs.withColumn("_llm_row", row_key(id_column, text))
    keyed = keyed.join(F.broadcast(dropped) if fits_broadcast(dropped) else dropped, "_llm_row", "left_anti")
    if again.limit(1).count():
        few = F.broadcast(again) if fits_broadcast(again) else again
        keyed = keyed.join(few, "_llm_row", "left_anti").unionByName(keyed.join(few, "_llm_row", "left_semi").dropDuplicates(["_llm_row"]))
    return keyed.drop("_llm_row")
