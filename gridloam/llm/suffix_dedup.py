"""Removal of long byte strings that occur more than once, by a distributed merge sort of suffixes.

Every window of 400 bytes holds an anchor: the 200 bytes in it with the least hash. Equal windows hold equal anchors at
the same place, so only the suffixes at anchors that occur twice are sorted, each with the bytes to its right and, read
backwards, to its left. Tasks sort their own suffixes into runs and exchange them front-coded by range; a loser tree
merges the runs, compares strings only behind the prefix they are known to share, and so learns the common prefix of
all neighbours. From these follows which windows around an anchor occur elsewhere.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from gridloam.llm.batches import mixed, slices, text_bytes
from gridloam.operators.skew import fits_broadcast, lookup_join
from gridloam.session import written

WINDOW = 400
ANCHOR = 200
SIDE = WINDOW - ANCHOR
SUFFIX = ANCHOR + 2 * SIDE
#: Stands behind the end of a text; no UTF-8 text holds it.
PAD = b"\xff"
RANGE_SUFFIXES = 20_000
RUN_SUFFIXES = 15_000
SAMPLE_PER_RANGE = 20
POSTINGS_PER_BUCKET = 500_000
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 256 << 10
WINDOWS_AT_ONCE = 20_000
# Bits for the windows asked for, whatever their number, and bytes in a slice of them.
ASKED_BITS, SLICE = 24, 4096
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
STEP_BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)

# A suffix is (key, text, place, left, right): `left` and `right` bytes of its sides are inside the text.
Suffix = tuple[bytes, int, int, int, int]
# Key and place of a bound that is no suffix: it comes before all suffixes of its anchor.
FIRST_KEY, NOWHERE = -(1 << 63), -1
BLOB = "part int, n int, shared binary, rest binary, text binary, place binary, left binary, right binary"
FOUND = "kind string, text_key long, place long, a long, b long, most int, suffix binary"


def text_key(text: Column) -> Column:
    """Equal texts share it, and share every result. NULL is the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(F.coalesce(text, F.lit(""))))


def _sliding(values: np.ndarray, width: int, best: np.ufunc, last: np.uint64) -> np.ndarray:
    """The best of each `width` values in a row."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, last, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(rows, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = np.ascontiguousarray(best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in `data` of the anchors of all windows that lie inside one text, and their hashes. Worked out in blocks
    that overlap by a window, so that memory is bounded however long a text is."""
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for begin in range(0, len(data) - WINDOW + 1, BLOCK_BYTES):
        block = data[begin : begin + BLOCK_BYTES + WINDOW - 1]
        at, hashes = _block_anchors(block, np.clip(offsets - begin, 0, len(block)))
        places.append(at + begin)
        found.append(hashes)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(found)[first]


def _block_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `anchors`, of one block."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, STEP)]))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * power[:-1])])
    back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - ANCHOR, STEP_BACK)]))
    hashes = mixed((total[ANCHOR:] - total[:-ANCHOR]) * back) >> np.uint64(1)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.arange(n)
    hashes[(at + ANCHOR > ends)[: len(hashes)]] = LAST
    least = _sliding(hashes, SIDE + 1, np.minimum, LAST)
    least[(at + WINDOW > ends)[: len(least)]] = 0
    padded = np.concatenate([np.zeros(SIDE, np.uint64), least, np.zeros(SIDE, np.uint64)])
    chosen = np.flatnonzero((_sliding(padded, SIDE + 1, np.maximum, np.uint64(0)) == hashes) & (hashes != LAST))
    return chosen, hashes[chosen]


def _postings(buckets: int):
    """Anchors of each slice by bucket of their hash. Of a hash that a slice holds more than once, one goes to its
    bucket and the others, known to be repeated, anywhere; so no bucket fills up with one hash."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE_BYTES):
                data, offsets = text_bytes(b.column("text"))
                at, hashes = anchors(data, offsets)
                owner = np.searchsorted(offsets, at, "right") - 1
                key = np.asarray(b.column("text_key"))[owner]
                place = (at - offsets[owner]).astype(np.int32)
                order = np.lexsort((place, key, hashes))
                hashes, key, place = hashes[order], key[order], place[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (key[1:] != key[:-1]) | (place[1:] != place[:-1])
                hashes, key, place = hashes[new], key[new], place[new]
                first = np.ones(len(hashes), bool)
                first[1:] = hashes[1:] != hashes[:-1]
                repeated = ~first
                repeated[:-1] |= ~first[1:]
                state = (repeated + 2 * (repeated & ~first)).astype(np.uint8)  # 0 once here, 1 its first of several, 3 another
                bucket = np.where(first, mixed(hashes), mixed(key.view(np.uint64) + place.astype(np.uint64))) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, ends = np.unique(bucket[order], return_index=True)
                cut = [order[i:j] for i, j in zip(ends, np.append(ends[1:], len(order)))]
                columns = [pa.array(bucket.astype(np.int32))]
                columns += [pa.array([v[c].tobytes() for c in cut], pa.binary()) for v in (hashes, key, place, state)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "hash", "key", "place", "state"])

    return packed


def _repeated(group: pd.DataFrame) -> pd.DataFrame:
    hashes, key, place, state = (np.concatenate([np.frombuffer(v, t) for v in group[c]]) for c, t in (("hash", np.uint64), ("key", np.int64), ("place", np.int32), ("state", np.uint8)))
    order = np.lexsort((place, key, hashes))
    hashes, key, place, state = hashes[order], key[order], place[order], state[order]
    same = np.concatenate([[False], hashes[1:] == hashes[:-1], [False]])
    alike = np.concatenate([[False], same[1:-1] & (key[1:] == key[:-1]) & (place[1:] == place[:-1]), [False]])
    start = np.flatnonzero(~same[:-1])
    # A hash counts as repeated if it has two different places here, or a slice has seen it twice.
    several = np.add.reduceat((~alike[:-1]).astype(int), start) > 1 if len(start) else np.zeros(0, bool)
    seen = np.maximum.reduceat(state, start) > 0 if len(start) else np.zeros(0, bool)
    keep = np.repeat(several | seen, np.diff(np.append(start, len(hashes)))) & ~alike[:-1]
    return pd.DataFrame({"text_key": key[keep], "place": place[keep]})


def suffix_at(text: bytes, place: int, key: int) -> Suffix:
    left, right = text[max(0, place - SIDE) : place], text[place + ANCHOR : place + WINDOW]
    return (text[place : place + ANCHOR] + right.ljust(SIDE, PAD) + left[::-1].ljust(SIDE, PAD), key, place, len(left), len(right))


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of two strings of one length that share `known` bytes already."""
    n = len(a)
    while known < n:
        x, y = a[known : known + 64], b[known : known + 64]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + len(x) - (differ.bit_length() + 7) // 8
        known += 64
    return n


def front_coded(run: list[Suffix], part: int) -> tuple:
    """A sorted run as what each string shares with the one before and what follows that."""
    shared, rest, before = [], [], None
    for s in run:
        k = shared_prefix(before, s[0], 0) if before is not None else 0
        shared.append(k)
        rest.append(s[0][k:])
        before = s[0]
    ids = [np.array([s[i] for s in run], t).tobytes() for i, t in ((1, np.int64), (2, np.int64), (3, np.int16), (4, np.int16))]
    return (part, len(run), np.array(shared, np.int16).tobytes(), zlib.compress(b"".join(rest), 3), *ids)


def _read(row: tuple, length: int) -> Iterator[tuple[int, Suffix]]:
    """A front-coded run as (bytes shared with the one before, suffix)."""
    _, _, shared, rest, text, place, left, right = row
    rest = zlib.decompress(rest)
    at, before = 0, b""
    for k, *own in zip(np.frombuffer(shared, np.int16).tolist(), *(np.frombuffer(v, t).tolist() for v, t in ((text, np.int64), (place, np.int64), (left, np.int16), (right, np.int16)))):
        before = before[:k] + rest[at : at + length - k]
        at += length - k
        yield k, (before, *own)


def merged(runs: list[Iterator[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """All runs in one order, each suffix with what it shares with the one before it.

    A loser tree whose entries know how much they share with the last winner: the one that shares more comes first,
    and only those that share equally much are compared, behind what they share.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (size - len(runs))
    shared = [0] * size
    items = [h[1] if h else None for h in heads]
    losers = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared length becomes that with the winner."""
        x, y = items[a], items[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        k = shared_prefix(x[0], y[0], shared[a])
        if x[0][k:] < y[0][k:] or (k == len(x[0]) and (x[1:3], a) < (y[1:3], b)):
            shared[b] = k
            return a, b
        shared[a] = k
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if size > 1 else 0
    while items[top] is not None:
        yield shared[top], items[top]
        head = next(runs[top], None)
        items[top], shared[top] = (head[1], head[0]) if head else (None, 0)
        node = (top + size) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _runs(suffixes: Iterator[Suffix], bounds: list[Suffix]) -> Iterator[tuple]:
    """Sorted runs of bounded size, cut at the bounds of the ranges and front-coded."""
    run: list[Suffix] = []

    def cut() -> Iterator[tuple]:
        run.sort()
        ends = [0, *(bisect_left(run, b) for b in bounds), len(run)]
        for part, (i, j) in enumerate(zip(ends, ends[1:])):
            if i < j:
                yield front_coded(run[i:j], part)
        run.clear()

    for s in suffixes:
        run.append(s)
        if len(run) >= RUN_SUFFIXES:
            yield from cut()
    yield from cut()


def in_order(group: pd.DataFrame, bounds: list[Suffix], length: int) -> Iterator[tuple[int, Suffix, bool]]:
    """The suffixes of one range, each once, with what it shares with the one before; last, the first of the next range."""
    part = int(group["part"].iloc[0])
    before = None
    carried = length
    for shared, s in merged([_read(r, length) for r in group.itertuples(index=False, name=None)]):
        carried = min(carried, shared)
        if before is None or s[1:3] != before[1:3] or carried < length:
            yield (carried if before is not None else 0), s, False
            before, carried = s, length
    if part < len(bounds):
        yield shared_prefix(before[0], bounds[part][0], 0), bounds[part], True


def sides(a: Suffix, b: Suffix, shared: int) -> tuple[int, int]:
    """How far two suffixes of one anchor agree to the right and to the left, inside both texts."""
    right = min(shared - ANCHOR, SIDE, a[4], b[4])
    left = shared - WINDOW if shared >= WINDOW else shared_prefix(a[0][WINDOW:], b[0][WINDOW:], 0)
    return right, min(left, a[3], b[3])


def resolved(group: list[Suffix], shared: list[int]) -> Iterator[tuple[Suffix, int, int]]:
    """All suffixes of one anchor, sorted: for each, the ranges of how far left of it repeated windows start.

    Exact: a window that starts `o` bytes left of the anchor is repeated if some other suffix agrees `o` bytes to the
    left and `200 - o` to the right. Neighbours by the right side and by the left side give most of them and bounds
    for the rest, which is counted window by window.
    """
    heads: list[Suffix] = []
    copies: list[list[Suffix]] = []
    behind: list[int] = []
    for s, k in zip(group, shared):
        if heads and k == SUFFIX:
            copies[-1].append(s)
        else:
            heads.append(s)
            copies.append([s])
            behind.append(k)
    n = len(heads)
    most_right, most_left = [0] * n, [0] * n
    found: list[set[tuple[int, int]]] = [set() for _ in range(n)]

    def meet(i: int, j: int, right: int, left: int) -> None:
        for k in (i, j):
            most_right[k], most_left[k] = max(most_right[k], right), max(most_left[k], left)
            if right + left >= SIDE:
                found[k].add((SIDE - right, left))

    for i in range(1, n):
        meet(i - 1, i, *sides(heads[i - 1], heads[i], behind[i]))
    if n > 2:
        by_left = sorted(range(n), key=lambda i: (heads[i][0][WINDOW:], heads[i][0][ANCHOR:WINDOW]))
        for i, j in zip(by_left, by_left[1:]):
            a, b = heads[i], heads[j]
            left = min(shared_prefix(a[0][WINDOW:], b[0][WINDOW:], 0), a[3], b[3])
            meet(i, j, min(shared_prefix(a[0][ANCHOR:WINDOW], b[0][ANCHOR:WINDOW], 0), a[4], b[4]), left)
    asked: dict[int, list[int]] = {}
    for i, (s, own) in enumerate(zip(heads, copies)):
        if len(own) > 1:
            # Copies of the whole suffix: every window around them that lies in the text is repeated.
            found[i] = {(SIDE - s[4], s[3])} if s[3] + s[4] >= SIDE else set()
            continue
        for low, high in gaps(found[i], SIDE - most_right[i], most_left[i]):
            for o in range(low, high + 1):
                asked.setdefault(o, []).append(i)
    for o, who in asked.items():
        # No head agrees with another further than with its neighbours, so few can hold a repeated window here.
        seen = Counter(window_of(s, o) for s, right, left in zip(heads, most_right, most_left) if left >= o and right >= SIDE - o)
        for i in who:
            # A head with copies counts once here; one without needs any other head.
            if seen[window_of(heads[i], o)] > 1:
                found[i].add((o, o))
    for own, ranges in zip(copies, found):
        for low, high in united([(a, b + 1) for a, b in ranges]):
            for s in own:
                yield s, low, high - 1


def window_of(s: Suffix, o: int) -> bytes:
    """What a window that starts `o` bytes left of the anchor holds besides the anchor."""
    return s[0][WINDOW : WINDOW + o] + s[0][ANCHOR : WINDOW - o]


def gaps(ranges: set[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    """What of `low` to `high` no range covers."""
    out = []
    for a, b in sorted(ranges):
        if a > low:
            out.append((low, min(a - 1, high)))
        low = max(low, b + 1)
        if low > high:
            break
    if low <= high:
        out.append((low, high))
    return [g for g in out if g[0] <= g[1]]


def _anchor_groups(bounds: list[Suffix]):
    """Of one range: repeated stretches around its anchors. Anchors that reach over an end of the range are passed on,
    with what their neighbours by the right side show."""

    def found(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        edges = {b[0][:ANCHOR] for b in bounds[max(part - 1, 0) : part + 1] if b[2] != NOWHERE}
        out: list[tuple] = []
        covers: dict[int, list[tuple[int, int]]] = {}
        members: list[Suffix] = []
        shared: list[int] = []
        foreign = False

        def end() -> None:
            if not members:
                return
            if members[0][0][:ANCHOR] not in edges:
                if len(members) > 1:
                    for s, low, high in resolved(members, shared):
                        covers.setdefault(s[1], []).append((s[2] - high, s[2] - low + WINDOW))
                return
            for i in range(1, len(members)):
                right, left = sides(members[i - 1], members[i], shared[i])
                out.extend(_near(s, right, left, right) for s in members[i - 1 : i + 1])
            for s in members[: len(members) - foreign]:
                out.append(("suffix", s[1], s[2], s[3], s[4], None, s[0]))

        for k, s, foreign_now in in_order(group, bounds, SUFFIX):
            if members and k < ANCHOR:
                end()
                members, shared, foreign = [], [], False
            members.append(s)
            shared.append(k)
            foreign = foreign_now
        if not (foreign and len(members) == 1):
            end()
        for key, spans in covers.items():
            out.extend(("cover", key, a, b, None, None, None) for a, b in united(spans))
        return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    return found


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches joined where they meet."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _near(s: Suffix, right: int, left: int, most: int) -> tuple:
    fits = right + left >= SIDE
    return ("near", s[1], s[2], SIDE - right if fits else 1, left if fits else 0, most, None)


def _bounds(sample: DataFrame, parts: int) -> list[Suffix]:
    """Suffixes that part a sample into about `parts` ranges of like size. The sample is sorted by Spark, and only every
    so many of it comes to the driver."""
    ordered = sample.distinct().orderBy("suffix", "text_key", "place").withColumn("nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    some = ordered.where(F.col("nth") % SAMPLE_PER_RANGE == SAMPLE_PER_RANGE // 2).collect()
    picked = sorted((bytes(r["suffix"]), r["text_key"], r["place"], r["a"], r["b"]) for r in some)
    return sorted({picked[len(picked) * k // parts] for k in range(1, parts)}) if picked else []


def before_anchors(bounds: list[Suffix]) -> list[Suffix]:
    """`bounds` with the first one of each anchor put before all suffixes of the anchor, so that only an anchor with
    suffixes for more than a range reaches over an end of one."""
    out: list[Suffix] = []
    for b in bounds:
        new = not out or out[-1][0][:ANCHOR] != b[0][:ANCHOR]
        out.append((b[0][:ANCHOR].ljust(SUFFIX, b"\0"), FIRST_KEY, NOWHERE, 0, 0) if new else b)
    return out


def _over_ranges(passed: DataFrame, parts: int) -> DataFrame:
    """Anchors with suffixes in several ranges: sorted once more by their left side, and what both sides leave open
    sorted window by window. Returns text_key, start and end of repeated stretches."""
    suffixes = passed.where("kind = 'suffix'").select("text_key", "place", "a", "b", "suffix")
    if suffixes.isEmpty():
        return suffixes.select("text_key", F.col("place").alias("start"), F.col("a").alias("end"))
    turned = suffixes.select(F.concat(F.expr(f"substring(suffix, 1, {ANCHOR})"), F.expr(f"substring(suffix, {WINDOW + 1}, {SIDE})"), F.expr(f"substring(suffix, {ANCHOR + 1}, {SIDE})")).alias("suffix"), "text_key", "place", "a", "b")

    def by_left(bounds: list[Suffix]):
        def near(group: pd.DataFrame) -> pd.DataFrame:
            out, before = [], None
            for k, s, _ in in_order(group, bounds, SUFFIX):
                if before is not None and k >= ANCHOR:
                    left = min(k - ANCHOR, SIDE, before[3], s[3])
                    right = min(k - WINDOW if k >= WINDOW else shared_prefix(before[0][WINDOW:], s[0][WINDOW:], 0), before[4], s[4])
                    out += [_near(x, right, left, left) for x in (before, s)]
                before = s
            return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

        return near

    left = written(_resorted(turned, parts, by_left, FOUND, SUFFIX), "by-left")

    def agreed(near: DataFrame, name: str) -> DataFrame:
        return near.where("kind = 'near'").groupBy("text_key", "place").agg(F.max("most").alias(name), F.collect_set(F.when(F.col("a") <= F.col("b"), F.struct("a", "b"))).alias(f"{name}_ranges"))

    both = agreed(passed, "right").join(agreed(left, "left"), ["text_key", "place"], "full")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, place, right, r1, most_left, r2 in b[["text_key", "place", "right", "right_ranges", "left", "left_ranges"]].itertuples(index=False, name=None):
                ranges = {(r["a"], r["b"]) for rs in (r1, r2) if rs is not None for r in rs}
                right, most_left = (0 if v is None or v != v else int(v) for v in (right, most_left))
                out += [(key, place, lo, hi, "cover") for lo, hi in ranges]
                out += [(key, place, lo, hi, "open") for lo, hi in gaps(ranges, SIDE - right, most_left)]
                if SIDE - right <= most_left:
                    out.append((key, place, SIDE - right, most_left, "fits"))
            yield pd.DataFrame(out, columns=["text_key", "place", "low", "high", "kind"])

    judged = written(both.mapInPandas(judge, "text_key long, place long, low int, high int, kind string"), "judged")
    cover = judged.where("kind = 'cover'").select("text_key", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + WINDOW).alias("end"))
    anchored = suffixes.select("text_key", "place", "suffix", F.md5(F.expr(f"substring(suffix, 1, {ANCHOR})")).alias("anchor"))
    # The windows asked for, at most 201 of an anchor, and only from suffixes that agree with a neighbour that far.
    asked = judged.where("kind = 'open'").join(anchored.select("text_key", "place", "anchor"), ["text_key", "place"]).select("anchor", F.explode(F.sequence("low", "high")).alias("o")).distinct()
    asked = written(asked.groupBy("anchor").agg(F.collect_set("o").alias("asked")), "asked")
    if asked.isEmpty():
        return cover
    # One of several equal suffixes stands for all: neighbours have settled them, they only show others what is repeated.
    fits = judged.where("kind = 'fits'").join(anchored, ["text_key", "place"]).groupBy("anchor", F.md5("suffix").alias("copy"))
    fits = fits.agg(F.min(F.struct("text_key", "place", "low", "high", "suffix")).alias("one")).select("anchor", "one.*")
    wanted = F.filter("asked", lambda o: o.between(F.col("low"), F.col("high")))
    spread = lookup_join(fits, asked, ["anchor"], "inner").select("suffix", "text_key", "place", wanted.alias("wanted")).where(F.size("wanted") > 0)
    own = judged.where("kind = 'open'").join(anchored, ["text_key", "place"]).select("suffix", "text_key", "place", F.sequence("low", "high").alias("wanted"))
    bits = np.zeros(1 << ASKED_BITS >> 3, np.uint8)
    for r in own.mapInPandas(_marked, "slice int, bits binary").groupBy("slice").agg(F.bitmap_or_agg("bits").alias("bits")).collect():
        bits[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["bits"], np.uint8)
    among = _windows_among(suffixes.sparkSession.sparkContext.broadcast(bits))
    windows = spread.repartition(parts, "text_key", "place").mapInPandas(among, "window binary, text_key long, start long")
    windows = written(windows.distinct(), "windows")
    twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    held = lookup_join(windows, twice, ["window"], "left_semi")
    return cover.unionByName(held.select("text_key", "start", (F.col("start") + WINDOW).alias("end")))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """128-bit hashes of the wanted windows around each suffix's anchor, and where they start; a bounded number at a time."""
    names, out = ["window", "text_key", "start"], []
    for b in batches:
        for s, key, place, wanted in zip(map(bytes, b["suffix"]), b["text_key"], b["place"], b["wanted"]):
            out += [(blake2b(s[WINDOW : WINDOW + o][::-1] + s[: WINDOW - o], digest_size=16).digest(), key, place - o) for o in wanted.tolist()]
            if len(out) >= WINDOWS_AT_ONCE:
                yield pd.DataFrame(out, columns=names)
                out = []
    yield pd.DataFrame(out, columns=names)


def _bit(windows: pd.Series) -> np.ndarray:
    return np.array([int.from_bytes(w[:3], "big") for w in windows], np.int64) & ((1 << ASKED_BITS) - 1)


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One bit for each window that is asked for, in slices."""
    bits = np.zeros(1 << ASKED_BITS >> 3, np.uint8)
    for b in _windows(batches):
        at = _bit(b["window"])
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    parts = bits.reshape(-1, SLICE)
    held = np.flatnonzero(parts.any(axis=1))
    yield pd.DataFrame({"slice": held.astype(np.int32), "bits": [parts[k].tobytes() for k in held]})


def _windows_among(asked):
    """As `_windows`, but only those whose bit is set; windows that nobody asks for are rarely among them."""

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _windows(batches):
            at = _bit(b["window"])
            yield b[(asked.value[at >> 3] >> (at & 7)) & 1 == 1]

    return held


def _resorted(rows: DataFrame, parts: int, handle, schema: str, length: int) -> DataFrame:
    """Sort rows of suffix, text_key, place, a, b by the same merge sort."""
    bounds: list[Suffix] = []
    if parts > 1:
        n = max(rows.count(), 1)
        share = SAMPLE_PER_RANGE * parts / n
        bounds = _bounds(rows.where(F.pmod(F.xxhash64("text_key", "place"), F.lit(1 << 20)) < F.lit(share * (1 << 20))), parts)

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        suffixes = ((bytes(s), *ids) for b in batches for s, *ids in b[["suffix", "text_key", "place", "a", "b"]].itertuples(index=False, name=None))
        for r in _runs(suffixes, bounds):
            yield pd.DataFrame([r], columns=[c.split()[0] for c in BLOB.split(", ")])

    return rows.mapInPandas(runs, BLOB).groupBy("part").applyInPandas(handle(bounds), schema)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffix]:
    for b in batches:
        for key, text, places in zip(b.column("text_key").to_pylist(), b.column("text"), b.column("places").to_pylist()):
            whole = text.as_py().encode()
            for p in places:
                yield suffix_at(whole, p, key)


def repeated_stretches(docs: DataFrame, text: str = "text", *, range_suffixes: int = RANGE_SUFFIXES) -> DataFrame:
    """`text_key` and `spans` (sorted, apart; start and end in bytes) of every text that holds repeated strings."""
    told_apart = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (MapType, VariantType))))
    rows = docs.select(text_key(F.col(f"`{text}`")).alias("text_key"), told_apart.alias("row"), F.col(f"`{text}`").alias("text")).where(F.octet_length("text") >= WINDOW)
    copies = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).cast("long").alias("end"), F.min("row").alias("row"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (SIDE // 2 * POSTINGS_PER_BUCKET)))
    postings = rows.mapInArrow(_postings(buckets), "bucket int, hash binary, key binary, place binary, state binary")
    candidates = written(postings.groupBy("bucket").applyInPandas(_repeated, "text_key long, place int"), "anchors")
    n = candidates.count()
    parts = max(1, -(-n // range_suffixes))
    copies = written(copies, "copies")

    def grouped(chosen: DataFrame) -> DataFrame:
        """Places by text, for one row of each text (equal rows may come twice, and count once)."""
        places = chosen.groupBy("text_key").agg(F.sort_array(F.collect_set("place")).alias("places"))
        return written(places.join(copies.select("text_key", "row"), "text_key"), "places")

    def with_text(chosen: DataFrame) -> DataFrame:
        small = fits_broadcast(chosen)
        return rows.join(F.broadcast(chosen) if small else chosen, ["text_key", "row"]).select("text_key", "text", "places")

    bounds: list[Suffix] = []
    if parts > 1:
        share = SAMPLE_PER_RANGE * parts / n
        some = grouped(candidates.where(F.pmod(F.xxhash64("text_key", "place"), F.lit(1 << 20)) < F.lit(share * (1 << 20))))
        bounds = _bounds(with_text(some).mapInArrow(_plain, "suffix binary, text_key long, place long, a long, b long"), parts)
        bounds = before_anchors(bounds)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in BLOB.split(", ")]
        for r in _runs(_suffixes(batches), bounds):
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if i < 2 else pa.binary()) for i, v in enumerate(r)], names)

    found = written(with_text(grouped(candidates)).mapInArrow(runs, BLOB).groupBy("part").applyInPandas(_anchor_groups(bounds), FOUND), "found")
    cover = found.where("kind = 'cover'").select("text_key", F.col("place").alias("start"), F.col("a").alias("end"))
    if parts > 1:
        cover = cover.unionByName(_over_ranges(found, parts))
    # Of a text that occurs twice everything is repeated.
    twice = copies.where("n > 1").select("text_key", F.lit(0).cast("long").alias("start"), "end")
    spans = cover.unionByName(twice).groupBy("text_key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def join_up(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        grown = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] >= s["start"]), grown).otherwise(F.concat(a, F.array(s)))

    return spans.select("text_key", F.aggregate("spans", none, join_up).alias("spans"))


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = list(_suffixes([b]))
        yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in got], pa.binary() if i == 0 else pa.int64()) for i in range(5)], ["suffix", "text_key", "place", "a", "b"])


def _kept_function():
    @F.arrow_udf("binary")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, ranges in zip(texts, spans.to_pylist()):
            whole, at, parts = (t.as_py() or "").encode(), 0, []
            for r in ranges or ():
                parts.append(whole[at : r["start"]])
                at = r["end"]
            out.append(b"".join([*parts, whole[at:]]))
        return pa.array(out, pa.binary())

    return kept


def without_repeats(docs: DataFrame, text: str = "text", *, range_suffixes: int = RANGE_SUFFIXES) -> DataFrame:
    """`docs` with `spans` (the byte ranges removed) and `kept` (the remaining bytes) added or put in place.

    Every byte covered by a string of 400 bytes that starts at another place too, in the same text or another, is
    removed; matches do not cross texts, and are judged on the input. NULL is the empty text. Repeated rows are copies of
    each other. Cutting bytes may split a character.
    """
    found = repeated_stretches(docs, text, range_suffixes=range_suffixes).select(F.col("text_key").alias("_llm_key"), F.col("spans").alias("_llm_spans"))
    found = written(found, "spans")
    small = fits_broadcast(found)
    keyed = docs.withColumn("_llm_key", text_key(F.col(f"`{text}`")))
    joined = keyed.join(F.broadcast(found) if small else found, "_llm_key", "left")
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = joined.withColumn("_llm_spans", F.coalesce("_llm_spans", empty))
    out = joined.withColumn("_llm_kept", _kept_function()(F.col(f"`{text}`"), F.col("_llm_spans")))
    return out.withColumns({"spans": F.col("_llm_spans"), "kept": F.col("_llm_kept")}).drop("_llm_key", "_llm_spans", "_llm_kept")


def _decoded():
    @F.arrow_udf("string")
    def decoded(kept: pa.Array) -> pa.Array:
        return pa.array([k.as_py().decode("utf-8", "ignore") for k in kept], pa.string())

    return decoded


def with_repeats_cut(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the repeated strings cut out of `text`; what a cut leaves of a split character goes too. No row is
    dropped, a NULL text stays NULL."""
    columns = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    own = f"c{columns.index(text)}"
    got = without_repeats(inner, own)
    got = got.withColumn(own, F.when(F.size("spans") > 0, _decoded()(F.col("kept"))).otherwise(F.col(own)))
    return got.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
