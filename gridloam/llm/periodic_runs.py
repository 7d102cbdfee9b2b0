"""Periodic runs: stretches of words that repeat with a short period, found and collapsed.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 q) words long, that no neighbouring
word extends keeping the period. Words are appended one by one to a suffix automaton. Its tree of suffix links is
held as a link-cut tree whose preferred paths are the stretches of states last seen at the same word: appending word
i recolours the path from the new state to the root, and each stretch met on the way, last seen at word e and at most
m words long, says that the m words up to i are also the m words up to e and no more. If m is at least i - e that is
a square of period i - e, and the repeat begins at word e - m + 1; the word that ends it last closes the run.

In front of a run's last period every word comes again within that period. So only stretches of words that come again
soon enough are appended; which ones they are is worked out with numpy for a batch of texts at once, for periods up
to 1, 2, 4, 8 and so on words. That leaves all runs whole, at any period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridloam.llm.batches import STEP, byte_set, mixed, slices, text_bytes

LEAST_WORDS, LEAST_PERIODS = 6, 4
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
# Each byte's share in a word's hash; upper and lower case differ.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
ARROW_RUN, ARROW_FOUND = to_arrow_type(RUN), to_arrow_type(FOUND)


class Appended:
    """A suffix automaton over appended words. State 1 is the root, 0 stands for none.

    `up` is a state's parent in its splay tree or, at that tree's root, the suffix link of the shallowest state of the
    path; `seen`, kept at the root of a splay tree, is the word at which all states of the path were last seen.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}, {}]
        self.link, self.length = [0, 0], [0, 0]
        self.left, self.right, self.up, self.seen = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.whole, self.words = 1, 0

    def _state(self, length: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        for column in (self.link, self.left, self.right, self.up):
            column.append(0)
        self.seen.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make `x` the root of its splay tree."""
        left, right, up = self.left, self.right, self.up
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                outer = up[g]
                if (left[g] == p) == (left[p] == x):
                    self._turn(p, g)
                    self._turn(x, p)
                else:
                    on_left = left[g] == p
                    self._turn(x, p)
                    if on_left:
                        left[g] = x
                    else:
                        right[g] = x
                    self._turn(x, g)
                top = g
            else:
                outer = g
                self._turn(x, p)
                top = p
            if outer and left[outer] == top:
                left[outer] = x
            elif outer and right[outer] == top:
                right[outer] = x
            else:
                up[x] = outer
                self.seen[x] = self.seen[top]
                return
            up[x] = p = outer

    def _turn(self, x: int, p: int) -> None:
        """Rotate `x` over its parent `p`; what stands above `p` is left to the caller."""
        left, right, up = self.left, self.right, self.up
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p] = x

    def append(self, word: int) -> list[tuple[int, int]]:
        """Append a word; gives the (last word, words in common) of every stretch of states its suffixes meet."""
        follow, link, length = self.next, self.link, self.length
        right, up, seen = self.right, self.up, self.seen
        new = self._state(length[self.whole] + 1, {})
        p = self.whole
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = follow[p][word]
            if length[p] + 1 != length[q]:
                # A shorter suffix of q gets a state of its own, just above q and last seen where q was.
                copy = self._state(length[p] + 1, dict(follow[q]))
                link[copy], link[q] = link[q], copy
                while p and follow[p].get(word) == q:
                    follow[p][word] = copy
                    p = link[p]
                self._splay(q)
                above = self.left[copy] = self.left[q]
                if above:
                    up[above] = copy
                self.left[q], up[copy] = copy, q
                q = copy
            link[new] = q
        self.whole = new
        below, x = new, link[new]
        up[new] = x
        met = []
        while x:
            self._splay(x)
            if length[x]:
                met.append((seen[x], length[x]))
            deeper = right[x]
            if deeper:
                seen[deeper] = seen[x]
            right[x] = below
            below, x = x, up[x]
        self._splay(new)
        seen[new] = self.words
        self.words += 1
        return met


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and then period."""
    text, last = Appended(), {}
    for i, word in enumerate(words):
        for e, common in text.append(word):
            if common >= i - e:
                last[e - common + 1, i - e] = i
    found = ((start, end - start + 1, period) for (start, period), end in last.items())
    return sorted((s, n, q) for s, n, q in found if n >= max(LEAST_WORDS, LEAST_PERIODS * q))


def _stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def candidates(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of words that hold every run, none over two texts: (first word, end).

    In a run of period q and n words, the first n - q words come again within q words. There are at least
    max(6, 4 q) - q of them; the run ends q words after the last.
    """
    total, counts = len(words), np.diff(first)
    if not total:
        return []
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = mixed(words + text * STEP)
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    ahead = np.full(total, total + 1, np.int64)
    ahead[order[again]] = order[again + 1] - order[again]
    ends = np.repeat(first[1:], counts)
    marks = np.zeros(total + 1, np.int64)
    most, below = 1, 0
    while LEAST_PERIODS * (below + 1) <= counts.max():
        # Periods over `below` and up to `most`.
        least = max((LEAST_PERIODS - 1) * (below + 1), LEAST_WORDS - most)
        begin, end = _stretches(ahead <= most)
        long = end - begin >= least
        begin, end = begin[long], np.minimum(end[long] + most, ends[begin[long]])
        np.add.at(marks, begin, 1)
        np.add.at(marks, end, -1)
        below, most = most, most * 2
    begin, end = _stretches(np.cumsum(marks[:-1]) > 0)
    out = []
    for b, e in zip(begin.tolist(), end.tolist()):
        while b < e:
            stop = min(e, int(ends[b]))
            out.append((b, stop))
            b = stop
    return out


def found_in(texts: pa.Array) -> tuple[list[list[tuple[int, int, int]]], pa.Array]:
    """The runs of each text, and the texts without what each run repeats, words parted by one space."""
    data, offsets = text_bytes(texts)
    n_texts = len(texts)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n_texts)]
    inside = ~SPACES[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    begins = inside & ~before
    starts = np.flatnonzero(begins)
    if not len(starts):
        return runs, pa.array([""] * n_texts, pa.string())
    at = np.flatnonzero(inside)
    word = np.cumsum(begins)[at] - 1
    place = at - starts[word]
    first = np.searchsorted(starts, offsets)
    sizes = np.bincount(word, minlength=len(starts))
    powers = np.multiply.accumulate(np.full(int(sizes.max()), STEP))
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    hashes = mixed(np.add.reduceat(BYTES[data[at]] * powers[place], heads))

    dropped = np.zeros(len(starts) + 1, np.int64)
    for b, e in candidates(hashes, first):
        owner = int(np.searchsorted(first, b, side="right")) - 1
        shift = b - int(first[owner])
        for s, n, q in runs_of(np.unique(hashes[b:e], return_inverse=True)[1].tolist()):
            runs[owner].append((s + shift, n, q))
            dropped[b + s + q] += 1
            dropped[b + s + n] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    # Each kept word and a space behind it, but for a text's last; a run keeps its first period, so no text loses all.
    widths = np.where(kept, sizes + 1, 0)
    last = np.maximum.accumulate(np.where(kept, np.arange(len(kept)), -1))[first[1:][np.diff(first) > 0] - 1]
    widths[last] -= 1
    ends = np.cumsum(widths)
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    shown = kept[word]
    out[(ends - widths)[word[shown]] + place[shown]] = data[at[shown]]
    bounds = np.concatenate([[0], ends])[first].astype(np.int64)
    collapsed = pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer(bounds), pa.py_buffer(out))
    return runs, collapsed.cast(pa.string())


@F.arrow_udf(FOUND)
def _found(texts: pa.Array) -> pa.Array:
    runs, collapsed = [], []
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        own, left = found_in(part.column(0))
        runs += own
        collapsed.append(left)
    listed = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in sorted(own)] for own in runs], pa.list_(ARROW_RUN))
    whole = pa.concat_arrays(collapsed) if collapsed else pa.array([], pa.string())
    return pa.StructArray.from_arrays([listed, whole], fields=list(ARROW_FOUND))


def periodic_runs(text: Column) -> Column:
    """`runs` (`start, length, period` in words, by start and then period) and `collapsed` (the text without the words
    of any run after that run's first period, parted by one space) of each whole text.

    Words are what stands between ASCII white space; words are told apart by 64-bit hashes. NULL and blank texts have no
    runs and collapse to the empty text. A text is one task's work: some 150 bytes of memory per word, and about 1 KB per
    word of a stretch that may hold a run.
    """
    return _found(text)


def strongest(runs: Column) -> Column:
    """The run of greatest length by period, exactly; ties to the smallest start, then period. NULL without runs."""

    def better(a: Column, b: Column) -> Column:
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
