"""Plain versions of what the operators must give, for small inputs."""

import collections
import hashlib
import re

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def without_repeats(texts, size=400):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s : s + size] for b in raw for s in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if seen[b[s : s + size]] > 1:
                gone[s : s + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """(id, n_shingles, component) of rows (id, text); ids are unique."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(sets[i]), find(i)) for i in ids}


def bench_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def contamination(docs, items, size=10):
    """{id: (n_words, n_hit, item ids)}"""
    tests = [(i, bench_words(t)) for i, t in items]
    out = {}
    for d, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for i, own in tests:
            n = min(size, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    found.add(str(i))
        out[d] = (len(w), len(hit), sorted(found))
    return out
