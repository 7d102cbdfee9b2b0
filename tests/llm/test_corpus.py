"""Packing, repeated strings, similar documents, decontamination, neighbours and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import components, contamination, without_repeats as plain_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from gridloam.llm import ann_forest, jaccard_join, packing, queries, suffix_dedup
from gridloam.llm.components import components as graph_components
from gridloam.llm.decontaminate import items_hit, with_matches, without_contaminated, words_hit

SF = "/root/testdata/sf0.001"


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - length)
        else:
            n += 1
            rooms.append(capacity - length)
    return n


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("range_rows", [200_000, 40])
def test_packing_is_valid_and_tight(spark, monkeypatch, range_rows):
    monkeypatch.setattr(packing, "RANGE_ROWS", range_rows)
    rng = random.Random(1)
    lengths = [rng.choice([1, 2, 3, 30, 64, 65, 100, 200, 333, 341, 342, 400, 512, 513, 700, 900, 1023, 1024]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    rows = packing.packed(df).collect()
    assert sorted((r["item"], r["length"]) for r in rows) == list(enumerate(lengths))
    least = best_fit_decreasing(lengths, 1024)
    assert check_packing(rows, 1024) <= least * (1.02 if range_rows > 1000 else 1.3) + 1
    assert packing.packed(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame([(1, 1025)], "item long, length long"))


@pytest.mark.parametrize(
    "lengths",
    [
        [924] * 200 + [60] * 200,
        [1000] * 40 + [7] * 130 + [64] * 90 + [1] * 37,
    ],
)
def test_short_pieces_meet_gaps_that_no_bundle_fits(spark, lengths):
    df = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    rows = packing.packed(df).collect()
    assert sorted((r["item"], r["length"]) for r in rows) == list(enumerate(lengths))
    assert check_packing(rows, 1024) <= best_fit_decreasing(lengths, 1024) * 1.02


def test_packed_documents(spark, odd_documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.BPE_VOCABULARY)
    library = Tokenizer.from_file(path)
    docs = odd_documents.unionByName(documents(spark).limit(60), allowMissingColumns=True)
    rows = packing.packed_documents(docs, path).collect()
    check_packing(rows, 1024)
    want = []
    for d, text in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [(0, len(ids))] if len(ids) <= 1024 else [(s, 1024) for s in range(len(ids) % 1024, len(ids), 1024)]
        if cuts[0][0]:
            cuts.insert(0, (0, cuts[0][0]))
        want += [(-1 if d is None else d, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(cuts)]
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("text", ["", " ", "  a  b", "a\n b \tc", "x<|endoftext|> y", "don't we'll x  y z\x1c q \x85w", "a  \n\n  b   ", "日本 語  x"])
def test_chunks_encode_as_whole_texts(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.BPE_VOCABULARY)
    got = packing.ChunkEncoder(path).encode(text)
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def repeated_texts(seed):
    """Texts put together from shared stretches with edits, periodic runs and copies."""
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(150, 900))) for _ in range(6)]
    texts = []
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            i = rng.randint(0, len(p) // 3)
            parts.append(p[i : len(p) - rng.randint(0, len(p) // 3)])
            if rng.random() < 0.5:
                parts.append("".join(rng.choices("xyz", k=rng.randint(1, 40))))
        texts.append("".join(parts))
    return texts + ["ab" * 600, "q" * 399, "q" * 400, "q" * 402, texts[0], texts[0], None, ""]


@pytest.mark.parametrize(("seed", "range_suffixes"), [(1, 200_000), (2, 7), (3, 3)])
def test_repeats_match_brute_force(spark, seed, range_suffixes):
    texts = repeated_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = suffix_dedup.without_repeats(df, range_suffixes=range_suffixes).collect()
    want = plain_repeats(texts)
    for r in got:
        n = len((r["text"] or "").encode())
        assert (n, n - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) == want[r["i"]], r["i"]


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 20_000).astype(np.uint8)
    offsets = np.array([0, 300, 300, 9_000, 9_450, 20_000])
    whole = suffix_dedup.anchors(data, offsets)
    for size in (1, 37, 400, 5_000):
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", size)
        assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(data, offsets)))


@pytest.mark.parametrize("range_suffixes", [15, 40])
def test_a_hot_line_over_several_ranges(spark, range_suffixes):
    """Texts round one line, whose surroundings agree in part: windows around it that no two neighbours settle."""
    rng = random.Random(range_suffixes)
    line = "".join(rng.choices("abcdefgh", k=300))
    left = ["".join(rng.choices("ijkl", k=200)) for _ in range(4)]
    right = ["".join(rng.choices("mnop", k=200)) for _ in range(4)]
    texts = []
    for i in range(150):
        k, m = rng.randrange(20, 130), rng.randrange(20, 130)
        texts.append("".join(rng.choices("qrst", k=40)) + rng.choice(left)[-k:] + line + rng.choice(right)[:m] + "".join(rng.choices("uvwx", k=40)))
    texts += texts[:20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.without_repeats(df, range_suffixes=range_suffixes).orderBy("doc_id").collect()
    want = plain_repeats(texts)
    for r, (n, gone, spans, kept) in zip(got, want):
        assert (sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) == (gone, spans, kept)


def test_anchors_of_few_suffixes_stay_in_one_range(spark, monkeypatch):
    """No anchor has suffixes for more than a range here, so none is sorted again and asked for window by window."""

    def again(*_):
        raise AssertionError("an anchor reaches over an end of its range")

    monkeypatch.setattr(suffix_dedup, "_resorted", again)
    rng = random.Random(6)
    lines = ["".join(rng.choices("abcdefgh", k=300)) for _ in range(40)]
    texts = ["".join(rng.choices("ijkl", k=150)) + lines[i % 40] + "".join(rng.choices("mnop", k=150)) for i in range(200)]
    texts += texts[:30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.without_repeats(df, range_suffixes=40).orderBy("doc_id").collect()
    assert [sum(s["end"] - s["start"] for s in r["spans"]) for r in got] == [w[1] for w in plain_repeats(texts)]


def test_bounds_come_before_their_anchors():
    a, b = (c * suffix_dedup.ANCHOR for c in (b"a", b"b"))
    suffixes = [(x + bytes(2 * suffix_dedup.SIDE), -5, 0, 0, 0) for x in (a, b)] + [(b + b"x" * 2 * suffix_dedup.SIDE, 1, 3, 200, 200)]
    bounds = suffix_dedup.before_anchors(suffixes)
    assert bounds == sorted(bounds) and bounds[0] < suffixes[0] < bounds[1] < suffixes[1] and bounds[2] == suffixes[2]


def test_repeats_in_odd_rows(spark, odd_documents):
    rows = suffix_dedup.without_repeats(odd_documents).collect()
    want = dict(zip([(r["doc_id"], r["text"]) for r in rows], plain_repeats([r["text"] for r in rows])))
    assert len(rows) == 10 and all(want[r["doc_id"], r["text"]][1] == len((r["text"] or "").encode()) - len(r["kept"]) for r in rows)
    cut = suffix_dedup.with_repeats_cut(odd_documents)
    assert cut.columns == odd_documents.columns and cut.where("kept IS NULL").count() == 0
    assert suffix_dedup.without_repeats(odd_documents.limit(0)).count() == 0


def test_merge_compares_only_behind_known_prefixes():
    rng = random.Random(4)
    strings = sorted({"".join(rng.choices("ab", k=12)).encode() for _ in range(300)})
    suffixes = [(s, i, 0, 0, 0) for i, s in enumerate(strings)]
    runs = [sorted(suffixes[k::7]) for k in range(7)]
    coded = [suffix_dedup._read(suffix_dedup.front_coded(r, 0), 12) for r in runs]
    merged = list(suffix_dedup.merged(coded))
    assert [s for _, s in merged] == suffixes
    for (_, a), (k, b) in zip(merged, merged[1:]):
        assert k == next((i for i in range(12) if a[0][i] != b[0][i]), 12)


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, common = [], [rng.choice(words) for _ in range(30)]
    for d in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))] + (common if d % 2 else [])
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy).title() if rng.random() < 0.3 else " ".join(copy))
    return list(enumerate([*rows, None, "", " ", "one", "One", "a b c d e", "a b c d e"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = near_copies(seed)
    got = jaccard_join.linked_documents(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {tuple(r) for r in got} == components(rows)


@pytest.mark.parametrize("seed", [1, 3])
def test_components_over_passes_of_neighbours(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard_join, "FEW_PAIRS", 0)
    monkeypatch.setattr(jaccard_join, "FIRST_TOKENS", 0)
    rows = near_copies(seed)
    got = jaccard_join.linked_documents(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {tuple(r) for r in got} == components(rows)


def test_few_pairs_are_compared_at_once(spark, monkeypatch):
    """Texts that share a stretch but are not similar: what is left after the first pairs is little, and one pass."""

    def passed(*_):
        raise AssertionError("a pass over neighbours")

    monkeypatch.setattr(jaccard_join, "_crossing_neighbours", passed)
    shared = [f"s{i}" for i in range(40)]
    rows = [(d, " ".join([f"w{d}x{i}" for i in range(40)] + (shared if d % 5 == 0 else []))) for d in range(40)]
    rows += [(100 + d, text + " more") for d, text in rows[:10]]
    got = jaccard_join.linked_documents(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {tuple(r) for r in got} == components(rows)


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(5)
    for n in (1, 5, 80, 511, 512, 3_000):
        pool = rng.integers(0, 1 << 63, 4 * n).astype(np.uint64)
        for share in (0.8, 0.86, 0.95, 1.0):
            m = int(n * rng.uniform(0.8, 1.2)) or 1
            both = int(share * min(n, m))
            sets = pool[:n], np.concatenate([pool[:both], pool[n : n + m - both]])
            a, b = jaccard_join.sketches(np.concatenate(sets), np.array([0, n, n + m]))
            if jaccard_join.similar(*(np.sort(x).tobytes() for x in sets)):
                assert jaccard_join.may_be_similar(a, b, n + m)
            small = min(len(a), len(b))
            bits = int.from_bytes(jaccard_join.folded(a, small)) ^ int.from_bytes(jaccard_join.folded(b, small))
            assert bits.bit_count() <= n + m - 2 * both
    a, b = jaccard_join.sketches(pool[:1_200], np.array([0, 600, 1_200]))
    assert not jaccard_join.may_be_similar(a, b, 1_200) and len(a) == 128


def test_similar_documents_in_odd_rows(spark, odd_documents):
    rows = jaccard_join.linked_documents(odd_documents).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], r["component_id"] or -1) for r in rows)
    assert got[:7] == [(-1, 0, -1), (-1, 1, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4)]
    kept = jaccard_join.one_per_component(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6, 7]
    assert jaccard_join.linked_documents(odd_documents.limit(0)).count() == 0


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7), (200, 300), (300, 250)]
    got = {r["node"]: r["root"] for r in graph_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_contamination_matches_brute_force(spark, block_bytes):
    rng = random.Random(6)
    words = "The and, of to. In-A b7 été x".split()
    items = [(i, " ".join(rng.choices(words, k=rng.randint(9, 30)))) for i in range(12)] + [(50, "short item"), (51, "Solo"), (52, ""), (53, None), (54, "- ."), (0, "again same id here")]
    docs = [(d, " ".join([*rng.choices(words, k=30), *(rng.choice(items)[1] or "").split(), *rng.choices(words, k=5)])) for d in range(40)]
    docs += [(100, None), (101, ""), (102, "solo"), (103, "a short, ITEM!"), (104, "shortitem")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    tests = spark.createDataFrame(items, "item_id int, text string")
    found = with_matches(df, tests, block_bytes=block_bytes)
    got = {r["doc_id"]: (r["n_words"], r["hit"], r["items"]) for r in found.select("doc_id", "n_words", words_hit(F.col("matches")).alias("hit"), items_hit(F.col("matches")).alias("items")).collect()}
    want = contamination(docs, items)
    assert got == want
    clean = {r["doc_id"] for r in without_contaminated(df, tests).collect()}
    assert clean == {d for d, (_, n, _) in want.items() if not n}


def test_contamination_of_odd_rows(spark, odd_documents):
    tests = spark.createDataFrame([(None, "eins zwei drei"), (1, None)], "item_id int, text string")
    found = with_matches(odd_documents, tests).collect()
    assert sorted(len(r["matches"]) for r in found) == [0] * 7 + [1] * 3
    assert without_contaminated(odd_documents, tests).count() == 7
    assert without_contaminated(odd_documents, tests.limit(0)).columns == odd_documents.columns
    assert with_matches(odd_documents.limit(0), tests).count() == 0


def test_longest_matches_and_places(spark):
    text = "x " + " ".join(f"t{i}" for i in range(25)) + " y"
    tests = spark.createDataFrame([(9, "q " + " ".join(f"t{i}" for i in range(30)))], "item_id int, text string")
    match = with_matches(spark.createDataFrame([(text,)], "text string"), tests).first()["matches"]
    assert [tuple(m) for m in match] == [(1, 25, "9", 1)]


def plain_neighbours(rows, k):
    x = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in x:
        if q % 20 == 0:
            out[q] = sorted((-float((x[q] * x[i]).sum()), i) for i in x if i != q)[:k]
    return out


def test_neighbours_reach_the_recall(spark):
    got = queries.QUERIES["op10_nearest_neighbours"](spark, "/root/testdata/sf0.01").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = plain_neighbours(rows, 20)
    hits = sum((r["query_id"], r["vec_id"]) in {(q, i) for q, near in want.items() for _, i in near} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("block_rows", [4096, 5])
def test_neighbours_of_odd_vectors(spark, block_rows):
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)] + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(40, 75)]
    odd = [(100, None), (120, [0.0] * 4), (140, [1.0, None, 1.0, 1.0]), (160, [float("nan")] * 4), (180, [float("inf"), 0.0, 0.0, 0.0]), (200, [1.0]), (None, [9.0] * 4), (220, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in good + odd], "vec_id long, embedding array<float>, score int, rank int")
    found = ann_forest.nearest(df, df.where("vec_id % 20 = 0"), 20, search_share=1e9, block_rows=block_rows).collect()
    rows = [(i, np.array(v, np.float32)) for i, v in good]
    want = {(q, n + 1, i, -s) for q, near in plain_neighbours(rows, 20).items() for n, (s, i) in enumerate(near)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == want
    assert ann_forest.nearest(df.limit(0), df).count() == 0
    few = ann_forest.nearest(df.where("vec_id in (0, 1)"), df.where("vec_id = 0"), 20).collect()
    assert [r["vec_id"] for r in few] == [1]


def test_pipeline_stages(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality"](spark, docs, SF)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert sum((d in kept) == bool(q) for d, q in labels.items()) >= 0.97 * len(labels)

    single = stages["near_duplicates"](spark, docs, SF)
    assert {r["doc_id"] for r in single.collect()} == {i for i, _, c in components(sorted(rows.items())) if i == c}

    cut = {r["doc_id"]: r for r in stages["repeated_passages"](spark, docs, SF).collect()}
    order = sorted(rows)
    for d, (n, gone, _, digest) in zip(order, plain_repeats([rows[d] for d in order])):
        if not gone:
            assert cut[d]["text"] == rows[d]
        assert n - gone - 8 <= len(cut[d]["text"].encode()) <= n - gone and cut[d]["n_chars"] == len(cut[d]["text"])

    clean = stages["decontamination"](spark, docs, SF)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in clean.collect()} == {d for d, (_, n, _) in contamination(rows.items(), items).items() if not n}
    for stage in (good, single, clean):
        assert stage.columns == docs.columns


def test_pipeline_of_odd_rows(spark, odd_documents):
    docs = odd_documents.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() > 0, name
        stage(spark, docs.limit(0), SF).count()
