"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all trees, exact reranking.

The trees are fitted on a bounded sample; every vector is then put into one leaf of each tree. A query walks all
trees through one queue, always on to the leaf whose dividing planes it is nearest to, until the leaves hold enough
rows. The rows of those leaves are scored exactly, leaf by leaf, in blocks of rows against blocks of queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 8
# Each tree has at least this many leaves of the sample, if it has the rows, and no leaf of more than LEAF_ROWS of it.
LEAVES = 64
LEAF_ROWS = 1024
SAMPLE_ROWS = 65_536
SAMPLE_BYTES = 64 << 20
# A query goes on until its leaves hold this share of all rows, those met in several trees counted again. Without
# structure in the vectors less than that misses neighbours; with clusters a smaller share does.
SEARCH_SHARE = 1.25
BLOCK_ROWS = 4096


@dataclass
class Tree:
    """Planes of a tree; a child of ~k is leaf k. A tree without planes has the one leaf 0."""

    normals: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    n_leaves: int


def grown(sample: np.ndarray, seed: int, leaf_rows: int) -> Tree:
    """Split at the median along the line through two random rows until leaves are small or their rows all alike."""
    rng = np.random.default_rng(seed)
    normals, thresholds, children, n_leaves = [], [], [], 0
    waiting = [(np.arange(len(sample)), -1, 0)]
    while waiting:
        rows, parent, side = waiting.pop()
        child = None
        for _ in range(3 if len(rows) > leaf_rows else 0):
            a, b = rng.choice(rows, 2, replace=False)
            line = sample[a] - sample[b]
            if not line.any():
                continue
            line = line / np.linalg.norm(line)
            along = sample[rows] @ line
            cut = float(np.median(along))
            low = along < cut
            if low.any() and not low.all():
                child = len(normals)
                normals.append(line)
                thresholds.append(cut)
                children.append([0, 0])
                waiting += [(rows[low], child, 0), (rows[~low], child, 1)]
                break
        if child is None:
            child = ~n_leaves
            n_leaves += 1
        if parent >= 0:
            children[parent][side] = child
    dim = sample.shape[1]
    return Tree(np.array(normals).reshape(-1, dim), np.array(thresholds), np.array(children, int).reshape(-1, 2), n_leaves)


def leaves_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector. Equal vectors get the same one."""
    at = np.zeros(len(vectors), int) if len(tree.thresholds) else np.full(len(vectors), -1)
    while (inside := np.flatnonzero(at >= 0)).size:
        node = at[inside]
        side = np.einsum("ij,ij->i", vectors[inside], tree.normals[node]) >= tree.thresholds[node]
        at[inside] = tree.children[node, side.astype(int)]
    return ~at


def visited(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that a query searches, nearest first, through one queue for all trees."""
    queue = [(0.0, t, 0 if len(tree.thresholds) else -1) for t, tree in enumerate(trees)]
    margins = [(tree.normals @ query - tree.thresholds).tolist() for tree in trees]
    out, rows = [], 0
    while queue and rows < enough:
        far, t, node = heapq.heappop(queue)
        while node >= 0:
            margin = margins[t][node]
            near, other = (1, 0) if margin >= 0 else (0, 1)
            heapq.heappush(queue, (max(far, abs(margin)), t, int(trees[t].children[node, other])))
            node = int(trees[t].children[node, near])
        out.append((t, ~node))
        rows += int(sizes[t][~node])
    return out


def usable(vector: Column, dim: int) -> Column:
    """Not NULL, of `dim` components, all of them finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The `k` nearest rows of a block for each query: found by one matrix product, settled by exact sums."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
    if not len(queries) or not len(rows):
        return empty
    q, x = (np.vstack(d["vector"].to_numpy()).astype(np.float64) for d in (queries, rows))
    q_id, x_id = queries["id"].to_numpy(), rows["id"].to_numpy()
    with np.errstate(over="ignore", invalid="ignore"):
        scores = q @ x.T
        scores[q_id[:, None] == x_id[None, :]] = -np.inf
        # Equal rows must not be told apart by rounding: all that come near the k-th are summed again in one order.
        least = np.partition(scores, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(q), -np.inf)
        slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        at, to = np.nonzero((scores >= (least - slack)[:, None]) & (q_id[:, None] != x_id[None, :]))
        exact = (q[at] * x[to]).sum(axis=1)
    order = np.lexsort((x_id[to], -exact, at))
    at, to, exact = at[order], to[order], exact[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    keep = place < k
    return pd.DataFrame({"query_id": q_id[at[keep]], "vec_id": x_id[to[keep]], "score": exact[keep]})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, id_column: str = "vec_id", vector: str = "embedding", trees: int = TREES, leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS, search_share: float = SEARCH_SHARE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each query its `k` nearest rows of `vectors` by inner product, itself left out: query_id, rank, vec_id, score.

    Ties go to the smaller id. Vectors that are NULL, zero, hold NULL or non-finite components, lack an id, or are not
    of the most frequent length take no part on either side. Rows of one id are one candidate, scored by the best of
    them. The forest is fitted on about `sample_rows` vectors (no more than 64 MB of them), every vector is indexed.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    named = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")).where("id IS NOT NULL")
    lengths = named.where("vector IS NOT NULL").groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not lengths or not lengths[0]["dim"]:
        return spark.createDataFrame([], schema)
    dim = lengths[0]["dim"]
    rows = named.where(usable(F.col("vector"), dim))
    asked = queries.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")).where("id IS NOT NULL").where(usable(F.col("vector"), dim))
    n_rows, n_queries = rows.count(), asked.count()
    if not n_rows or not n_queries:
        return spark.createDataFrame([], schema)
    share = min(sample_rows, SAMPLE_BYTES // (8 * dim)) / n_rows
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(share * (1 << 20))).orderBy("id").collect() or rows.limit(1).collect()
    sample = spark.sparkContext.broadcast(np.array([r["vector"] for r in chosen], np.float64))
    leaf_rows = min(leaf_rows, -(-len(chosen) // LEAVES))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [grown(sample.value, int(t), leaf_rows) for t in b["id"]]
            yield pd.DataFrame({"tree": b["id"], "normals": [m.normals.tobytes() for m in made], "thresholds": [m.thresholds.tobytes() for m in made], "children": [m.children.astype(np.int64).tobytes() for m in made], "n_leaves": [m.n_leaves for m in made]})

    planes = spark.range(trees, numPartitions=trees).mapInPandas(grow, "tree long, normals binary, thresholds binary, children binary, n_leaves long").orderBy("tree").collect()
    forest = [Tree(np.frombuffer(p["normals"]).reshape(-1, dim), np.frombuffer(p["thresholds"]), np.frombuffer(p["children"], np.int64).reshape(-1, 2), p["n_leaves"]) for p in planes]
    shared = spark.sparkContext.broadcast([(t.normals, t.thresholds, t.children, t.n_leaves) for t in forest])

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.vstack(b["vector"].to_numpy()).astype(np.float64) if len(b) else np.zeros((0, dim))
            for t, parts in enumerate(shared.value):
                yield pd.DataFrame({"tree": np.full(len(b), t, np.int32), "leaf": leaves_of(Tree(*parts), x).astype(np.int32), "id": b["id"], "vector": b["vector"]})

    kind = rows.schema["vector"].dataType.simpleString()
    index = rows.mapInPandas(put, f"tree int, leaf int, id long, vector {kind}")
    counts = index.groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(t.n_leaves, np.int64) for t in forest]
    for c in counts:
        sizes[c["tree"]][c["leaf"]] = c["count"]
    leaf_sizes = spark.sparkContext.broadcast(sizes)

    # Few rows are all looked at.
    enough = max(search_share * n_rows, 4 * k * trees)

    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [Tree(*parts) for parts in shared.value]
        for b in batches:
            found = [visited(own, leaf_sizes.value, np.asarray(v, np.float64), enough) for v in b["vector"]]
            yield pd.DataFrame([(t, leaf, i, v) for i, v, f in zip(b["id"], b["vector"], found) for t, leaf in f], columns=["tree", "leaf", "id", "vector"])

    # A leaf of any size is cut into blocks of rows, and queries into blocks; each pair of blocks is one task's work.
    blocks = spark.createDataFrame([(c["tree"], c["leaf"], -(-c["count"] // block_rows)) for c in counts], "tree int, leaf int, blocks long")
    query_blocks = -(-n_queries // block_rows)
    part = ["tree", "leaf", "block", "query_block"]
    index = index.join(F.broadcast(blocks), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).drop("blocks")
    visits = asked.mapInPandas(seek, f"tree int, leaf int, id long, vector {kind}").join(F.broadcast(blocks), ["tree", "leaf"])
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).drop("blocks")
    scored = visits.groupBy(*part).cogroup(index.groupBy(*part)).applyInPandas(lambda q, x: best_in_block(q, x, k), "query_id long, vec_id long, score double")
    once = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
