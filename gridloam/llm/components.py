"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloam.session import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and its neighbours; the minimum is pre-aggregated, so a hub is no hot task."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    seen = _with_least(down)
    joined = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(seen.select("u", F.col("m").alias("v")))
    return joined.where("u != v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """`node` and `root` (the least node of its component) for every node with an edge other than to itself.

    Each round at least shortens the longest path by a constant factor; it ends when a round changes nothing.
    """
    now = written(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        summed = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.greatest("u", "v"), F.least("u", "v")).cast("decimal(38,0)"))).first()
        if summed == state or not summed[0]:
            break
        state = summed
        now = written(_small_star(_large_star(now)), "star")
    star = now.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root")).distinct()
