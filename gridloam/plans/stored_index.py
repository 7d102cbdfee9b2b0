"""A region index that is kept in a store, used by later sessions and changed with its regions.

Four tables change together: the index entries and, apart from them, what points need of each cell (its candidates, the
best region filling it among them), both laid out by cell so that a change rewrites the buckets its cells are in; the
shapes that are indexed, with the buckets each is in; and which regions have each shape. The grid is settled when the
index is made: cells that fill up later are not cut on, which `crowding` tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from gridloam.operators.region_index import ENTRY_WEIGHT, Level, RegionIndex, best_candidates, build_region_index, cut, distinct_shapes, with_shape
from gridloam.session import written
from gridloam.sources.parted import Store

_GRID = "depth int, size double, bytes bigint"
_ENTRIES = ["depth", "gid", "lvl", "c", "r", "edges", "toggles"]


# Cells side by side share a bucket, blocks of so many each way, so that a region is in few.
BLOCK = 16


def _bucketed(cells: DataFrame, buckets: int) -> DataFrame:
    block = F.xxhash64("depth", F.floor(F.col("c") / BLOCK), F.floor(F.col("r") / BLOCK))
    return cells.withColumn("_bucket", F.pmod(block, F.lit(buckets)).cast("int"))


def _best(entries: DataFrame, depths: int) -> DataFrame:
    """The candidates of each cell at each depth."""
    out = None
    for depth in range(depths):
        one = best_candidates(entries.where(F.col("depth") == depth).drop("depth", "_bucket")).withColumn("depth", F.lit(depth))
        out = one if out is None else out.unionByName(one)
    return out


def _weights(entries: DataFrame) -> dict[int, int]:
    return {r["depth"]: r["bytes"] for r in entries.groupBy("depth").agg(F.sum(F.expr(ENTRY_WEIGHT)).alias("bytes")).collect()}


def _shape_rows(shapes: DataFrame, entries: DataFrame) -> DataFrame:
    """What is remembered of each shape, with the buckets that hold any of its cells: at most as many as there are."""
    held = entries.groupBy("gid").agg(F.array_sort(F.collect_set("_bucket")).alias("buckets"))
    boxed = shapes.select("lvl", "shape", "gid", "box_x1", "box_x2", "box_y1", "box_y2")
    return boxed.join(held, "gid", "left").withColumn("buckets", F.coalesce("buckets", F.array().cast("array<int>")))


def store_region_index(store: Store, regions: DataFrame, id_col: str = "id", level_col: str = "admin_level", geometry_col: str = "geometry", buckets: int = 64, **options) -> None:
    """Build the index of a region table and commit it."""
    index = build_region_index(regions, id_col, level_col, geometry_col, **options)
    entries = None
    for depth, level in enumerate(index.levels):
        one = level.entries.withColumn("depth", F.lit(depth)).select(*_ENTRIES)
        entries = one if entries is None else entries.unionByName(one)
    entries = written(_bucketed(entries, buckets), "entries")
    named = with_shape(regions, id_col, level_col, geometry_col)
    shapes = distinct_shapes(named)
    spark = store.spark
    grid = spark.createDataFrame([(d, lv.size, lv.bytes) for d, lv in enumerate(index.levels)], _GRID)
    cells = spark.createDataFrame([], "depth int, c bigint, r bigint")
    for depth, level in enumerate(index.levels):
        if level.refined is not None:
            cells = cells.unionByName(level.refined.select(F.lit(depth).alias("depth"), "c", "r"))
    store.commit(
        store.replace("index_entries", entries),
        store.replace("index_best", _bucketed(_best(entries, len(index.levels)), buckets)),
        store.replace("index_shapes", _in_one(_shape_rows(shapes, entries))),
        store.replace("index_members", _in_one(_members(named, shapes))),
        store.replace("index_grid", _in_one(grid.withColumn("buckets", F.lit(buckets)))),
        store.append("index_refined", cells),
    )
    index.unpersist()


def _in_one(rows: DataFrame) -> DataFrame:
    """One part, whose rows are few: shapes and names of regions, never of what they are joined to."""
    return rows.withColumn("_bucket", F.lit(0))


def _members(named: DataFrame, shapes: DataFrame) -> DataFrame:
    return named.select("region_id", "lvl", "shape").join(shapes.select("lvl", "shape", "gid"), ["lvl", "shape"]).select("gid", "region_id")


def load_region_index(store: Store) -> RegionIndex:
    """The stored index, ready to be joined with. Nothing is cut, grouped or measured; the driver reads the grid, a row
    per depth, and the bounds."""
    box = store.read("index_shapes").agg(F.min("box_x1"), F.max("box_x2"), F.min("box_y1"), F.max("box_y2")).first()
    levels = []
    grid = store.read("index_grid").orderBy("depth").collect()
    for g in grid:
        depth = F.col("depth") == g["depth"]
        refined = store.read("index_refined").where(depth).select("c", "r") if g["depth"] < len(grid) - 1 else None
        best = store.read("index_best").where(depth).select("c", "r", "candidates")
        levels.append(Level(g["size"], store.read("index_entries").where(depth).drop("depth"), g["bytes"], refined, best))
    return RegionIndex(levels, store.read("index_members"), tuple(box) if box[0] is not None else None)


def update_region_index(store: Store, regions: DataFrame, id_col: str = "id", level_col: str = "admin_level", geometry_col: str = "geometry") -> dict[str, int]:
    """Bring the stored index up to the region table as it is now. Only shapes that are new, or whose smallest id has
    changed, are cut, along the grid there is; only buckets holding cells of those or of shapes that are gone are read
    and written. Returns the number of shapes cut and gone, and of buckets written."""
    named = with_shape(regions, id_col, level_col, geometry_col)
    shapes = written(distinct_shapes(named), "shapes")
    known, key = store.read("index_shapes"), ["lvl", "shape", "gid"]
    added = written(shapes.join(known.select(*key), key, "left_anti"), "added")
    gone = written(known.join(shapes.select(*key), key, "left_anti"), "gone")
    n_added, n_gone = added.count(), gone.count()
    if not n_added and not n_gone:
        return {"cut": 0, "gone": 0, "buckets": 0}
    grid = store.read("index_grid").orderBy("depth").collect()
    buckets = grid[0]["buckets"]
    refined = [store.read("index_refined").where(F.col("depth") == g["depth"]).select("c", "r") if g["depth"] < len(grid) - 1 else None for g in grid]
    fresh = written(_bucketed(cut(added, [g["size"] for g in grid], refined).select(*_ENTRIES), buckets), "entries")

    wanted = {r[0] for r in gone.select(F.explode("buckets")).distinct().collect()} | {r[0] for r in fresh.select("_bucket").distinct().collect()}
    touched = _touched(store, "index_entries", wanted)
    entries = fresh
    if touched:
        old = store._read("index_entries", touched).join(gone.select("gid"), "gid", "left_anti").select(*_ENTRIES)
        entries = written(fresh.unionByName(_bucketed(old, buckets)), "entries")
    # What the new entries weigh is added; what is gone is not taken off, so the measure errs on the large side.
    more = _weights(fresh)
    sizes = store.spark.createDataFrame([(g["depth"], g["size"], g["bytes"] + more.get(g["depth"], 0)) for g in grid], _GRID)
    rest = known.join(gone.select(*key), key, "left_anti")
    store.commit(
        store.replace("index_entries", entries, touched),
        store.replace("index_best", _bucketed(_best(entries, len(grid)), buckets), _touched(store, "index_best", wanted)),
        store.replace("index_shapes", _in_one(rest.unionByName(_shape_rows(added, fresh).select(*rest.columns)))),
        store.replace("index_members", _in_one(_members(named, shapes))),
        store.replace("index_grid", _in_one(sizes.withColumn("buckets", F.lit(buckets)))),
    )
    return {"cut": n_added, "gone": n_gone, "buckets": len(wanted)}


def _touched(store: Store, table: str, buckets: set[int]) -> list[Row]:
    keys = {f'{{"_bucket":{b}}}' for b in buckets}
    return [p for p in store.parts(table) if p["key"] in keys]


def crowding(store: Store) -> DataFrame:
    """Edges per cell, fullest first: where one holds far more than the others, build the index anew."""
    return store.read("index_entries").groupBy("depth", "c", "r").agg(F.sum(F.size("edges")).alias("edges")).orderBy(F.desc("edges"))
