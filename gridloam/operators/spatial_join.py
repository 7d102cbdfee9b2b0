"""Region attribution for points and lines, and region overlay, on top of the grid index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloam.functions.geometry import line_segments, segments_meet
from gridloam.operators.region_index import (
    BROADCAST_BYTES,
    RegionIndex,
    _by_row,
    _children,
    _local,
    best_candidates,
    build_region_index,
    cell_of,
    contains,
    distinct_shapes,
    explode_edges,
    grid_size,
    shape_totals,
    with_box,
    with_shape,
)
from gridloam.operators.skew import lookup_join
from gridloam.session import written


def _index(regions: DataFrame | RegionIndex, id_col: str = "id", level_col: str = "admin_level") -> RegionIndex:
    return regions if isinstance(regions, RegionIndex) else build_region_index(regions, id_col, level_col)


def _on_cell(facts: DataFrame, cells: DataFrame, measured: int, how: str, count_on: DataFrame | None = None) -> DataFrame:
    """Join rows to cells: broadcast when the measured cells are small, else the skew-safe shuffled join."""
    keyed = cells.withColumnsRenamed({"c": "_c", "r": "_r"})
    if measured <= BROADCAST_BYTES:
        return facts.join(F.broadcast(keyed), ["_c", "_r"], how)
    return lookup_join(facts, keyed, ["_c", "_r"], how, small_rows=0, count_on=count_on)


def assign_region(
    points: DataFrame,
    regions: DataFrame | RegionIndex,
    geometry_col: str = "geometry",
    region_col: str = "region_id",
    id_col: str = "id",
    level_col: str = "admin_level",
) -> DataFrame:
    """Add the region strictly containing each point: highest admin level first, then smallest id, else NULL.

    Every point meets at most one index row per grid resolution, so rows are neither multiplied nor
    regrouped: with a small index this is one scan without a shuffle, otherwise one shuffled join.
    """
    index = _index(regions, id_col, level_col)
    x, y = f"{geometry_col}.x", f"{geometry_col}.y"
    out, found = points, []
    for depth, level in enumerate(index.levels):
        name = f"_candidates_{depth}"
        cells = (level.best if level.best is not None else best_candidates(level.entries)).withColumnRenamed("candidates", name)
        cell = (f"{cell_of(x, level.size)} as _c", f"{cell_of(y, level.size)} as _r")
        out = _on_cell(out.selectExpr("*", *cell), cells, level.bytes, "left", points.selectExpr(*cell)).drop("_c", "_r")
        found.append(name)
    # A point in a cell that was cut has the candidates of its smaller cell and the best region filling the larger one.
    none = F.slice(F.coalesce(*found), 1, 0)
    merged = F.array_sort(F.concat(*(F.coalesce(f, none) for f in found))) if len(found) > 1 else F.col(found[0])
    # The first candidate is the answer for most points; only where it is not are the others looked at.
    out = out.withColumn("_candidates", merged).drop(*found)
    out = out.withColumn("_first", F.get("_candidates", F.lit(0)))
    others = f"filter(slice(_candidates, 2, size(_candidates)), k -> {contains('k.edges', 'k.toggles', x, y)})"
    hit = f"if({contains('_first.edges', '_first.toggles', x, y)}, _first.rank.gid, get({others}, 0).rank.gid)"
    return out.withColumn(region_col, F.expr(hit)).drop("_candidates", "_first")


def fill_region(
    df: DataFrame,
    regions: DataFrame | RegionIndex,
    geometry_col: str = "geometry",
    region_col: str = "region_id",
    updated_at: Column | None = None,
) -> DataFrame:
    """Attribute only the rows that have a geometry and no region yet; given regions stay.

    `updated_at`, where a table keeps one, is stamped on every row passing through.
    """
    open_point = F.when(F.col(region_col).isNull(), F.col(geometry_col))
    found = assign_region(df.withColumn("_point", open_point), regions, "_point", "_found")
    filled = found.withColumn(region_col, F.coalesce(region_col, "_found")).select(*df.columns)
    return filled if updated_at is None else filled.withColumn("updated_at", updated_at)


def _grid_range(df: DataFrame, index: RegionIndex, size: float) -> DataFrame:
    """Keep rows whose segment can reach the indexed area and note that area in cells."""
    x1, x2, y1, y2 = (repr(float(v)) + "D" for v in index.bounds)
    reach = df.where(f"greatest(x1, x2) >= {x1} and least(x1, x2) <= {x2} and greatest(y1, y2) >= {y1} and least(y1, y2) <= {y2}")
    return reach.selectExpr(
        "*", f"{cell_of(x1, size)} as c_from", f"{cell_of(x2, size)} as c_to", f"{cell_of(y1, size)} as r_from", f"{cell_of(y2, size)} as r_to"
    )


def _hits(segments: DataFrame, index: RegionIndex) -> DataFrame:
    """(key, gid) for regions met by the segments of a key; segments: key, x1, y1, x2, y2, anchor.

    A region is met when a segment shares a point with its boundary, decided in every cell the segment reaches
    against the regions with edges there, or when the start of an anchor segment lies inside it, decided in that
    start's cell against all regions there.
    """
    if index.bounds is None:
        return segments.select("key", F.lit(None).alias("gid")).where(F.lit(False))
    current = _grid_range(segments, index, index.levels[0].size)
    hits = None
    for level in index.levels:
        marks = _local(_by_row(current, level.size))
        placed = marks.withColumnsRenamed({"c": "_c", "r": "_r"})
        entries = level.entries.drop("lvl")
        at_home = f"anchor and _c = {cell_of('x1', level.size)} and _r = {cell_of('y1', level.size)}"
        met = (
            _on_cell(placed, entries.where("size(edges) > 0").drop("toggles"), level.bytes, "inner")
            .withColumn("s", F.struct("x1", "y1", "x2", "y2"))
            .where(f"exists(edges, e -> {segments_meet('s', 'e')})")
            .select("key", "gid")
        )
        held = _on_cell(placed.where(at_home), entries, level.bytes, "inner").where(contains("edges", "toggles", "x1", "y1")).select("key", "gid")
        met = met.unionByName(held)
        hits = met if hits is None else hits.unionByName(met)
        if level.refined is not None:
            current = _children(marks.join(level.refined, ["c", "r"], "left_semi"))
    return hits


def _named(pairs: DataFrame, index: RegionIndex) -> DataFrame:
    """Distinct (key, region_id), with each indexed shape replaced by all regions that have it."""
    distinct = pairs.select("key", "gid").distinct()
    if index.members is None:
        return distinct.withColumnRenamed("gid", "region_id")
    return lookup_join(distinct, index.members, ["gid"], "inner").drop("gid")


def line_region_pairs(
    lines: DataFrame,
    regions: DataFrame | RegionIndex,
    key_col: str = "id",
    geometry_col: str = "geometry",
    id_col: str = "id",
    level_col: str = "admin_level",
) -> DataFrame:
    """(line key, region_id) for every region a line meets; touching counts.

    A line meets a region when it touches the boundary, found per segment and cell, or lies inside it as a
    whole, in which case its first vertex does.
    """
    index = _index(regions, id_col, level_col)
    keyed = lines.where(F.col(geometry_col).isNotNull()).select(F.col(key_col).alias("key"), F.col(geometry_col).alias("g"))
    segments = keyed.selectExpr("key", f"posexplode({line_segments('g')}) as (i, s)").selectExpr("key", "s.*", "i = 0 as anchor")
    moving = segments.where("anchor or x1 <> x2 or y1 <> y2")
    return _named(_hits(moving, index), index).withColumnRenamed("key", key_col)


def lines_meeting(
    lines: DataFrame,
    regions: DataFrame,
    region_id,
    geometry_col: str = "geometry",
    key_col: str = "id",
    id_col: str = "id",
    level_col: str = "admin_level",
) -> DataFrame:
    """Keys of the lines that meet one region. The lines whose box misses the region's never come to a join, and only
    that region is indexed."""
    region = with_box(regions.where((F.col(id_col) == region_id) & F.col(geometry_col).isNotNull()), geometry_col)
    box = region.agg(F.min("box_x1").alias("x1"), F.max("box_x2").alias("x2"), F.min("box_y1").alias("y1"), F.max("box_y2").alias("y2")).first()
    if box["x1"] is None:
        return lines.select(key_col).limit(0)

    def reach(axis: str) -> Column:
        values = F.transform(geometry_col, lambda v: v[axis])
        return (F.array_max(values) >= box[f"{axis}1"]) & (F.array_min(values) <= box[f"{axis}2"])

    near = lines.where(reach("x") & reach("y"))
    return line_region_pairs(near, region, key_col, geometry_col, id_col, level_col).select(key_col)


def assign_regions_array(
    lines: DataFrame,
    regions: DataFrame | RegionIndex,
    key_col: str = "id",
    geometry_col: str = "geometry",
    array_col: str = "region_ids",
    id_col: str = "id",
    level_col: str = "admin_level",
) -> DataFrame:
    """Fill the region array of lines that have none or an empty one; NULL when no region is met.

    `key_col` must be unique, as a primary key is.
    """
    index = _index(regions, id_col, level_col)
    if array_col in lines.columns:
        given = F.size(F.coalesce(F.col(array_col), F.array())) > 0
        open_lines, kept = lines.where(~given).drop(array_col), lines.where(given)
    else:
        open_lines, kept = lines, None
    pairs = line_region_pairs(open_lines, index, key_col, geometry_col)
    arrays = pairs.groupBy(key_col).agg(F.array_sort(F.collect_set("region_id")).alias(array_col))
    filled = open_lines.join(arrays, key_col, "left")
    return filled if kept is None else filled.unionByName(kept)


def overlay_regions(
    a: DataFrame,
    b: DataFrame,
    a_id: str = "id",
    b_id: str = "id",
    geometry_col: str = "geometry",
) -> DataFrame:
    """(a_id, b_id) for every pair of regions that share a point.

    Two regions meet when their boundaries do, or when one holds a whole part of the other, in which case
    it holds the first vertex of that part. Both sides have cells of one size, but only `b` is indexed whole: of `a` the
    cells that hold such a vertex. Pairs are those of different shapes until they are made distinct, and only then
    repeated for regions of one shape.
    """
    sides = [with_shape(df.withColumn("_side", F.lit(k)), key, "_side", geometry_col) for k, (df, key) in enumerate(((a, a_id), (b, b_id)))]
    tagged = [side.withColumn("region_id", F.concat_ws(":", "lvl", "region_id")) for side in sides]
    shapes = distinct_shapes(tagged[0].unionByName(tagged[1])).select("gid", "lvl", "shape", "geometry")
    shapes = written(shapes, "shapes")
    totals = shape_totals(with_box(shapes.withColumn("copies", F.lit(1)), "geometry"))
    size = grid_size(totals["area"], totals["vertices"], totals["shapes"]) if totals["shapes"] else 1.0
    left, right = (shapes.where(F.col("lvl") == k).select(F.col("gid").alias("key"), "geometry") for k in (0, 1))
    boundary = explode_edges(left, "geometry")
    corner = F.get(F.get("part", F.lit(0)), F.lit(0))
    corners = right.select("key", F.explode("geometry").alias("part")).select(
        "key", corner["x"].alias("x1"), corner["y"].alias("y1"), corner["x"].alias("x2"), corner["y"].alias("y2"),
        F.lit(True).alias("anchor"),
    )
    holders = build_region_index(shapes.where("lvl = 0"), "gid", "lvl", size=size, probes=corners.selectExpr("x1 as x", "y1 as y"))
    a_meets_b = _hits(boundary, build_region_index(shapes.where("lvl = 1"), "gid", "lvl", size=size)).select(F.col("key").alias("a_gid"), F.col("gid").alias("b_gid"))
    b_inside_a = _hits(corners, holders).select(F.col("gid").alias("a_gid"), F.col("key").alias("b_gid"))
    out = a_meets_b.unionByName(b_inside_a).distinct()
    for side, gid, name in zip(sides, ("a_gid", "b_gid"), ("a_id", "b_id")):
        named = side.join(shapes.select("lvl", "shape", F.col("gid").alias(gid)), ["lvl", "shape"]).select(gid, F.col("region_id").alias(name))
        out = lookup_join(out, named, [gid], "inner")
    return out.select("a_id", "b_id")
