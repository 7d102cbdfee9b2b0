"""Grid index over region boundaries, built with joins and aggregates.

Every region is cut along a grid of square cells. For one (cell, region) pair the index keeps

* `edges`   the boundary edges that reach into the cell, and
* `toggles` the heights at which the boundary lying wholly to the right of the cell switches a ray to the
  right between crossing it an odd and an even number of times,

so a point in the cell is tested against these few values and never against the whole boundary. A pair
without edges is a cell lying entirely inside the region. Pairs that cannot contain a point are left out.

Cells holding more than `MAX_CELL_EDGES` edges are cut again into 8 x 8 smaller ones for as long as that thins
them out. A smaller cell that keeps nearly all of the larger one's edges, as along a border that many regions share,
is left as it is: cutting cannot part edges that lie on each other. So is a cell that most of its edges only pass
through: cutting would repeat them in every smaller cell on their way. Regions filling a cell that is cut stay with
it and are not repeated below. So all edges in cells that are cut are at most as many as edges have ends, and the index
grows with the edges, however unevenly they are spread and however deep regions lie on each other. Cell sides are
powers of two, which makes cell membership exact in floating point.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gridloam.functions.geometry import orientation, ring_edges
from gridloam.session import written

MAX_CELL_EDGES = 64
FANOUT = 8
# A cell is cut on only while it holds at most this share of the edges of the cell it was cut from.
THINNED = 0.75
# Cells are no smaller than this times the largest coordinate; below that doubles hardly tell places apart.
FINEST = 2.0**-40
# Cell lists up to this estimated size are broadcast to the points; larger ones are joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024

# What an entry weighs, in bytes.
ENTRY_WEIGHT = "64 + size(edges) * 48 + size(toggles) * 8"

_EDGE = ("x1", "y1", "x2", "y2")
_BOUNDS = ("c_from", "c_to", "r_from", "r_to")


@dataclass
class Level:
    """One grid resolution of the index."""

    size: float
    entries: DataFrame  # gid, lvl, c, r, edges, toggles; of cells that continue only the regions filling them
    bytes: int  # measured weight of the entries
    refined: DataFrame | None = None  # c, r of the cells that continue at the next level
    best: DataFrame | None = None  # c, r and candidates as `best_candidates` gives them, where they are stored


@dataclass
class RegionIndex:
    levels: list[Level]
    members: DataFrame | None  # gid -> region_id; None when no two regions share a shape
    bounds: tuple[float, float, float, float] | None
    kept: list[DataFrame] = field(default_factory=list)

    def unpersist(self) -> None:
        for df in self.kept:
            df.unpersist()


def _keep(df: DataFrame, kept: list[DataFrame]) -> DataFrame:
    kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def with_box(df: DataFrame, geometry_col: str) -> DataFrame:
    """Add the bounding box of a region geometry."""
    vertices = f"flatten(flatten({geometry_col}))"
    return df.selectExpr(
        "*",
        f"array_min(transform({vertices}, v -> v.x)) as box_x1", f"array_max(transform({vertices}, v -> v.x)) as box_x2",
        f"array_min(transform({vertices}, v -> v.y)) as box_y1", f"array_max(transform({vertices}, v -> v.y)) as box_y2",
    )


def explode_edges(df: DataFrame, geometry_col: str) -> DataFrame:
    """One row per boundary edge; `anchor` marks the first edge of each part's outline."""
    parts = df.selectExpr("*", f"explode({geometry_col}) as part").drop(geometry_col)
    rings = parts.selectExpr("*", "posexplode(part) as (ring_no, ring)").drop("part")
    edges = rings.selectExpr("*", f"posexplode({ring_edges('ring')}) as (edge_no, e)").drop("ring")
    marked = edges.selectExpr("*", "e.*", "ring_no = 0 and edge_no = 0 as anchor").drop("ring_no", "edge_no", "e")
    return marked.where("anchor or x1 <> x2 or y1 <> y2")


def _number(value: float) -> str:
    return f"{float(value)!r}D"


def cell_of(value: str, size: float) -> str:
    """SQL for the grid column or row of a coordinate. Dividing by a power of two is exact."""
    return f"floor(({value}) / {_number(size)})"


def _by_row(edges: DataFrame, size: float) -> DataFrame:
    """Each edge once per grid row it reaches, with the range of columns it may touch in that row.

    A steep enough edge is narrowed to its span inside the row, padded by an eighth of a cell. It is steep enough
    where the interpolation's rounding stays far below that pad. Other edges keep their whole width; a wider range is
    never wrong.
    """
    low, high, left, right = "least(y1, y2)", "greatest(y1, y2)", "least(x1, x2)", "greatest(x1, x2)"
    rows = edges.selectExpr(
        "*", f"explode(sequence(greatest({cell_of(low, size)}, r_from), least({cell_of(high, size)}, r_to))) as r"
    )
    def x_at(y: str) -> str:
        return f"x1 + ({y} - y1) / (y2 - y1) * (x2 - x1)"

    pad, enter, leave = _number(size / 8), f"greatest(r * {_number(size)}, {low})", f"least((r + 1) * {_number(size)}, {high})"
    rounding = "greatest(abs(x1), abs(x2), abs(y1), abs(y2)) * 1e-15D"
    steep = f"abs(y2 - y1) >= {pad} and (abs(x2 - x1) + abs(y2 - y1)) * {rounding} <= abs(y2 - y1) * {pad} / 16"
    spans = rows.selectExpr("*", f"if({steep}, {x_at(enter)}, {left}) as xa", f"if({steep}, {x_at(leave)}, {right}) as xb")
    return spans.selectExpr(
        "*",
        f"{cell_of(f'greatest(least(xa, xb) - {pad}, {left})', size)} as l0",
        f"{cell_of(f'least(greatest(xa, xb) + {pad}, {right})', size)} as l1",
    ).drop("xa", "xb")


def _local(rows: DataFrame) -> DataFrame:
    """Each edge once per cell it reaches."""
    inside = rows.where("l0 <= c_to and l1 >= c_from")
    return inside.selectExpr("*", "explode(sequence(greatest(l0, c_from), least(l1, c_to))) as c").drop("l0", "l1", *_BOUNDS)


def _ends(size: float) -> str:
    """SQL for the number of ends of an edge that lie in its cell."""
    return " + ".join(f"cast({cell_of(x, size)} = c and {cell_of(y, size)} = r as int)" for x, y in (("x1", "y1"), ("x2", "y2")))


def _split(local: DataFrame, toggles: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Edges and toggles that stay, then those that go on to the next level: all in the given cells but the toggles of
    regions without edges there, which fill the cell."""
    inside = local.join(cells, ["c", "r"], "left_semi")
    partial = inside.select("gid", "lvl", "c", "r").distinct().withColumn("_on", F.lit(True))
    marked = toggles.join(partial, ["gid", "lvl", "c", "r"], "left")
    return local.join(cells, ["c", "r"], "left_anti"), marked.where("_on is null").drop("_on"), inside, marked.where("_on").drop("_on")


def _odd(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur an odd number of times; pairs cancel already in the map-side partial count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").drop("n")


def _toggles(rows: DataFrame, inherited: DataFrame | None, size: float) -> DataFrame:
    """Per (cell, region): heights at which the boundary right of the cell changes the crossing parity.

    An edge right of a cell is crossed at height y exactly when one of its ends is above y. Ends below the
    row never are, ends above it always are (kept at the row's upper side), and an end shared by two such
    edges cancels. What is left of one height in a row is a list of columns at which the parity to the left changes,
    so the columns of odd parity lie between the first and the second of them, the third and the fourth, and so on,
    counted from the right. Only those are written out.
    """
    below, above = f"r * {_number(size)}", f"(r + 1) * {_number(size)}"
    ends = rows.selectExpr("gid", "lvl", "r", "c_from", "least(l0, c_to + 1) as c_end", "explode(array(y1, y2)) as y")
    if inherited is not None:
        ends = ends.unionByName(
            inherited.selectExpr("gid", "lvl", "explode(sequence(r_from, r_to)) as r", "c_from", "c_to + 1 as c_end", "y")
        )
    counted = ends.where(f"y > {below} and c_end > c_from").selectExpr(
        "gid", "lvl", "r", "c_from", "c_end", f"least(y, {above}) as y"
    )
    moves = _odd(counted, "gid", "lvl", "r", "c_from", "c_end", "y")
    from_right = Window.partitionBy("gid", "lvl", "r", "c_from", "y").orderBy(F.desc("c_end"))
    paired = moves.withColumns({"nth": F.row_number().over(from_right), "start": F.lead("c_end").over(from_right)})
    return paired.where("nth % 2 = 1").selectExpr("gid", "lvl", "explode(sequence(coalesce(start, c_from), c_end - 1)) as c", "r", "y")


def _children(df: DataFrame) -> DataFrame:
    """Grid range, one level down, of the cell each row belongs to. Rows that came with the number of edges of their
    cell keep it as `held`."""
    last = FANOUT - 1
    return df.selectExpr(
        "*", f"c * {FANOUT} as c_from", f"c * {FANOUT} + {last} as c_to", f"r * {FANOUT} as r_from", f"r * {FANOUT} + {last} as r_to"
    ).drop("c", "r")


def _entries(local: DataFrame, toggles: DataFrame) -> DataFrame:
    """Edges and toggles per (cell, region), laid out by cell so that the grouping per cell needs no further
    shuffle. Cells arriving here hold a bounded number of edges. Edges are turned to run upward."""
    edge_type = "struct<x1:double,y1:double,x2:double,y2:double>"
    rising = "if(y1 <= y2, struct(x1, y1, x2, y2), struct(x2 as x1, y2 as y1, x1 as x2, y1 as y2)) as e"
    marks = local.selectExpr("gid", "lvl", "c", "r", rising, "cast(null as double) as t").unionByName(
        toggles.selectExpr("gid", "lvl", "c", "r", f"cast(null as {edge_type}) as e", "y as t")
    )
    return marks.repartition("c", "r").groupBy("gid", "lvl", "c", "r").agg(
        F.collect_list("e").alias("edges"), F.collect_list("t").alias("toggles")
    )


def grid_size(area: float, edges: int, regions: int, cells_per_edge: float = 8) -> float:
    """Power-of-two cell side that gives a number of cells per edge, so the index grows with the boundaries."""
    wanted = math.sqrt(area / (cells_per_edge * (edges + 8 * regions))) if area > 0 else 1.0
    return 2.0 ** round(math.log2(wanted))


def with_shape(regions: DataFrame, id_col: str, level_col: str, geometry_col: str) -> DataFrame:
    """`region_id, lvl, shape, geometry` of regions that have one; equal shapes share `shape`."""
    return regions.where(F.col(geometry_col).isNotNull()).select(
        F.col(id_col).alias("region_id"),
        F.col(level_col).alias("lvl"),
        F.sha2(F.to_json(F.struct(geometry_col)), 256).alias("shape"),
        F.col(geometry_col).alias("geometry"),
    )


def distinct_shapes(named: DataFrame) -> DataFrame:
    """Each shape of a level once, under the smallest id that has it, with its box."""
    shapes = named.groupBy("lvl", "shape").agg(
        F.min("region_id").alias("gid"), F.count(F.lit(1)).alias("copies"), F.any_value("geometry").alias("geometry")
    )
    return with_box(shapes, "geometry")


def shape_totals(shapes: DataFrame) -> Row:
    """One row of totals over distinct shapes: the only thing about the regions the driver learns."""
    return shapes.agg(
        F.sum((F.col("box_x2") - F.col("box_x1")) * (F.col("box_y2") - F.col("box_y1"))).alias("area"),
        F.sum(F.size(F.flatten(F.flatten("geometry")))).alias("vertices"),
        F.count(F.lit(1)).alias("shapes"),
        F.sum("copies").alias("regions"),
        F.min("box_x1").alias("x1"), F.max("box_x2").alias("x2"),
        F.min("box_y1").alias("y1"), F.max("box_y2").alias("y2"),
    ).first()


def cut(shapes: DataFrame, sizes: list[float], refined: list[DataFrame | None]) -> DataFrame:
    """`depth, gid, lvl, c, r, edges, toggles` of shapes cut along the grids of an index there is already: at each depth
    what falls into cells that are cut on goes to the next."""
    current = explode_edges(shapes, "geometry").selectExpr(
        "gid", "lvl", *_EDGE,
        f"{cell_of('box_x1', sizes[0])} as c_from", f"{cell_of('box_x2', sizes[0])} as c_to",
        f"{cell_of('box_y1', sizes[0])} as r_from", f"{cell_of('box_y2', sizes[0])} as r_to",
    )
    inherited, out = None, None
    for depth, (size, cells) in enumerate(zip(sizes, refined)):
        rows = _by_row(current, size)
        local, toggles = _local(rows), _toggles(rows, inherited, size)
        if cells is not None:
            local, toggles, current, inherited = _split(local, toggles, cells)
            current, inherited = written(_children(current), "cell-edges"), written(_children(inherited), "cell-toggles")
        entries = _entries(local, toggles).withColumn("depth", F.lit(depth))
        out = entries if out is None else out.unionByName(entries)
    return out


def build_region_index(
    regions: DataFrame,
    id_col: str = "id",
    level_col: str = "admin_level",
    geometry_col: str = "geometry",
    max_cell_edges: int = MAX_CELL_EDGES,
    cells_per_edge: float = 8,
    size: float | None = None,
    probes: DataFrame | None = None,
) -> RegionIndex:
    """Index a region table once; it then serves any number of point, line and overlay joins.

    More `cells_per_edge` make a larger index in which more points fall into cells filled by one region
    and need no boundary test: worth it when points outnumber boundary edges by far.

    Regions repeating the same shape at the same level are indexed once and listed in `members`. `size` is the side of
    the first cells, where it is settled elsewhere. With `probes`, the points x, y it is made for, only their cells are kept.
    """
    named = with_shape(regions, id_col, level_col, geometry_col)
    kept: list[DataFrame] = []
    shapes = _keep(distinct_shapes(named), kept)
    totals = shape_totals(shapes)
    members = None
    if totals["shapes"] and totals["regions"] > totals["shapes"]:
        firsts = shapes.select("lvl", "shape", "gid")
        members = named.select("region_id", "lvl", "shape").join(firsts, ["lvl", "shape"]).select("gid", "region_id")
    bounds = (totals["x1"], totals["x2"], totals["y1"], totals["y2"]) if totals["shapes"] else None

    if size is None:
        size = grid_size(totals["area"], totals["vertices"], totals["shapes"], cells_per_edge) if totals["shapes"] else 1.0
    current = explode_edges(shapes, "geometry").selectExpr(
        "gid", "lvl", *_EDGE,
        f"{cell_of('box_x1', size)} as c_from", f"{cell_of('box_x2', size)} as c_to",
        f"{cell_of('box_y1', size)} as r_from", f"{cell_of('box_y2', size)} as r_to",
    )
    inherited = None
    levels: list[Level] = []
    finest = FINEST * max(map(abs, bounds or (1.0,)))
    current = current.withColumn("held", F.lit(None).cast("bigint"))
    while True:
        rows = _by_row(current, size)
        local, toggles = _local(rows), _toggles(rows, inherited, size)
        if probes is not None:
            wanted = probes.selectExpr(f"{cell_of('x', size)} as c", f"{cell_of('y', size)} as r").distinct()
            local, toggles = local.join(wanted, ["c", "r"], "left_semi"), toggles.join(wanted, ["c", "r"], "left_semi")
        local = _keep(local, kept)
        counts = local.groupBy("c", "r").agg(F.count(F.lit(1)).alias("n"), F.max("held").alias("held"), F.expr(f"sum({_ends(size)})").alias("ends"))
        thinned = F.col("held").isNull() | (F.col("n") <= F.col("held") * THINNED)
        crowded = counts.where((F.col("n") > max_cell_edges) & thinned & (F.col("ends") >= F.col("n"))).select("c", "r", "n")
        if size <= finest * FANOUT or crowded.isEmpty():
            levels.append(_level(size, _entries(local, toggles), None, kept))
            break
        crowded, toggles = _keep(crowded, kept), _keep(toggles, kept)
        cells = crowded.select("c", "r")
        calm, still, current, inherited = _split(local.drop("held"), toggles, cells)
        levels.append(_level(size, _entries(calm, still), cells, kept))
        # Each further level starts from stored rows, so plans do not nest level in level.
        held = current.join(crowded.withColumnRenamed("n", "held"), ["c", "r"])
        current = written(_children(held), "cell-edges")
        inherited = written(_children(inherited), "cell-toggles")
        size /= FANOUT
    return RegionIndex(levels, members, bounds, kept)


def _level(size: float, entries: DataFrame, refined: DataFrame | None, kept: list[DataFrame]) -> Level:
    entries = _keep(entries, kept)
    measured = entries.agg(F.coalesce(F.sum(F.expr(ENTRY_WEIGHT)), F.lit(0)).alias("bytes")).first()["bytes"]
    return Level(size, entries, measured, refined)


def contains(edges: str, toggles: str, x: str, y: str) -> str:
    """SQL for the strict interior test of a point in the entry's cell.

    Edges run upward, so two comparisons leave the few that reach the point's height; only those are
    compared with the point's position.
    """
    side = orientation("e", x, y)
    on_edge = f"{side} = 0 and (e.y1 < e.y2 or {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2))"
    crossed = f"size(filter(near, e -> e.y2 > {y} and {side} > 0)) + size(filter({toggles}, t -> t > {y}))"
    near = f"filter({edges}, e -> e.y1 <= {y} and e.y2 >= {y})"
    decided = f"get(transform(array({near}), near -> not exists(near, e -> {on_edge}) and pmod({crossed}, 2) = 1), 0)"
    return f"if(size({edges}) = 0, true, {decided})"


def best_candidates(entries: DataFrame) -> DataFrame:
    """One row per cell: its regions, most specific first, ending at the first that fills the cell.

    Regions filling the cell are never collected, only the best of them is kept; the collected ones have
    edges in the cell, whose number is bounded. Those ranked after the best filling one can never be the
    answer there and are dropped.
    """
    ranked = entries.selectExpr("c", "r", "struct(-lvl as nl, gid) as rank", "edges", "toggles")
    grouped = ranked.groupBy("c", "r").agg(
        F.expr("min(if(size(edges) = 0, rank, null)) as best"),
        F.expr("collect_list(if(size(edges) > 0, struct(rank, edges, toggles), null)) as partial"),
    )
    return grouped.selectExpr(
        "c", "r",
        "concat(sort_array(filter(partial, k -> best is null or k.rank < best)), "
        "if(best is null, slice(partial, 1, 0), array(named_struct('rank', best, 'edges', cast(array() as "
        "array<struct<x1:double,y1:double,x2:double,y2:double>>), 'toggles', cast(array() as array<double>))))) as candidates",
    )
