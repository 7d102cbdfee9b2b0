"""Point, line and overlay joins against brute force, with cells forced to be cut again and again."""

import random

import pytest
from pyspark.sql import functions as F

from gridloam.functions.geometry import LINE, MULTIPOLYGON, POINT, centroid
from gridloam.operators import spatial_join
from gridloam.operators.region_index import build_region_index
from gridloam.operators.spatial_join import (
    assign_region,
    assign_regions_array,
    fill_region,
    line_region_pairs,
    overlay_regions,
)

REGION = f"id long, admin_level int, geometry {MULTIPOLYGON}"


def ring(*pairs):
    pts = [{"x": float(x), "y": float(y)} for x, y in pairs]
    return pts + pts[:1]


def edges_of(shape):
    for part in shape:
        for r in part:
            yield from ((a["x"], a["y"], b["x"], b["y"]) for a, b in zip(r, r[1:]))


def side(ax, ay, bx, by, px, py):
    v = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    return (v > 0) - (v < 0)


def inside(shape, x, y):
    odd = False
    for x1, y1, x2, y2 in edges_of(shape):
        s = side(x1, y1, x2, y2, x, y)
        if s == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and (s > 0) == (y2 > y1):
            odd = not odd
    return odd


def meet(a, b):
    if max(a[0], a[2]) < min(b[0], b[2]) or min(a[0], a[2]) > max(b[0], b[2]):
        return False
    if max(a[1], a[3]) < min(b[1], b[3]) or min(a[1], a[3]) > max(b[1], b[3]):
        return False
    return side(*a, *b[:2]) * side(*a, *b[2:]) <= 0 and side(*b, *a[:2]) * side(*b, *a[2:]) <= 0


def line_meets(line, shape):
    pts = [(p["x"], p["y"]) for p in line]
    segments = [(*a, *b) for a, b in zip(pts, pts[1:])] or [(*pts[0], *pts[0])]
    return inside(shape, *pts[0]) or any(meet(s, e) for s in segments for e in edges_of(shape))


def star(rng, cx, cy, radius, n):
    """A simple closed ring around a centre, with corners at random distances."""
    import math

    out = []
    for i in range(n):
        angle = 2 * math.pi * i / n
        r = radius * rng.uniform(0.4, 1.0)
        out.append((cx + r * math.cos(angle), cy + r * math.sin(angle)))
    return out


def random_regions(seed, n=40, corners=30):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        cx, cy = rng.uniform(-10, 10), rng.uniform(-10, 10)
        radius = rng.choice([0.05, 0.5, 3.0, 8.0])
        part = [ring(*star(rng, cx, cy, radius, corners))]
        if i % 3 == 0:
            part.append(ring(*star(rng, cx, cy, radius * 0.2, 7)))  # a hole well inside
        shape = [part]
        if i % 4 == 0:
            shape.append([ring(*star(rng, cx + 20, cy, 1.0, 9))])
        out.append((i, 1 + i % 2, shape))
    out.append((100, 2, out[3][2]))  # the same shape again under another id
    return out


def best(regions, x, y):
    hits = [(-level, rid) for rid, level, shape in regions if inside(shape, x, y)]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("cell_edges", [64, 3])
@pytest.mark.parametrize("broadcast", [True, False])
def test_points_match_brute_force(spark, monkeypatch, cell_edges, broadcast):
    if not broadcast:
        monkeypatch.setattr(spatial_join, "BROADCAST_BYTES", -1)
    regions = random_regions(1)
    rng = random.Random(2)
    points = [(i, {"x": rng.uniform(-12, 32), "y": rng.uniform(-12, 12)}) for i in range(300)]
    points += [(1000 + i, {"x": v["x"], "y": v["y"]}) for i, v in enumerate(regions[0][2][0][0])]  # vertices
    points += [(2000 + i, {"x": regions[5][2][0][0][0]["x"] - 0.01, "y": regions[5][2][0][0][0]["y"]}) for i in range(200)]  # one crowded place
    points.append((9999, None))
    index = build_region_index(spark.createDataFrame(regions, REGION), max_cell_edges=cell_edges)
    assert len(index.levels) > 1 or cell_edges > 3
    found = assign_region(spark.createDataFrame(points, f"k int, geometry {POINT}"), index).select("k", "region_id").collect()
    want = {k: best(regions, p["x"], p["y"]) if p else None for k, p in points}
    assert {r["k"]: r["region_id"] for r in found} == want
    assert len(found) == len(points)


@pytest.mark.parametrize("cell_edges", [64, 3])
@pytest.mark.parametrize("broadcast", [True, False])
def test_lines_match_brute_force(spark, monkeypatch, cell_edges, broadcast):
    if not broadcast:
        monkeypatch.setattr(spatial_join, "BROADCAST_BYTES", -1)
    regions = random_regions(3)
    rng = random.Random(4)
    lines = []
    for i in range(80):
        x, y = rng.uniform(-12, 12), rng.uniform(-12, 12)
        step = rng.choice([0.0, 0.1, 2.0, 40.0])
        lines.append((i, [{"x": x + rng.uniform(-step, step), "y": y + rng.uniform(-step, step)} for _ in range(1 + i % 5)]))
    index = build_region_index(spark.createDataFrame(regions, REGION), max_cell_edges=cell_edges)
    pairs = line_region_pairs(spark.createDataFrame(lines, f"k int, geometry {LINE}"), index, key_col="k").collect()
    want = sorted((k, rid) for k, line in lines for rid, _, shape in regions if line_meets(line, shape))
    assert sorted((r["k"], r["region_id"]) for r in pairs) == want


def test_overlay_matches_brute_force(spark):
    a, b = random_regions(5, 15, 12), random_regions(6, 15, 12)
    b.append((200, 1, [[ring((-9, -9), (-8.9, -9), (-8.9, -8.9))]]))
    big = (201, 1, [[ring((-60, -60), (60, -60), (60, 60), (-60, 60))]])  # holds everything
    a.append(big)

    def touches(s, t):
        if any(meet(e, f) for e in edges_of(s) for f in edges_of(t)):
            return True
        return any(inside(t, p[0][0]["x"], p[0][0]["y"]) for p in s) or any(inside(s, p[0][0]["x"], p[0][0]["y"]) for p in t)

    got = overlay_regions(spark.createDataFrame(a, REGION), spark.createDataFrame(b, REGION)).collect()
    want = sorted((i, j) for i, _, s in a for j, _, t in b if touches(s, t))
    assert sorted((r["a_id"], r["b_id"]) for r in got) == want


SQUARE_WITH_HOLE = [[ring((0, 0), (8, 0), (8, 8), (0, 8)), ring((2, 2), (2, 6), (6, 6), (6, 2))], [ring((20, 0), (24, 0), (24, 4), (20, 4))]]


def test_boundary_is_outside(spark):
    cases = {
        (1.0, 1.0): 1, (4.0, 4.0): None, (2.0, 4.0): None, (0.0, 4.0): None, (8.0, 8.0): None, (7.0, 2.0): 1,
        (1.0, 2.0): 1, (7.0, 6.0): 1, (22.0, 2.0): 1, (20.0, 0.0): None, (12.0, 2.0): None, (-1.0, 0.0): None, (22.0, 4.0): None,
    }
    regions = spark.createDataFrame([(1, 1, SQUARE_WITH_HOLE)], REGION)
    points = spark.createDataFrame([(i, {"x": x, "y": y}) for i, (x, y) in enumerate(cases)], f"k int, geometry {POINT}")
    for cell_edges in (64, 1):
        index = build_region_index(regions, max_cell_edges=cell_edges)
        got = {r["k"]: r["region_id"] for r in assign_region(points, index).collect()}
        assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_touching_lines_count(spark):
    lines = {
        "corner": ([(-1, 1), (1, -1)], [1]),
        "collinear": ([(8, 1), (8, 3)], [1]),
        "inside": ([(1, 1), (1, 3)], [1]),
        "in hole": ([(3, 3), (5, 5)], None),
        "hole edge": ([(3, 2), (5, 2)], [1]),
        "outside": ([(10, 1), (18, 1)], None),
        "across": ([(-5, 1), (30, 1)], [1]),
        "dot": ([(1, 1)], [1]),
    }
    data = [(k, [{"x": float(x), "y": float(y)} for x, y in v[0]], None) for k, v in lines.items()]
    data.append(("given", data[0][1], [77]))
    data.append(("empty", data[0][1], []))
    data.append(("no shape", None, None))
    df = spark.createDataFrame(data, f"id string, geometry {LINE}, region_ids array<long>")
    got = {r["id"]: r["region_ids"] for r in assign_regions_array(df, spark.createDataFrame([(1, 1, SQUARE_WITH_HOLE)], REGION)).collect()}
    assert got == {k: v[1] for k, v in lines.items()} | {"given": [77], "empty": [1], "no shape": None}


def test_centroid(spark):
    shapes = [
        (1, 1, [[ring((0, 0), (4, 0), (4, 2), (0, 2))]]),
        (2, 1, [[ring((0, 0), (0, 2), (4, 2), (4, 0))]]),  # other winding
        (3, 1, [[ring((0, 0), (8, 0), (8, 8), (0, 8)), ring((0, 0), (4, 0), (4, 8), (0, 8))]]),  # left half cut out
        (4, 1, [[ring((0, 0), (2, 0), (2, 2), (0, 2))], [ring((10, 0), (12, 0), (12, 2), (10, 2))]]),
        (5, 1, [[ring((1, 1), (5, 1))]]),  # no area
        (6, 1, [[ring((3, 4))]]),  # no length
        (7, 1, None),
    ]
    df = spark.createDataFrame(shapes, REGION).select("id", centroid("geometry").alias("c"))
    got = {r["id"]: (r["c"]["x"], r["c"]["y"]) if r["c"] and r["c"]["x"] is not None else None for r in df.collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (6, 4), 4: (6, 1), 5: (3, 1), 6: (3, 4), 7: None}


def test_fill_keeps_given_regions_and_stamps(spark):
    points = [(1, {"x": 1.0, "y": 1.0}, 55, None), (2, {"x": 1.0, "y": 1.0}, None, None), (3, None, None, None)]
    df = spark.createDataFrame(points, f"k int, geometry {POINT}, region_id long, updated_at string")
    out = fill_region(df, spark.createDataFrame([(1, 1, SQUARE_WITH_HOLE)], REGION), updated_at=F.lit("now")).collect()
    assert {r["k"]: (r["region_id"], r["updated_at"]) for r in out} == {1: (55, "now"), 2: (1, "now"), 3: (None, "now")}


def test_no_regions(spark):
    points = spark.createDataFrame([(1, {"x": 1.0, "y": 1.0})], f"k int, geometry {POINT}")
    lines = spark.createDataFrame([(1, [{"x": 1.0, "y": 1.0}])], f"id int, geometry {LINE}")
    none = spark.createDataFrame([], REGION)
    assert assign_region(points, none).first()["region_id"] is None
    assert assign_regions_array(lines, none).first()["region_ids"] is None


def test_point_join_plan(spark):
    regions = spark.createDataFrame(random_regions(1), REGION)
    points = spark.range(1000).select("id", F.struct((F.col("id") / 100).alias("x"), (F.col("id") / 50).alias("y")).alias("geometry"))
    plan = assign_region(points.withColumnRenamed("id", "k"), build_region_index(regions))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    physical = plan.split("InMemoryRelation")[0]
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert name not in plan
    assert "BroadcastHashJoin" in physical


def index_rows(index):
    return sum(level.entries.count() for level in index.levels), sum(level.entries.selectExpr("coalesce(sum(size(edges) + size(toggles)), 0) as n").first()["n"] for level in index.levels)


def test_shared_borders_do_not_blow_up_the_index(spark):
    sides = [(i, 1, [[ring((0, 0), (4 + i / 64, 0), (4 + i / 64, 3 + i / 32), (0, 3 + i / 32))]]) for i in range(200)]
    regions = spark.createDataFrame(sides, REGION)
    index = build_region_index(regions)
    # 200 regions lie on each other, so a cell inside all of them has 200 rows; what counts is that cutting ends.
    entries, values = index_rows(index)
    assert len(index.levels) <= 4 and entries < 1_000_000 and values < 1_000_000
    points = spark.createDataFrame([(1, {"x": 3.9, "y": 2.9}), (2, {"x": 5.0, "y": 2.0}), (3, {"x": 0.0, "y": 1.0})], "i int, geometry struct<x:double,y:double>")
    got = {r["i"]: r["region_id"] for r in assign_region(points, index).collect()}
    assert got == {1: 0, 2: 65, 3: None}


def test_index_of_a_long_ring_is_linear(spark):
    shape = [[ring(*star(random.Random(5), 0, 0, 10.0, 8000))]]
    index = build_region_index(spark.createDataFrame([(1, 1, shape)], REGION))
    _, values = index_rows(index)
    assert values < 80 * 8000


def test_regions_deep_on_each_other_are_not_cut_again_and_again(spark):
    """Twice as many regions on the same ground make an index twice as large."""
    rng = random.Random(11)
    places = [(rng.uniform(0, 6), rng.uniform(0, 6), rng.uniform(0.5, 2), rng.uniform(0.5, 2)) for _ in range(1600)]
    regions = [(i, 1, [[ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))]]) for i, (x, y, w, h) in enumerate(places)]
    sizes = []
    for n in (800, 1600):
        index = build_region_index(spark.createDataFrame(regions[:n], REGION))
        sizes.append(sum(level.entries.count() for level in index.levels))
    assert sizes[1] < 2.5 * sizes[0] and sizes[1] < 200 * 1600
    points = [(i, {"x": rng.uniform(0, 8), "y": rng.uniform(0, 8)}) for i in range(200)]
    found = assign_region(spark.createDataFrame(points, f"k int, geometry {POINT}"), index).collect()
    assert {r["k"]: r["region_id"] for r in found} == {k: best(regions, p["x"], p["y"]) for k, p in points}


def test_regions_filling_a_cell_that_is_cut_stay_with_it(spark):
    """Many small regions in one place below many that hold all of it: these are not repeated in every smaller cell."""
    rng = random.Random(12)
    small = [(i, 1, [[ring((x := rng.uniform(10, 10.2), y := rng.uniform(10, 10.2)), (x + 0.002, y), (x, y + 0.002))]]) for i in range(300)]
    large = [(1000 + i, 2 if i == 7 else 1, [[ring((-i - 1, -i - 1), (60 + i, -i - 1), (60 + i, 60 + i), (-i - 1, 60 + i))]]) for i in range(40)]
    index = build_region_index(spark.createDataFrame(small + large, REGION))
    assert len(index.levels) > 1
    deeper = [level.entries.where("gid >= 1000").count() for level in index.levels[1:]]
    assert deeper == [0] * len(deeper)
    points = [(i, {"x": 10 + (i % 14) * 0.015, "y": 10 + (i // 14) * 0.015}) for i in range(196)]
    points += [(500 + i, {"x": s[0][0][0]["x"] + 0.0005, "y": s[0][0][0]["y"] + 0.0005}) for i, (_, _, s) in enumerate(small)]
    for regions in (small + large, small + [r for r in large if r[1] == 1]):
        found = assign_region(spark.createDataFrame(points, f"k int, geometry {POINT}"), spark.createDataFrame(regions, REGION)).collect()
        assert {r["k"]: r["region_id"] for r in found} == {k: best(regions, p["x"], p["y"]) for k, p in points}


def test_an_index_for_given_points_keeps_their_cells(spark):
    """What the overlay needs of its first side: only the cells that hold a first vertex of the second."""
    regions = spark.createDataFrame(random_regions(13), REGION)
    probes = spark.createDataFrame([(0.5, 0.5), (3.25, -4.5)], "x double, y double")
    whole, part = build_region_index(regions), build_region_index(regions, probes=probes)
    assert part.levels[0].entries.select("c", "r").distinct().count() <= 2 < whole.levels[0].entries.select("c", "r").distinct().count()
    points = probes.withColumn("geometry", F.struct("x", "y"))
    assert sorted(assign_region(points, part).collect()) == sorted(assign_region(points, whole).collect())
