"""A region index kept in a store, the bridge from lines to regions, lines of one region."""

import random

import pytest
from pyspark.sql import functions as F

from gridloam.operators.filters import lines_in_region
from gridloam.operators.spatial_join import assign_region, assign_regions_array, line_region_pairs, lines_meeting
from gridloam.plans.stored_index import crowding, load_region_index, store_region_index, update_region_index
from gridloam.session import fresh_path
from gridloam.sources.parted import Store

REGION = "id int, admin_level int, geometry array<array<array<struct<x:double,y:double>>>>"


def box(x, y, w, h):
    x, y, w, h = map(float, (x, y, w, h))
    return [[[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]]


def some_regions(rng, n):
    return {i: (rng.choice([1, 2]), box(rng.uniform(0, 50), rng.uniform(0, 50), rng.uniform(0.5, 6), rng.uniform(0.5, 6))) for i in range(n)}


def frame(spark, regions):
    return spark.createDataFrame([(i, lv, g) for i, (lv, g) in regions.items()], REGION)


@pytest.fixture
def points(spark):
    rng = random.Random(2)
    return spark.createDataFrame([(i, (rng.uniform(-2, 60), rng.uniform(-2, 60))) for i in range(800)], "k int, geometry struct<x:double,y:double>")


def found(points, index):
    return {r["k"]: r["region_id"] for r in assign_region(points, index).collect()}


@pytest.mark.parametrize("most_edges", [64, 6])
def test_updated_index_equals_a_new_one(spark, points, most_edges):
    rng = random.Random(most_edges)
    regions = some_regions(rng, 40)
    regions[60], regions[61] = regions[7], regions[7]
    store = Store(spark, fresh_path(spark, "store"))
    store_region_index(store, frame(spark, regions), buckets=4, max_cell_edges=most_edges)
    assert found(points, load_region_index(store)) == found(points, frame(spark, regions))
    lines = spark.createDataFrame([(i, [(rng.uniform(0, 55), rng.uniform(0, 55)) for _ in range(3)]) for i in range(80)], "id int, geometry array<struct<x:double,y:double>>")

    def pairs(index):
        return sorted(map(tuple, line_region_pairs(lines, index).collect()))

    # One moves, one of three equal ones goes (that with the least id), one comes, one changes its level.
    changed = dict(regions)
    changed[3] = (1, box(70, 70, 5, 5))
    del changed[7]
    changed[99] = (2, box(20, 20, 3, 9))
    changed[5] = (3 - changed[5][0], changed[5][1])
    told = update_region_index(store, frame(spark, changed))
    assert told["cut"] == 4 and told["gone"] == 3
    assert found(points, load_region_index(store)) == found(points, frame(spark, changed))
    assert pairs(load_region_index(store)) == pairs(frame(spark, changed))
    assert update_region_index(store, frame(spark, changed)) == {"cut": 0, "gone": 0, "buckets": 0}
    assert crowding(store).first()["edges"] > 0


def test_moving_one_region_rewrites_its_buckets_only(spark, points):
    regions = some_regions(random.Random(5), 12)
    store = Store(spark, fresh_path(spark, "store"))
    store_region_index(store, frame(spark, regions), buckets=32)
    before = {p["key"]: p["folder"] for p in store.parts("index_entries")}
    told = update_region_index(store, frame(spark, regions | {4: (regions[4][0], box(10, 10, 1, 1))}))
    after = {p["key"]: p["folder"] for p in store.parts("index_entries")}
    assert told["cut"] == told["gone"] == 1
    assert 0 < sum(before.get(k) != f for k, f in after.items()) <= told["buckets"] < len(before) / 2


def test_a_stored_index_is_used_without_building(spark, points):
    store = Store(spark, fresh_path(spark, "store"))
    store_region_index(store, frame(spark, some_regions(random.Random(6), 20)), buckets=4)
    plan = assign_region(points, load_region_index(store))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
    empty = Store(spark, fresh_path(spark, "store"))
    store_region_index(empty, frame(spark, {1: (1, None)}), buckets=4)
    assert set(found(points, load_region_index(empty)).values()) == {None}
    update_region_index(empty, frame(spark, {1: (1, box(0, 0, 60, 60))}))
    assert found(points, load_region_index(empty)) == found(points, frame(spark, {1: (1, box(0, 0, 60, 60))}))


def test_lines_of_one_region(spark):
    rng = random.Random(7)
    regions = frame(spark, some_regions(rng, 30))
    lines = spark.createDataFrame([(i, [(x := rng.uniform(0, 55), y := rng.uniform(0, 55)), (x + rng.uniform(-3, 3), y + rng.uniform(-3, 3))]) for i in range(300)] + [(999, None)], "id int, geometry array<struct<x:double,y:double>>")
    arrays = assign_regions_array(lines, regions)
    for r in (3, 17):
        want = sorted(x["id"] for x in lines_in_region(arrays, r).collect())
        assert sorted(x["id"] for x in lines_meeting(lines, regions, r).collect()) == want
    assert lines_meeting(lines, regions, 12345).count() == 0


def test_a_bridge_reads_a_small_share(spark):
    store = Store(spark, fresh_path(spark, "store"))
    pairs = spark.range(400_000).select((F.col("id") % 500).alias("region_id"), F.xxhash64("id").alias("line"))
    store.commit(store.append_sorted("bridge", pairs, ["region_id", "line"]))
    got = store.read("bridge").where("region_id = 77")
    assert got.count() == 800
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert "EqualTo(region_id,77)" in plan.toString()
    assert scan.metrics().apply("numOutputRows").value() < 400_000 * 0.4
