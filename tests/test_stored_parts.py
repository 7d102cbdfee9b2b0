"""Documents read in splits, one order over files, tables changed by their parts, cluster pyramids."""

import json
import math
import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridloam.operators.clustering import cluster_points, cluster_pyramid
from gridloam.operators.history import current_snapshot
from gridloam.operators.tables import merged_once, upsert
from gridloam.plans.loads import FEASIBILITY_PROPERTIES, cluster_rows, feasibility_features, osm_rows, with_status_count
from gridloam.plans.stored_load import store_feasibility, store_rows
from gridloam.session import fresh_path
from gridloam.sources.geojson import read_feature_lines, read_features
from gridloam.sources.parted import Store
from gridloam.sources.split_geojson import read_split_features


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def feature(rng, i):
    texts = ["a", '}{"features":[{', 'q"}\\"x\\\\', 'é}\n"', '"features": [', "\\", "]}]"]
    deep = [[], [{"a": []}], {"features": [1, {"b": {}}]}, None, "}" * 40]
    shapes = [None, {"type": "Point", "coordinates": [i, 2]}, {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [1, 0], [0, 0]]] * rng.randint(1, 5)}]
    out = {"type": "Feature", "geometry": rng.choice(shapes), "properties": {"k": i, "n": rng.choice(texts) * rng.randint(0, 3), "l": rng.choice(deep)}}
    return dict(reversed(out.items())) if rng.random() < 0.5 else out


def plain(rows):
    """Rows with their JSON text read, so that blanks in it do not matter."""

    def one(r):
        g = r["geometry"]
        return r["row_idx"], g and g["type"], g and json.loads(g["coordinates"]), json.loads(r["properties"]), r["epsg"]

    return sorted(map(one, rows), key=lambda r: r[0])


@pytest.mark.parametrize(("indent", "around"), [(None, False), (1, True), (None, True)])
def test_split_document_equals_whole_reading(spark, tmp_path, small_splits, indent, around):
    rng = random.Random(str((indent, around)))
    doc = {"type": "FeatureCollection", "features": [feature(rng, i) for i in range(60)]}
    if around:
        other = [{"features": [{"x": 1}, {"y": "}"}]}, {"z": 2}]
        doc = {"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "other": other, "bbox": [1, 2], **doc, "tail": [{"p": 1}, {"features": [{"type": "Feature"}]}]}
        doc = dict(reversed(doc.items())) if indent else doc
    path = str(tmp_path / "doc.json")
    (tmp_path / "doc.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=False) + ("\n  \n" if around else ""))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 2
    assert plain(read_split_features(spark, path).collect()) == plain(read_features(spark, path).collect())


def test_split_documents_that_are_none(spark, tmp_path):
    for name, text, reason in [("other", '{"type": "Nothing", "features": [{"a": 1}]}', "expected a FeatureCollection"), ("number", '{"type": "FeatureCollection", "features": [{"a": 1}, 7, {"a": 2}]}', "no object")]:
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=reason):
            read_split_features(spark, str(tmp_path / name)).collect()
    (tmp_path / "empty").write_text('{"type": "FeatureCollection", "features": []}')
    assert read_split_features(spark, str(tmp_path / "empty")).count() == 0


def test_lines_are_numbered_over_files_of_unequal_size(spark, tmp_path, small_splits):
    sizes = {"a": 3, "b": 200, "c": 40}
    for name, n in sizes.items():
        lines = [json.dumps({"type": "Feature", "geometry": None, "properties": {"f": name, "i": i}}) for i in range(n)]
        (tmp_path / f"{name}.json").write_text("\n\n".join(lines) + "\n")
    rows = read_feature_lines(spark, str(tmp_path)).collect()
    assert [(json.loads(r["properties"])["f"], json.loads(r["properties"])["i"]) for r in sorted(rows, key=lambda r: r["row_idx"])] == [(f, i) for f, n in sizes.items() for i in range(n)]
    assert sorted(r["row_idx"] for r in rows) == list(range(243))


def test_a_load_follows_the_code_each_feature_brings(spark):
    row = "row_idx long, geometry struct<type:string,coordinates:string>, properties string, epsg int"
    place, bag = ("Point", "[-8900000.0, 4500000.0]"), '{"full_id": "w1"}'
    features = spark.createDataFrame([(0, place, bag, 3857), (1, ("Point", "[-80.0, 37.0]"), bag, None), (2, ("Point", "[-80.0, 37.0]"), bag, 4326)], row)
    rows, _ = osm_rows(features, "2026-05-01", F.lit(datetime(2026, 5, 1)))
    got = {r["row_idx"]: (round(r["geometry"]["x"], 3), round(r["geometry"]["y"], 3)) for r in rows.collect()}
    radius = 6378137.0
    web = round(math.degrees(-8900000 / radius), 3), round(math.degrees(math.atan(math.sinh(4500000 / radius))), 3)
    assert got == {0: web, 1: (-80.0, 37.0), 2: (-80.0, 37.0)}
    with pytest.raises(Exception, match="EPSG:2056"):
        osm_rows(features.withColumn("epsg", F.lit(2056)), "2026-05-01", F.lit(datetime(2026, 5, 1)))[0].collect()


# ---------------------------------------------------------------- stored parts

SITE = "k string, v string, name string, kept string, row_idx int"


def sites(spark, rows):
    return spark.createDataFrame(rows, SITE)


RULE = {"keys": ["k", "v"], "replace": ["name"], "keep": ["kept"], "by": ["v"], "buckets": 4}


def shown(df):
    return sorted(map(tuple, df.select("k", "v", "name", "kept").collect()), key=str)


def test_upsert_rewrites_touched_parts_only(spark):
    store = Store(spark, fresh_path(spark, "store"))
    first = sites(spark, [(f"k{i}", "a" if i % 2 else "b", f"n{i}", "x", i) for i in range(40)])
    store.commit(store.upsert("sites", first, **RULE))
    before = {p["key"]: p["folder"] for p in store.parts("sites")}
    assert len(before) == 8 and store.count("sites") == 40
    batch = sites(spark, [("k3", "a", "new", "y", 0), ("k3", "a", None, "z", 1), (None, "a", "null", "n", 2)])
    change = store.upsert("sites", batch, **RULE)
    assert change.counts == {"batch": 2, "new": 1}
    assert {p["key"]: p["folder"] for p in store.parts("sites")} == before
    store.commit(change)
    after = {p["key"]: p["folder"] for p in store.parts("sites")}
    moved = {k for k in after if after[k] != before[k]}
    assert 1 <= len(moved) <= 2 and all('"v":"a"' in k for k in moved)
    want = {tuple(r)[:2]: tuple(r)[:4] for r in first.collect()} | {("k3", "a"): ("k3", "a", None, "x"), (None, "a"): (None, "a", "null", "n")}
    assert shown(store.read("sites")) == sorted(want.values(), key=str)
    assert store.count("sites") == 41 and shown(store.read("sites", version=1)) == shown(first)


def test_upsert_opens_touched_parts_once(spark):
    store = Store(spark, fresh_path(spark, "store"))
    store.commit(store.upsert("sites", sites(spark, [(f"k{i}", "a", "n", "x", i) for i in range(400)]), **RULE | {"buckets": 64}))
    arriving = store._bucketed("sites", sites(spark, [("k7", "a", "m", "y", 0)]), RULE["keys"], 64)
    parts, target = store._touched("sites", arriving, ["v"])
    assert len(parts) == 1 and target.count() < 40
    plan = merged_once(target, arriving, ["k", "v"], ["name"], ["kept"], ["row_idx"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_merging_once_equals_upsert(spark):
    rng = random.Random(8)
    target = sites(spark, [(rng.choice([None, f"k{i}"]), "a", f"n{i}", "x", 0) for i in range(60)]).drop("row_idx")
    batch = sites(spark, [(rng.choice([None, f"k{rng.randrange(90)}"]), "a", f"m{i}", "y", i) for i in range(60)])
    args = (["k", "v"], ["name"], ["kept"], ["row_idx"])
    assert shown(merged_once(target, batch, *args)) == shown(upsert(target, batch, *args))


def test_runs_arriving_late_leave_the_current_rows_right(spark):
    store, rng = Store(spark, fresh_path(spark, "store")), random.Random(9)
    days = list(range(1, 7))
    rng.shuffle(days)
    row, whole = "region_id string, methodology_version string, computed_at timestamp, value double", None
    for d in days:
        run = spark.createDataFrame([(rng.choice([None, *"abcdef"]), "v1", datetime(2026, 1, d, 12, i), float(i)) for i in range(5)], row)
        whole = run if whole is None else whole.unionByName(run)
        store.commit(store.append("history", run, "computed_at"), store.latest("current", run, ["region_id", "methodology_version"], "computed_at", buckets=4))
    assert sorted(map(str, store.read("current").collect())) == sorted(map(str, current_snapshot(whole).collect()))
    some = store.read_between("history", "computed_at", datetime(2026, 1, 4), datetime(2026, 1, 5))
    assert some.count() == 5 and len(some.inputFiles()) < len(store.read("history").inputFiles()) / 3
    assert store.count("history") == 30 and store.version() == 6


def features(spark, names, category="high"):
    bag = {p: 1.0 for p in FEASIBILITY_PROPERTIES}
    shape = ("MultiPolygon", "[[[[0,0],[1,0],[1,1],[0,0]]]]")
    rows = [(i, shape, json.dumps({**bag, "county_name": n, "fips": n[:1], "feasibility_category": category, "is_dc_hotspot": False})) for i, n in enumerate(names)]
    return feasibility_features(spark.createDataFrame(rows, "row_idx long, geometry struct<type:string,coordinates:string>, properties string"))


def test_regions_history_and_current_values_change_together(spark):
    store = Store(spark, fresh_path(spark, "store"))
    versions = spark.createDataFrame([("1",)], "version string")
    at = [datetime(2026, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    assert store_feasibility(features(spark, ["a one", "b one"]), store, versions, "1", at[0], buckets=2) == {"regions": 2, "appended": 2}
    assert store_feasibility(features(spark, ["a two", "c two"]), store, versions, "1", at[1], buckets=2) == {"regions": 3, "appended": 2}

    def state():
        return [sorted(map(str, store.read(t).collect())) for t in ("regions", "grid_feasibility", "current_feasibility")]

    before = state()
    assert {r["name"] for r in store.read("regions").collect()} == {"a two", "b one", "c two"} and [len(s) for s in before] == [3, 4, 3]
    for bad, version, when, reason in [(["a bad", "d bad"], "2", at[2], "unregistered"), (["a bad", "d bad"], "1", at[1], "already stored")]:
        with pytest.raises(ValueError, match=reason):
            store_feasibility(features(spark, bad), store, versions, version, when, buckets=2)
        assert state() == before
    with pytest.raises(Exception):
        store_feasibility(features(spark, ["a bad"], "no such category"), store, versions, "1", at[2], buckets=2)
    assert state() == before
    # A region without a code is a region all the same, and its value goes with it.
    nameless = features(spark, ["e one"]).withColumn("admin_code", F.lit(None).cast("string"))
    assert store_feasibility(nameless, store, versions, "1", at[2], buckets=2) == {"regions": 4, "appended": 1}
    assert store.read("grid_feasibility").join(store.read("regions").select(F.col("id").alias("region_id")), "region_id").count() == 5
    runs = {p["folder"] for p in store.parts("grid_feasibility")}
    assert len(runs) == 3 and len({re.search("_run=[^/]+", f)[0] for f in runs}) == 3


def test_store_rows_counts(spark):
    store = Store(spark, fresh_path(spark, "store"))
    bags = [(i, ("Point", "[1.0, 2.0]"), json.dumps({"full_id": f"w{i % 3}", "name": f"n{i}"})) for i in range(5)] + [(9, None, '{"full_id": "w9"}')]
    rows, rejected = osm_rows(spark.createDataFrame(bags, "row_idx long, geometry struct<type:string,coordinates:string>, properties string"), "2026-05-01", F.lit(datetime(2026, 5, 1)))
    assert store_rows("osm", store, rows, rejected, buckets=4) == {"read": 6, "written": 3, "rejected": 1, "stored": 3}
    assert {r["name"] for r in store.read("osm").collect()} == {"n2", "n3", "n4"}
    with pytest.raises(ValueError, match="break the rules"):
        store_rows("osm", store, rows.withColumn("license", F.lit(None).cast("string")), buckets=4)
    assert store.version() == 1
    with pytest.raises(FileNotFoundError):
        store.read("nothing")
    bags = [(i, None, json.dumps({"Name": f"c{i}", "Status": status})) for i, status in enumerate(["Existing", "odd", "", None, "unheard of"])]
    features, statuses = with_status_count(spark.createDataFrame(bags, "row_idx long, geometry struct<type:string,coordinates:string>, properties string"))
    clusters = cluster_rows(features, "2026-05-01", F.lit(datetime(2026, 5, 1)))
    assert store_rows("clusters", store, clusters, statuses=statuses, buckets=2) == {"read": 5, "written": 5, "rejected": 0, "stored": 5, "unrecognised": 2}


def test_pyramid_equals_single_zooms_and_reads_points_once(spark):
    rng = random.Random(3)
    points = spark.createDataFrame([(i, (rng.gauss(-78, 2), rng.gauss(38, 2))) for i in range(500)] + [(900, None)], "k int, geometry struct<x:double,y:double>")
    zooms = [3, 5, 6, 9, 10]
    got = cluster_pyramid(points, zooms, 50, 8, ["k"])
    for z in zooms:
        want = cluster_points(points, z, 50, 8, ["k"]).collect()
        own = got.where(F.col("zoom") == z).drop("zoom").collect()
        assert sorted((r[0], round(r[1], 6), round(r[2], 6), r[3] or 0) for r in own) == sorted((r[0], round(r[1], 6), round(r[2], 6), r[3] or 0) for r in want)
    assert cluster_pyramid(points, [3], 50, 8)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
