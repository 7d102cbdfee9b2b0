import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloam.operators import skew
from gridloam.operators.clustering import cluster_expansion_zoom, cluster_points
from gridloam.operators.filters import select_layers, status_filter
from gridloam.operators.history import current_snapshot, history
from gridloam.operators.quality import check_domain, check_unique, domain_rules
from gridloam.operators.skew import hot_keys, lookup_join
from gridloam.operators.tables import append_snapshot, last_wins, register_methodology, remove_methodology, remove_regions, upsert, write_snapshot
from gridloam.plans.loads import FEASIBILITY_PROPERTIES, feasibility_features
from gridloam.session import fresh_path
from gridloam.sources.geojson import check_collection, epsg_of, read_collection, read_features
from gridloam.sources.stored import on_optional_missing, publish, read_published

ROW = "k int, version int, name string, license string"


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_upsert(spark, small_rows):
    target = spark.createDataFrame([(1, 1, "a", "L"), (2, 1, "b", "L"), (None, 1, "n", "L")], ROW)
    batch = spark.createDataFrame(
        [(1, 2, None, "M", 0), (3, 2, "c1", "M", 1), (3, 2, "c2", "M", 2), (None, 1, "n2", "M", 3), (None, 1, "n3", "M", 4)], ROW + ", row_idx int"
    )

    def run(t):
        return upsert(t, batch, ["k"], ["version", "name"], ["license"], small_rows=small_rows)

    want = [(1, 2, None, "L"), (2, 1, "b", "L"), (3, 2, "c2", "M"), (None, 1, "n", "L"), (None, 1, "n2", "M"), (None, 1, "n3", "M")]
    once = run(target)
    assert tuples(once, "k", "version", "name", "license") == sorted(want, key=str)
    keyed = once.where("k is not null")
    assert tuples(run(keyed).where("k is not null"), "*") == tuples(keyed, "*")


def test_upsert_needs_a_rule_for_every_column(spark):
    target = spark.createDataFrame([(1, 1, "a", "L")], ROW)
    with pytest.raises(ValueError, match="license"):
        upsert(target, target, ["k"], ["version", "name"])


def test_last_wins_plan_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plan = last_wins(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert tuples(last_wins(df, ["k"], "id"), "k", "id") == sorted(((k, max(range(k, 1000, 7))) for k in range(7)), key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_with_hot_and_null_keys(spark, how):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50).cast("int").alias("k"))
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)], "k int, v string")
    assert {r["k"] for r in hot_keys(facts, ["k"], 0.2).collect()} == {1}
    salted = lookup_join(facts, lookup, ["k"], how, small_rows=0, share=0.2)
    assert tuples(salted, *salted.columns) == tuples(facts.join(lookup, ["k"], how), *salted.columns)


def test_salted_join_deals_a_hot_key_over_many_parts(spark):
    facts = spark.range(5000).select("id", F.lit(1).alias("k"))
    salted = lookup_join(facts, spark.createDataFrame([(1, "v")], "k int, v string"), ["k"], "left", small_rows=0)
    parts = hot_keys(facts, ["k"]).first()["_parts"]
    assert parts == round(1 / skew.HOT_SHARE)
    assert salted.count() == 5000


def test_snapshots(spark):
    rows = "region_id string, methodology_version string, computed_at timestamp, value double"
    day = datetime(2026, 1, 1)
    old = spark.createDataFrame([("a", "v1", day, 1.0)], rows)
    versions = register_methodology(spark.createDataFrame([], "version string, description string, published_at timestamp, methodology_url string"), "v1", "d", day)
    fine = spark.createDataFrame([("a", "v1", datetime(2026, 1, 2), 2.0)], rows)
    assert append_snapshot(old, fine, versions).count() == 1
    with pytest.raises(ValueError, match="already stored"):
        append_snapshot(old, old)
    with pytest.raises(ValueError, match="duplicate"):
        append_snapshot(None, fine.union(fine))
    with pytest.raises(ValueError, match="unregistered"):
        append_snapshot(old, fine.withColumn("methodology_version", F.lit("v9")), versions)
    with pytest.raises(ValueError, match="already registered"):
        register_methodology(versions, "v1", "d", day)
    with pytest.raises(ValueError, match="in use"):
        remove_methodology(versions, old, "v1")
    assert current_snapshot(old.union(fine)).collect()[0]["value"] == 2.0


def test_stored_history_prunes_by_run_date(spark):
    path = fresh_path(spark, "snapshots")
    rows = "region_id string, methodology_version string, computed_at timestamp, value double"
    for day in (1, 2, 3):
        write_snapshot(spark.createDataFrame([("a", "v1", datetime(2026, 1, day), float(day)), ("b", "v1", datetime(2026, 1, day), 0.0)], rows), path)
    stored = spark.read.parquet(path)
    found = history(stored, "a", datetime(2026, 1, 2), datetime(2026, 1, 3))
    assert [r["value"] for r in found.collect()] == [3.0, 2.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "run_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert current_snapshot(stored).where("region_id = 'a'").first()["value"] == 3.0


def test_remove_regions(spark):
    regions = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id int, parent_region_id int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "k int, region_id int")
    lines = spark.createDataFrame([(1, [1, 2])], "k int, region_ids array<int>")
    out = remove_regions(regions, spark.createDataFrame([(1,)], "id int"), {"substations": child, "grid_feasibility": child, "powerlines": lines})
    assert tuples(out["regions"], "id", "parent_region_id") == [(2, None), (3, 2)]
    assert tuples(out["substations"], "k", "region_id") == [(10, None), (11, 2), (12, None)]
    assert tuples(out["grid_feasibility"], "k", "region_id") == [(11, 2), (12, None)]
    assert out["powerlines"].first()["region_ids"] == [1, 2]


def test_checks(spark):
    df = spark.createDataFrame([("a", "US", 1, "g"), (None, "US", 3, "g")], "name string, country_code string, admin_level int, geometry string")
    good, bad = check_domain(df, domain_rules("regions"))
    assert good.count() == 1 and bad.first()["violations"] == ["name is null", "admin_level"]
    keys = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1)], "a int, b int")
    assert tuples(check_unique(keys, ["a", "b"]), "a", "b", "n") == [(1, 1, 2)]


def test_layers(spark):
    df = spark.createDataFrame([("operational",), ("planned",), ("decommissioned",), ("announced",), ("unknown",)], "status string")
    assert status_filter(df).count() == 4 and status_filter(df, False).count() == 2 and status_filter(df, False, True).count() == 3
    assert select_layers({"frontier": df, "osm": df}, []).count() == 0
    assert select_layers({"frontier": df, "osm": df}, ["osm"]).count() == 5


def test_clusters(spark):
    points = spark.createDataFrame(
        [(i, {"x": 2 + 0.1 * (i % 5), "y": 1.0}, "planned" if i % 2 else "retired") for i in range(10)] + [(99, {"x": 100.0, "y": 40.0}, "planned")],
        "k int, geometry struct<x:double,y:double>, status string",
    )
    for zoom in range(0, 12):
        assert cluster_points(points, zoom, 50, 8).agg(F.sum("point_count")).first()[0] == 11
    lone = cluster_points(points, 3, 50, 8, ["k"]).where("point_count = 1").first()
    assert (lone["k"], lone["x"], lone["y"]) == (99, 100.0, 40.0)
    assert cluster_points(points, 9, 50, 8).count() == 11
    after = cluster_points(points, 3, 50, 8, ["k"], status_statuses=["retired"])
    assert [r["point_count"] for r in after.collect()] == [10]
    before = cluster_points(points, 3, 50, 8, ["k"], status_statuses=["retired"], filter_before=True)
    assert [r["point_count"] for r in before.collect()] == [5]
    assert cluster_expansion_zoom(points.where("k % 5 = 0"), 3, 50, 8).first()["expansion_zoom"] == 9


def write_text(spark, path, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def collection(**changes):
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    shapes = [{"type": "Polygon", "coordinates": square}, {"type": "MultiPolygon", "coordinates": [square, square]}, {"type": "Point", "coordinates": [1, 2]}, None]
    body = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": g, "properties": {"n": i}} for i, g in enumerate(shapes)]}
    return json.dumps(body | changes, indent=1)


def test_read_collection(spark, caplog):
    path = write_text(spark, fresh_path(spark, "fc"), collection(crs={"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}))
    rows = read_features(spark, path, expected=5).orderBy("row_idx").collect()
    assert "found 4 features, expected 5" in caplog.text
    assert [r["row_idx"] for r in rows] == [0, 1, 2, 3]
    assert [r["geometry"] and r["geometry"]["type"] for r in rows] == ["Polygon", "MultiPolygon", "Point", None]
    assert [json.loads(r["properties"])["n"] for r in rows] == [0, 1, 2, 3]
    assert epsg_of(read_collection(spark, path)) == 3857
    for text, message in [(collection(type="Feature"), "expected a FeatureCollection"), (collection(features=[]), "no features")]:
        with pytest.raises(ValueError, match=message):
            check_collection(read_collection(spark, write_text(spark, fresh_path(spark, "fc"), text)))


def test_feasibility_features_refuse_missing_properties(spark):
    whole = {n: 1 for n in FEASIBILITY_PROPERTIES} | {"is_dc_hotspot": None, "feasibility_category": "low"}

    def load(props):
        df = spark.createDataFrame([(0, None, json.dumps(props))], "row_idx int, geometry struct<type:string,coordinates:string>, properties string")
        return feasibility_features(df).collect()[0]

    row = load(whole)
    assert row["components"]["is_dc_hotspot"] is False and row["category"] == "low_feasibility" and row["components"]["queue"]["q_projects"] == 1
    with pytest.raises(Exception, match="feature lacks properties: q_wind_mw"):
        load({k: v for k, v in whole.items() if k != "q_wind_mw"})
    with pytest.raises(Exception, match="required field missing or invalid: q_wind_mw"):
        load(whole | {"q_wind_mw": None})


def test_publish_is_all_or_nothing(spark):
    path = fresh_path(spark, "table")
    publish(spark.range(3), path)

    def refuse(_):
        raise ValueError("not fit")

    with pytest.raises(ValueError, match="not fit"):
        publish(spark.range(5), path, refuse)
    assert read_published(spark, path).count() == 3
    missing = on_optional_missing(spark, lambda: spark.read.parquet("/nowhere/at/all"), "a int")
    assert missing.count() == 0 and missing.columns == ["a"]
    with pytest.raises(Exception):
        spark.read.parquet("/nowhere/at/all")
