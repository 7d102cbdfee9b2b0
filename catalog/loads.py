"""Whole loads: features written from the given tables, read back as GeoJSON and turned into table rows."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.changes import STORED_AT, region_batch, stored_regions
from catalog.registry import ORACLES, query
from gridloam.functions.geometry import decode_geometry
from gridloam.operators.tables import last_wins, upsert_table
from gridloam.plans.loads import (
    CLUSTER_PROPERTIES,
    FEASIBILITY_PROPERTIES,
    FRONTIER_PROPERTIES,
    OSM_PROPERTIES,
    cluster_rows,
    feasibility_features,
    frontier_rows,
    load_feasibility,
    osm_rows,
    placed,
)
from gridloam.plans.stored_load import store_feasibility, store_regions, store_rows
from gridloam.session import fresh_path
from gridloam.sources.geojson import feature_json, parse_properties, read_feature_lines, write_features
from gridloam.sources.parted import Store
from gridloam.sources.split_geojson import read_split_features

RUN_AT = datetime(2026, 5, 5, tzinfo=timezone.utc)


def through_geojson(df, properties, kind="point", index_property=None):
    """Rows written one feature per line by all tasks and read back as features."""
    path = fresh_path(df.sparkSession, "features")
    write_features(df, path, kind, properties)
    return read_feature_lines(df.sparkSession, path, index_property)


def located_customers(spark, sf_dir):
    points = t.customer_points(spark, sf_dir)
    return points.withColumn("geometry", F.when(F.col("c_custkey") % 9 != 0, F.col("geometry")))


@query("""SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 9 <> 0 THEN -80 + ((c_custkey * 37) % 81) / 4::DOUBLE END AS x,
  CASE WHEN c_custkey % 9 <> 0 THEN 30 + ((c_custkey * 53) % 79) / 4::DOUBLE END AS y FROM customer""")
def geojson_round_trip(spark, sf_dir):
    features = through_geojson(located_customers(spark, sf_dir), ["c_custkey", "c_name", "c_acctbal"])
    named = parse_properties(features, ["c_custkey", "c_name", "c_acctbal"]).withColumn("g", decode_geometry("geometry", "point"))
    return named.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "g.x", "g.y")


@query("""SELECT substr(sha256(c_name || '||' || c_mktsegment), 1, 16) AS source_id, 'epoch_ai_frontier' AS source, c_name AS name, NULL::VARCHAR AS owner, c_mktsegment AS country,
  'unknown' AS status, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS power_capacity_mw, c_custkey::DOUBLE AS h100_equivalent, c_custkey % 9 <> 0 AS has_geometry,
  '2026-05-04' AS source_version, 'CC-BY-4.0' AS license, c_mktsegment AS raw_country FROM customer""")
def frontier_load(spark, sf_dir):
    return shown_frontier(frontier_batch(spark, sf_dir))


def frontier_batch(spark, sf_dir):
    k = F.col("c_custkey")
    source = located_customers(spark, sf_dir).select(
        "geometry", F.concat(F.lit(" "), "c_name").alias("Name"), F.lit("  ").alias("Owner"), F.col("c_mktsegment").alias("Country"),
        F.when(k % 5 != 0, F.col("c_acctbal").cast("string")).otherwise("n/a").alias("Current power (MW)"),
        k.cast("double").alias("Current H100 equivalents"), F.lit(None).cast("string").alias("citation"),
    )
    return frontier_rows(through_geojson(source, FRONTIER_PROPERTIES), "2026-05-04", F.lit(RUN_AT))


def shown_frontier(rows):
    return rows.select(
        "source_id", "source", "name", "owner", "country", "status", "power_capacity_mw", "h100_equivalent", "has_geometry",
        F.col("source_version").cast("string").alias("source_version"), "license", F.variant_get("raw_attributes", "$.Country", "string").alias("raw_country"),
    )


@query("""SELECT substr(sha256(c_name || '||' || c_mktsegment || '|' || c_custkey::DOUBLE::VARCHAR || '|' || CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal::VARCHAR ELSE '' END || '|' || c_custkey), 1, 16) AS source_id,
  c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'operational' WHEN 1 THEN 'planned' ELSE 'unknown' END AS status, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS power_capacity_mw,
  c_custkey::DOUBLE AS h100_equivalent, 1e18::DOUBLE AS ops_total, c_custkey % 9 <> 0 AS has_geometry FROM customer""")
def clusters_load(spark, sf_dir):
    return shown_clusters(cluster_batch(spark, sf_dir))


def cluster_batch(spark, sf_dir):
    k = F.col("c_custkey")
    source = located_customers(spark, sf_dir).select(
        "geometry", k.alias("position"), F.col("c_name").alias("Name"), F.lit(None).cast("string").alias("Owner"), F.col("c_mktsegment").alias("Country"),
        F.when(k % 3 == 0, "Existing").when(k % 3 == 1, " In planning").otherwise("?").alias("Status"), F.lit("Confirmed").alias("Certainty"),
        F.when(k % 5 != 0, F.col("c_acctbal")).alias("Power Capacity (MW)"), k.cast("double").alias("H100 equivalents"), F.lit("1e18").alias("Max OP/s"),
        F.lit(None).cast("string").alias("citation"),
    )
    features = through_geojson(source, ["position", *CLUSTER_PROPERTIES], index_property="position")
    return cluster_rows(features, "2026-05-04", F.lit(RUN_AT))


def shown_clusters(rows):
    return rows.select("source_id", "name", "status", "power_capacity_mw", "h100_equivalent", "ops_total", "has_geometry")


@query("""SELECT CASE WHEN p_partkey % 4 = 0 THEN 'way/' || p_partkey ELSE 'w' || p_partkey END AS source_id, p_name AS name, CASE WHEN later THEN p_brand ELSE p_type END AS operator,
  CASE WHEN later THEN '2026-05-01' ELSE '2026-04-01' END AS source_version, 'ODbL' AS license
FROM (SELECT *, p_partkey % 10 >= 5 AS later FROM part) WHERE p_partkey % 4 <> 3 AND p_partkey % 9 <> 0""")
def osm_load(spark, sf_dir):
    """Two snapshots of one table: the second overwrites the rows it has, version included."""
    first, second = (rows for rows, _ in osm_batches(spark, sf_dir))
    merged = upsert_table("osm", first.drop("row_idx"), second)
    return merged.select("source_id", "name", "operator", F.col("source_version").cast("string").alias("source_version"), "license")


def osm_batches(spark, sf_dir):
    def snapshot(parts, operator, day):
        k = F.col("p_partkey")
        x, y = t.place("p_partkey")
        source = parts.select(
            F.when(k % 9 != 0, F.struct(x.alias("x"), y.alias("y"))).alias("geometry"), F.col("p_name").alias("name"), F.col(operator).alias("operator"),
            F.when(k % 4 != 3, F.concat(F.lit("w"), k)).alias("full_id"), F.when(k % 4 == 0, "way").alias("osm_type"), F.when(k % 4 == 0, k.cast("string")).alias("osm_id"),
        )
        return osm_rows(through_geojson(source, OSM_PROPERTIES), day, F.lit(RUN_AT))

    parts = t.table(spark, sf_dir, "part")
    return snapshot(parts, "p_type", "2026-04-01"), snapshot(parts.where("p_partkey % 10 >= 5"), "p_brand", "2026-05-01")


@query("""SELECT sha256('["US","2","' || n_name || '"]') AS region_id, n_nationkey / 4::DOUBLE AS value,
  CASE n_nationkey % 3 WHEN 0 THEN 'high_feasibility' WHEN 1 THEN 'critical_constraint' ELSE 'dc_hotspot' END AS category, n_nationkey % 3 = 2 AS is_dc_hotspot,
  n AS q_projects, total AS q_total_mw, 1 AS sub_critical, 1 AS updated_month FROM nation JOIN (SELECT c_nationkey, count(*)::INTEGER AS n, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS total FROM customer GROUP BY 1) ON c_nationkey = n_nationkey""")
def feasibility_load(spark, sf_dir):
    """Region shapes upserted and index values appended from one set of features."""
    return shown_feasibility(*load_feasibility(feasibility_batch(spark, sf_dir), stored_regions(spark, sf_dir), "v1.0", RUN_AT))


def feasibility_batch(spark, sf_dir):
    n = F.col("n_nationkey")
    sums = t.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("q_projects"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("q_total_mw")
    )
    shapes = t.nation_areas(spark, sf_dir).select((F.col("id") - 2000).alias("n_nationkey"), F.col("name").alias("county_name"), F.col("name").alias("fips"), "geometry")
    known = {
        "feasibility_ratio": n / F.lit(4.0),
        "feasibility_category": F.when(n % 3 == 0, "high").when(n % 3 == 1, "critical").otherwise("dc_hotspot"),
        "is_dc_hotspot": n % 3 == 2,
        "sub_critical": F.lit(1.9),
    }
    rows = shapes.join(sums, "n_nationkey")
    rows = rows.withColumns(known).withColumns({p: F.lit(0.0) for p in FEASIBILITY_PROPERTIES if p not in rows.columns and p not in known})
    return feasibility_features(through_geojson(rows, FEASIBILITY_PROPERTIES, "multipolygon"))


def shown_feasibility(regions, values):
    updated = regions.select(F.col("id").alias("region_id"), F.month("created_at").alias("updated_month"))
    return values.join(updated, "region_id").select(
        "region_id", "value", "category", "components.is_dc_hotspot", "components.queue.q_projects", "components.queue.q_total_mw", "components.substations.sub_critical", "updated_month"
    )


@query(ORACLES["frontier_load"])
def stored_frontier(spark, sf_dir):
    """Read, checked, upserted, committed and read back, twice: the second run changes nothing."""
    store = Store(spark, fresh_path(spark, "store"))
    for _ in range(2):
        store_rows("frontier", store, frontier_batch(spark, sf_dir), buckets=8)
    return shown_frontier(store.read("frontier"))


@query(ORACLES["clusters_load"])
def stored_clusters(spark, sf_dir):
    """As `stored_frontier`, with every row twice in the batch."""
    store, rows = Store(spark, fresh_path(spark, "store")), cluster_batch(spark, sf_dir)
    for batch in (rows, rows.unionByName(rows)):
        store_rows("clusters", store, batch, buckets=8)
    return shown_clusters(store.read("clusters"))


@query(ORACLES["osm_load"])
def stored_osm(spark, sf_dir):
    store = Store(spark, fresh_path(spark, "store"))
    for rows, rejected in osm_batches(spark, sf_dir):
        store_rows("osm", store, rows, rejected, buckets=8)
    return store.read("osm").select("source_id", "name", "operator", F.col("source_version").cast("string").alias("source_version"), "license")


@query(ORACLES["feasibility_load"])
def stored_feasibility(spark, sf_dir):
    """Regions, history and current values in one commit, under a version that looks like a number."""
    store = Store(spark, fresh_path(spark, "store"))
    store.commit(store_regions(store, region_batch(spark, sf_dir), F.lit(STORED_AT), buckets=8))
    versions = spark.createDataFrame([("1.0",)], "version string")
    store_feasibility(feasibility_batch(spark, sf_dir), store, versions, "1.0", RUN_AT, buckets=8)
    values = store.read_between("grid_feasibility", "computed_at", RUN_AT, RUN_AT).where("methodology_version = '1.0'")
    return shown_feasibility(store.read("regions"), values)


@query("""SELECT source_id, CASE WHEN late THEN 'late' ELSE 'first' END AS name, v AS source_version, CASE WHEN late THEN 2 ELSE 1 END AS written_by FROM (
  SELECT 'c' || c_custkey AS source_id, CASE WHEN c_custkey % 2 = 0 THEN '2026-01-01' ELSE '2026-02-01' END AS v, c_custkey % 100 = 3 AS late FROM customer)""")
def touched_parts(spark, sf_dir):
    """One customer in a hundred changes: the parts of the other version, and all buckets without a change, stay as the
    first load wrote them."""
    k = F.col("c_custkey")
    rows = t.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), k).alias("source_id"), F.when(k % 2 == 0, "2026-01-01").otherwise("2026-02-01").alias("source_version"), F.lit("first").alias("name"), F.lit(1).alias("written_by"), k.alias("row_idx")
    )
    store, rule = Store(spark, fresh_path(spark, "store")), {"keys": ["source_id", "source_version"], "replace": ["name", "written_by"], "by": ["source_version"], "buckets": 16}
    store.commit(store.upsert("sites", rows, **rule))
    late = rows.where("row_idx % 100 = 3").withColumns({"name": F.lit("late"), "written_by": F.lit(2)})
    store.commit(store.upsert("sites", late, **rule))
    return store.read("sites")


@query("""SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS n FROM events) WHERE n = 1""")
def maintained_current(spark, sf_dir):
    """The latest event per user and type, kept up to date run by run while the runs arrive out of order."""
    events = t.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    store, run = Store(spark, fresh_path(spark, "store")), F.pmod(F.dayofyear("ts"), F.lit(3))
    for k in (2, 0, 1):
        batch = events.where(run == k)
        store.commit(store.append("history", batch, "ts"), store.latest("current", batch, ["user_id", "event_type"], "ts", buckets=8))
    return store.read("current")


@query("""SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-06 00:00:00'""")
def appended_history(spark, sf_dir):
    """A history of several appends; a span of time opens only the appends that meet it."""
    events = t.table(spark, sf_dir, "events").select("event_id", "ts", "value")
    store, early = Store(spark, fresh_path(spark, "store")), F.col("ts") < F.lit(datetime(2024, 1, 10, tzinfo=timezone.utc))
    for batch in (events.where(~early), events.where(early)):
        store.commit(store.append("history", batch, "ts"))
    return store.read_between("history", "ts", datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 6, tzinfo=timezone.utc))


@query("""SELECT CASE c_custkey % 10 WHEN 3 THEN 'no JSON' WHEN 7 THEN 'not a Feature' ELSE 'read' END AS outcome, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY 1""")
def rejected_lines(spark, sf_dir):
    """Lines that are no features come back with a reason; the others are read."""
    k = F.col("c_custkey")
    rows = t.customer_points(spark, sf_dir).select(k, feature_json("point", ["c_custkey"]).alias("line"))
    broken = F.when(k % 10 == 3, F.concat(F.substring("line", 1, 20), k)).when(k % 10 == 7, F.concat(F.lit('{"type": "Nothing", "k": '), k, F.lit("}"))).otherwise(F.col("line"))
    path = fresh_path(spark, "lines")
    rows.select(broken.alias("value")).write.text(path)
    good, bad = read_feature_lines(spark, path, "c_custkey", rejects=True)
    told = good.select(F.lit("read").alias("outcome"), F.col("row_idx").alias("k")).unionByName(bad.select(F.col("reason").alias("outcome"), F.regexp_extract("line", r"(\d+)\}?$", 1).cast("bigint").alias("k")))
    return told.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))


def web(x, y):
    """Coordinates in metres of the web projection."""
    return F.struct((x * (20037508.342789244 / 180)).alias("x"), (F.log(F.tan((y + 90) * math.pi / 360)) * 6378137.0).alias("y"))


WEB_CRS = '"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, '


@query("""SELECT c_custkey, c_custkey % 64 AS document, round(-80 + ((c_custkey * 37) % 81) / 4::DOUBLE, 6) AS x, round(30 + ((c_custkey * 53) % 79) / 4::DOUBLE, 6) AS y FROM customer""")
def mixed_coordinate_systems(spark, sf_dir):
    """Documents of customers, every other one in web coordinates and naming them; each keeps its own system. A document
    is written line by line, by as many tasks as there are rows for, and read by as many."""
    x, y = t.place("c_custkey")
    in_web = F.col("c_custkey") % 2 == 1
    place = F.when(in_web, web(x, y)).otherwise(F.struct(x.alias("x"), y.alias("y")))
    rows = t.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 64).alias("document"), "c_custkey", place.alias("geometry"))
    path = write_documents(spark, rows, ["c_custkey", "document"], F.when(F.col("document") % 2 == 1, WEB_CRS).otherwise(""))
    features = read_split_features(spark, path)
    named = parse_properties(features.withColumn("g", placed(features, "point", None)), ["c_custkey", "document"])
    return named.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("document").cast("long").alias("document"), F.round("g.x", 6).alias("x"), F.round("g.y", 6).alias("y"))


def write_documents(spark, rows, properties, crs):
    """One FeatureCollection per value of `document`, each written by one task, line by line, in the order of the first
    property; the number of documents decides how large one gets."""
    first = F.struct(F.lit(0).alias("part"), F.lit(None).cast("long").alias("at"))
    k = F.col(properties[0]).cast("long")
    lines = rows.select("document", F.struct(F.lit(1).alias("part"), k.alias("at")).alias("o"), F.concat(F.lit(","), feature_json("point", properties)).alias("value"))
    heads = rows.select("document").distinct().select("document", crs.alias("crs"))
    frame = heads.select(
        "document",
        F.inline(F.array(
            F.struct(first.alias("o"), F.concat(F.lit('{"type": "FeatureCollection", '), "crs", F.lit('"features": [')).alias("value")),
            F.struct(F.struct(F.lit(2).alias("part"), F.lit(None).cast("long").alias("at")).alias("o"), F.lit("]}").alias("value")),
        )),
    )
    least = lines.groupBy("document").agg(F.min("o").alias("least"))
    bare = lines.join(least, "document").select("document", "o", F.when(F.col("o") == F.col("least"), F.substr("value", F.lit(2))).otherwise(F.col("value")).alias("value"))
    path = fresh_path(spark, "documents")
    whole = bare.unionByName(frame).repartition("document").sortWithinPartitions("document", "o")
    whole.select("document", "value").write.partitionBy("document").text(path)
    return path


# Braces, quotes, backslashes and the key of the features' array inside a text.
TRICKY = '}{"features": [{"\\}\\"]}'


@query("""SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_idx, c_custkey, c_name || chr(10) || '}{"features": [{"\\}\\"]}' || repeat('"', (c_custkey % 3)::INTEGER) AS name,
  -80 + ((c_custkey * 37) % 81) / 4::DOUBLE AS x, 30 + ((c_custkey * 53) % 79) / 4::DOUBLE AS y, 4326 AS epsg FROM customer""")
def split_document(spark, sf_dir):
    """One document with a feature per customer, read by many tasks: every feature whole and at its place."""
    k = F.col("c_custkey")
    names = F.concat("c_name", F.lit("\n"), F.lit(TRICKY), F.repeat(F.lit('"'), (k % 3).cast("int")))
    rows = t.customer_points(spark, sf_dir).select(F.lit(0).alias("document"), k, names.alias("name"), "geometry")
    path = write_documents(spark, rows, ["c_custkey", "name"], F.lit('"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}, '))
    # So that the document is cut at any size; at full size Spark's own splits do.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
        features = read_split_features(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    named = parse_properties(features, ["c_custkey", "name"]).withColumn("g", decode_geometry("geometry", "point"))
    return named.select("row_idx", F.col("c_custkey").cast("long").alias("c_custkey"), "name", "g.x", "g.y", "epsg")


@query("""SELECT p_partkey % 50 AS k, arg_max(p_partkey, i) AS p_partkey, max(i) AS row_idx
FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey % 3, p_partkey) - 1 AS i FROM part) GROUP BY 1""")
def last_over_files(spark, sf_dir):
    """Lines in three folders of files of unequal size: the last line of a key wins, in the order of the paths."""
    k = F.col("p_partkey")
    path = fresh_path(spark, "ordered")
    rows = t.table(spark, sf_dir, "part").withColumn("geometry", F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))
    # The first folder's lines are the longest, so its splits are the largest and are read first.
    lines = rows.select((k % 3).alias("folder"), k, feature_json("point", ["p_partkey"]).alias("line"))
    padded = lines.select("folder", "p_partkey", F.concat("line", F.repeat(F.lit(" "), F.when(F.col("folder") == 0, 300).otherwise(0))).alias("value"))
    padded.repartition("folder").sortWithinPartitions("folder", "p_partkey").select("folder", "value").write.partitionBy("folder").text(path)
    features = parse_properties(read_feature_lines(spark, path), ["p_partkey"]).select("row_idx", F.col("p_partkey").cast("long").alias("p_partkey"))
    return last_wins(features.withColumn("k", F.col("p_partkey") % 50), ["k"], "row_idx").select("k", "p_partkey", "row_idx")


@query("""SELECT CASE WHEN p_partkey % 4 = 0 THEN 'way/' || p_partkey ELSE 'w' || p_partkey END AS source_id, round(-80 + ((p_partkey * 37) % 81) / 4::DOUBLE, 6) AS x,
  round(30 + ((p_partkey * 53) % 79) / 4::DOUBLE, 6) AS y FROM part WHERE p_partkey % 4 <> 3""")
def web_load(spark, sf_dir):
    """A load of documents that name the web projection: places are stored in degrees."""
    k = F.col("p_partkey")
    x, y = t.place("p_partkey")
    rows = t.table(spark, sf_dir, "part").select(
        (k % 4).alias("document"), web(x, y).alias("geometry"), k.alias("position"), F.col("p_name").alias("name"), F.when(k % 4 != 3, F.concat(F.lit("w"), k)).alias("full_id"),
        F.when(k % 4 == 0, "way").alias("osm_type"), F.when(k % 4 == 0, k.cast("string")).alias("osm_id"),
    )
    path = write_documents(spark, rows, ["position", "name", "full_id", "osm_type", "osm_id"], F.lit(WEB_CRS))
    loaded, _ = osm_rows(read_split_features(spark, path), "2026-05-01", F.lit(RUN_AT))
    return loaded.select("source_id", F.round("geometry.x", 6).alias("x"), F.round("geometry.y", 6).alias("y"))
