"""Layers, labels and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.cleaning import STATUS_CASE, raw_status
from catalog.registry import query
from gridloam.functions import display
from gridloam.functions.text import normalize_status
from gridloam.operators.filters import only_spatial, select_layers, status_filter, with_has_geometry
from gridloam.operators.rollups import geometry_coverage
from gridloam.plans.map_read import as_features, datacenter_layer
from gridloam.sources.stored import on_optional_missing


def facilities(spark, sf_dir):
    """Events as facilities: placed by user, status from their type; every ninth has no location."""
    x, y = t.place("user_id")
    k = F.col("event_id")
    rows = t.table(spark, sf_dir, "events").select(
        k.cast("string").alias("id"), F.concat(F.lit("site "), k).alias("name"), F.lit(None).cast("string").alias("owner"),
        F.col("event_type").alias("country"), normalize_status(raw_status()).alias("status"), F.lit("Likely").alias("certainty"),
        F.col("value").alias("power_capacity_mw"), (F.col("value") * 10).alias("h100_equivalent"), F.lit(None).cast("double").alias("ops_total"),
        F.lit(None).cast("string").alias("geocoding_precision"), F.lit(None).cast("string").alias("citation"),
        F.when(k % 9 != 0, F.struct(x.alias("x"), y.alias("y"))).alias("geometry"),
    )
    return with_has_geometry(rows)


FACILITIES = f"f AS (SELECT event_id::VARCHAR AS id, event_id % 9 <> 0 AS has_geometry, {STATUS_CASE} AS status, value, event_id FROM events)"


@query(f"WITH {FACILITIES} SELECT id, status FROM f WHERE has_geometry AND status IN ('operational', 'under_construction', 'unknown', 'decommissioned')")
def status_filtered(spark, sf_dir):
    located = only_spatial(facilities(spark, sf_dir))
    return status_filter(located, planned=False, decommissioned=True).select("id", "status")


@query(f"""WITH {FACILITIES}
SELECT 'frontier' AS layer, id, status FROM f WHERE status NOT IN ('planned', 'announced')
UNION ALL SELECT 'clusters', id, status FROM f WHERE has_geometry AND status <> 'decommissioned'
UNION ALL SELECT 'osm', p_partkey::VARCHAR, NULL FROM part""")
def selected_layers(spark, sf_dir):
    """Three layers chosen, each with its own status switches; a fourth is off and a fifth cannot be read."""
    frontier = facilities(spark, sf_dir).select("id", "status")
    layers = {
        "frontier": frontier,
        "clusters": only_spatial(facilities(spark, sf_dir)).select("id", "status"),
        "osm": t.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id")),
        "feasibility": frontier,
        "extra": on_optional_missing(spark, lambda: t.table(spark, sf_dir, "no_such_layer"), "id string, status string"),
    }
    chosen = select_layers(layers, ["frontier", "clusters", "osm", "extra"], planned={"frontier": False}, decommissioned={"frontier": True})
    return chosen.select("layer", "id", "status")


@query(f"""WITH {FACILITIES} SELECT 'clusters' AS layer, has_geometry, count(*) AS n FROM f GROUP BY has_geometry
UNION ALL SELECT 'plants', c_custkey % 7 <> 0, count(*) FROM customer GROUP BY 2""")
def coverage_by_layer(spark, sf_dir):
    plants = t.customer_points(spark, sf_dir).select(F.when(F.col("c_custkey") % 7 != 0, F.col("geometry")).alias("geometry"))
    return geometry_coverage({"clusters": facilities(spark, sf_dir), "plants": with_has_geometry(plants)})


@query("""WITH e AS (SELECT *, -80 + ((user_id * 37) % 81) / 4::DOUBLE AS x, 30 + ((user_id * 53) % 79) / 4::DOUBLE AS y FROM events)
SELECT 'clusters' AS layer, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || x || ',' || y || ']},"properties":{"id":"' || event_id || '","name":"site ' || event_id
  || '","owner":null,"country":"' || event_type || '","status":"' || """ + STATUS_CASE + """ || '","certainty":"Likely","power_capacity_mw":' || value || ',"h100_equivalent":' || (value * 10)
  || ',"ops_total":null,"geocoding_precision":null,"citation":null}}' AS feature
FROM e WHERE event_id % 9 <> 0 AND event_type NOT IN ('purchase')""")
def cluster_features(spark, sf_dir):
    """A layer as GeoJSON Features, one per row; what is missing is written as null."""
    return as_features(datacenter_layer(facilities(spark, sf_dir), "clusters"), "clusters")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '—' ELSE printf('%.1f MW', mw) END AS mw, CASE WHEN c_custkey % 11 = 0 THEN '—' ELSE printf('%.2f', mw) END AS ratio,
  CASE WHEN c_custkey % 11 = 0 THEN '—' WHEN mw >= 1000 THEN printf('%.1f GW', mw / 1000) ELSE CASE WHEN mw = floor(mw) THEN mw::BIGINT::VARCHAR ELSE mw::VARCHAR END || ' MW' END AS power,
  CASE WHEN c_custkey % 11 = 0 THEN '—' ELSE format('{:,}', c_custkey * 1000) END AS counted,
  CASE WHEN c_custkey % 11 = 0 THEN '—' ELSE printf('%d.0 × 10', c_custkey % 9 + 1) || CASE c_custkey % 3 WHEN 0 THEN '¹⁸' WHEN 1 THEN '⁷' ELSE '²⁰' END END AS ops
FROM (SELECT c_custkey, (floor((c_acctbal::DECIMAL(18,2) * 100)::BIGINT / 10) * 10 + 3) / 100 AS mw FROM customer)""")
def number_formats(spark, sf_dir):
    """Numbers ending in 3 hundredths, which no format can tie on."""
    k = F.col("c_custkey")
    cents = (F.col("c_acctbal").cast("decimal(18,2)") * 100).cast("bigint")
    tens = F.floor(cents / 10) * 10
    mw = ((tens + 3).cast("double")) / 100
    given = k % 11 != 0
    ops = (k % 9 + 1) * F.when(k % 3 == 0, 1e18).when(k % 3 == 1, 1e7).otherwise(1e20)
    rows = t.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(given, mw).alias("mw"), F.when(given, k * 1000).alias("n"), F.when(given, ops).alias("ops")
    )
    return rows.select(
        "c_custkey", display.format_mw("mw").alias("mw"), display.format_ratio("mw").alias("ratio"), display.format_power("mw").alias("power"),
        display.format_count("n").alias("counted"), display.format_ops("ops").alias("ops"),
    )


@query("""SELECT event_id, CASE cat WHEN 'high_feasibility' THEN 'High' WHEN 'dc_hotspot' THEN 'DC Hotspot' ELSE 'odd' END AS short_label,
  CASE cat WHEN 'high_feasibility' THEN 'High — grid headroom exceeds queue pressure' WHEN 'dc_hotspot' THEN 'DC Hotspot — local substation exhaustion' ELSE 'odd' END AS label,
  CASE cat WHEN 'high_feasibility' THEN '#2ecc71' WHEN 'dc_hotspot' THEN '#922b21' ELSE '#cccccc' END AS colour,
  CASE status WHEN 'operational' THEN 'Operational' WHEN 'planned' THEN 'Planned' WHEN 'under_construction' THEN 'Under construction' WHEN 'decommissioned' THEN 'Decommissioned' ELSE 'Status unknown' END AS status_label,
  CASE status WHEN 'operational' THEN '#2563eb' WHEN 'planned' THEN '#8b5cf6' WHEN 'under_construction' THEN '#f59e0b' WHEN 'decommissioned' THEN '#6b7280' ELSE '#94a3b8' END AS status_colour,
  CASE event_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.6 WHEN 2 THEN 0.4 ELSE 0.85 END::DOUBLE AS weight,
  CASE WHEN user_id * 5 >= 500 THEN 20 WHEN user_id * 5 >= 100 THEN 16 ELSE 12 END AS osm_size, CASE WHEN user_id * 5 >= 200 THEN 24 WHEN user_id * 5 >= 50 THEN 18 ELSE 14 END AS cluster_size
FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'high_feasibility' WHEN 1 THEN 'dc_hotspot' ELSE 'odd' END AS cat, """ + STATUS_CASE + """ AS status FROM events)""")
def labels_and_colours(spark, sf_dir):
    k = F.col("event_id")
    category = F.when(k % 3 == 0, "high_feasibility").when(k % 3 == 1, "dc_hotspot").otherwise("odd")
    status = normalize_status(raw_status())
    precision = F.when(k % 4 == 0, "street_level").when(k % 4 == 1, "region").when(k % 4 == 2, "country_centroid")
    count = F.col("user_id") * 5
    return t.table(spark, sf_dir, "events").select(
        "event_id", display.category_short_label(category).alias("short_label"), display.category_label(category).alias("label"),
        display.category_colour(category).alias("colour"), display.status_label(status).alias("status_label"), display.status_colour(status).alias("status_colour"),
        display.precision_weight(precision).alias("weight"), display.bubble_size(count, "osm").alias("osm_size"), display.bubble_size(count, "clusters").alias("cluster_size"),
    )


@query("""SELECT o_orderkey, CASE WHEN n >= 10000 THEN floor((n + 500) / 1000)::BIGINT || 'k' WHEN n >= 1000 THEN replace(printf('%.1f', floor((n + 50) / 100) / 10), '.0', '') || 'k' ELSE n::VARCHAR END AS shown
FROM (SELECT o_orderkey, (o_orderkey * 37) % 25000 AS n FROM orders)""")
def bubble_counts(spark, sf_dir):
    k = F.col("o_orderkey")
    return t.table(spark, sf_dir, "orders").select("o_orderkey", display.abbreviated_count((k * 37) % 25000).alias("shown"))
