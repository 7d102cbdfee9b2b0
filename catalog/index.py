"""The feasibility index over the given tables.

Stand-ins: customers are plants (account balance as megawatts), orders are queue projects (total price as
megawatts, priority as fuel), suppliers are demand and substations.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.spatial import BEST, DIAMONDS, POINTS, RECTANGLES
from gridloam.functions.formula import build_components, canonical_category, flatten_components, pressure_label
from gridloam.functions.geometry import point
from gridloam.functions.vocabulary import COMPLETION_RATE
from gridloam.operators.history import current_snapshot, history
from gridloam.operators.region_index import build_region_index
from gridloam.operators.rollups import allocate_by_weight, category_summary, plant_capacity, queue_rollup, substation_counts
from gridloam.operators.skew import lookup_join
from gridloam.operators.spatial_join import assign_region
from gridloam.operators.tables import append_snapshot, register_methodology, snapshot_rows
from gridloam.plans.feasibility import accept_values, index_inputs, index_values, snapshots_of
from gridloam.plans.map_read import feasibility_layer, map_features

FUEL_OF_PRIORITY = {"1-URGENT": "solar", "2-HIGH": "battery", "3-MEDIUM": "wind", "4-NOT SPECIFIED": "gas"}
RUN_AT = datetime(2026, 5, 4, tzinfo=timezone.utc)

FUEL_SUMS = ", ".join(
    f"coalesce(sum(o_totalprice::DECIMAL(18,2)) FILTER (o_orderpriority = '{p}'), 0)::DOUBLE AS q_{f}_mw"
    for p, f in FUEL_OF_PRIORITY.items()
)


def _fuel():
    out = F.when(F.lit(False), "")
    for priority, fuel in FUEL_OF_PRIORITY.items():
        out = out.when(F.col("o_orderpriority") == priority, fuel)
    return out.otherwise("other")


def nation_queue(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", _fuel().alias("fuel_type"))
    owners = t.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("region_id"))
    return queue_rollup(lookup_join(orders, owners, ["c_custkey"], "inner"), mw="o_totalprice")


@query(f"""SELECT c_nationkey AS region_id, count(*)::INTEGER AS q_projects, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS q_total_mw, {FUEL_SUMS}
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""")
def queue_rollup_by_nation(spark, sf_dir):
    return nation_queue(spark, sf_dir)


def nation_substations(spark, sf_dir):
    b = F.col("s_acctbal")
    return substation_counts(t.table(spark, sf_dir, "supplier").withColumn("region_id", F.col("s_nationkey")), b >= 8000, (b >= 4000) & (b < 8000), b < 4000)


@query("""SELECT s_nationkey AS region_id, (count(*) FILTER (s_acctbal >= 8000))::INTEGER AS sub_critical,
  (count(*) FILTER (s_acctbal >= 4000 AND s_acctbal < 8000))::INTEGER AS sub_high, (count(*) FILTER (s_acctbal < 4000))::INTEGER AS sub_throughput
FROM supplier GROUP BY s_nationkey""")
def substation_counts_by_nation(spark, sf_dir):
    return nation_substations(spark, sf_dir)


@query("""SELECT n_nationkey, n_regionkey, total, weight, round(total * weight / sum(weight) OVER (PARTITION BY n_regionkey), 6) AS allocated
FROM (SELECT n_nationkey, n_regionkey, count(*) AS weight FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
JOIN (SELECT n_regionkey, sum(s_acctbal::DECIMAL(18,2))::DOUBLE AS total FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) USING (n_regionkey)""")
def allocated_totals(spark, sf_dir):
    """Each region's supplier balance split over its nations by number of customers."""
    nations = t.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    by_nation = t.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("weight"))
    balances = t.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("b"))
    totals = balances.join(nations, "n_nationkey").groupBy("n_regionkey").agg(F.sum("b").cast("double").alias("total"))
    weighted = by_nation.join(nations, "n_nationkey").join(totals, "n_regionkey")
    return allocate_by_weight(weighted, "n_regionkey", "total", "weight").select(
        "n_nationkey", "n_regionkey", "total", "weight", F.round("allocated", 6).alias("allocated")
    )


@query("""SELECT c_custkey, c_nationkey, round(1000.0::DOUBLE * c_acctbal / sum(c_acctbal) OVER (PARTITION BY c_nationkey), 6) AS allocated FROM customer""")
def allocated_shares(spark, sf_dir):
    """A total of 1000 per nation split over its customers by balance: groups grow with the data."""
    rows = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", F.lit(1000.0).alias("total"))
    return allocate_by_weight(rows, "c_nationkey", "total", "c_acctbal").select("c_custkey", "c_nationkey", F.round("allocated", 6).alias("allocated"))


# Nations with a hotspot flag, and per region a completion rate and, for one, a further discount.
HOTSPOT_NATIONS = [7, 12]

NATION_VALUES = """
q AS (SELECT c_nationkey AS region_id, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS q_total_mw FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
c AS (SELECT c_nationkey AS region_id, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS installed_mw FROM customer GROUP BY 1),
m AS (SELECT s_nationkey AS region_id, sum(s_acctbal::DECIMAL(18,2))::DOUBLE AS peak_demand_mw, (count(*) FILTER (s_acctbal >= 8000))::INTEGER AS sub_critical FROM supplier GROUP BY 1),
i AS (SELECT n_nationkey AS region_id, coalesce(installed_mw, 0) AS installed_mw, coalesce(peak_demand_mw, 0) AS peak_demand_mw, coalesce(q_total_mw, 0) AS q_total_mw,
        coalesce(sub_critical, 0) AS sub_critical, n_nationkey IN (7, 12) AS is_dc_hotspot,
        CASE n_regionkey % 3 WHEN 0 THEN 0.197::DOUBLE WHEN 1 THEN 0.40::DOUBLE ELSE 0.55::DOUBLE END AS rate, CASE n_regionkey WHEN 4 THEN 0.0014::DOUBLE ELSE 0.002::DOUBLE END AS discount
      FROM nation JOIN c ON n_nationkey = c.region_id LEFT JOIN q ON n_nationkey = q.region_id LEFT JOIN m ON n_nationkey = m.region_id),
v AS (SELECT region_id, installed_mw - peak_demand_mw AS headroom_mw, peak_demand_mw, installed_mw - peak_demand_mw + sub_critical * 10.0::DOUBLE AS available_mw,
        q_total_mw * (1.0::DOUBLE - rate) * discount AS q_realistic_mw, is_dc_hotspot FROM i),
w AS (SELECT *, CASE WHEN q_realistic_mw <> 0 THEN available_mw / q_realistic_mw END AS value FROM v),
f AS (SELECT *, CASE WHEN value >= 2 THEN 'high_feasibility' WHEN value >= 1 THEN 'moderate_feasibility' WHEN value >= 0.5 THEN 'low_feasibility' WHEN value IS NOT NULL THEN 'critical_constraint' END AS ratio_category FROM w),
nv AS (SELECT *, CASE WHEN is_dc_hotspot THEN 'dc_hotspot' ELSE ratio_category END AS category FROM f)"""


def nation_values(spark, sf_dir):
    capacity = plant_capacity(t.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("region_id"), F.col("c_acctbal").alias("capacity_mw")))
    suppliers = t.table(spark, sf_dir, "supplier").withColumn("region_id", F.col("s_nationkey"))
    demand = suppliers.groupBy("region_id").agg(F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("peak_demand_mw"))
    r = F.col("n_regionkey")
    rates = t.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("region_id"),
        F.when(r % 3 == 0, COMPLETION_RATE["PJM"]).when(r % 3 == 1, COMPLETION_RATE["Norway"]).otherwise(COMPLETION_RATE["Gulf"]).alias("rate"),
        F.when(r == 4, 0.0014).otherwise(0.002).alias("discount"),
    )
    inputs = index_inputs(capacity, nation_queue(spark, sf_dir), demand, nation_substations(spark, sf_dir)).join(rates, "region_id")
    return index_values(
        inputs,
        completion_rate=F.col("rate"),
        discount=F.col("discount"),
        substation_bonus=F.col("sub_critical") * F.lit(10.0),
        is_hotspot=F.col("region_id").isin(HOTSPOT_NATIONS),
    )


@query(f"""WITH {NATION_VALUES} SELECT region_id, headroom_mw, available_mw, round(q_realistic_mw, 6) AS q_realistic_mw, round(value, 9) AS value, ratio_category, category,
  CASE category WHEN 'high_feasibility' THEN 'low pressure' WHEN 'moderate_feasibility' THEN 'moderate pressure' WHEN 'low_feasibility' THEN 'high pressure'
    WHEN 'critical_constraint' THEN 'severe pressure' ELSE 'existing concentration' END AS pressure FROM nv""")
def feasibility(spark, sf_dir):
    return nation_values(spark, sf_dir).select(
        "region_id", "headroom_mw", "available_mw", F.round("q_realistic_mw", 6).alias("q_realistic_mw"), F.round("value", 9).alias("value"),
        "ratio_category", "category", pressure_label("category").alias("pressure"),
    )


@query(f"WITH {NATION_VALUES} SELECT category, count(*) AS n FROM nv GROUP BY category")
def category_counts(spark, sf_dir):
    return category_summary(nation_values(spark, sf_dir))


def nation_regions(spark, sf_dir):
    """Nations as regions; every sixth has no shape."""
    n = t.nation_areas(spark, sf_dir)
    key = F.col("id") - 2000
    return n.select(key.alias("id"), "name", F.concat(F.lit("N"), key).alias("admin_code"), F.when(key % 6 != 5, F.col("geometry")).alias("geometry"))


@query(f"""WITH {NATION_VALUES} SELECT region_id, n_name AS name, 'N' || region_id AS admin_code, round(value, 9) AS value, category, headroom_mw, peak_demand_mw,
  round(q_realistic_mw, 6) AS q_realistic_mw, 5 AS vertices FROM nv JOIN nation ON region_id = n_nationkey WHERE region_id % 6 <> 5 AND value IS NOT NULL""")
def map_features_by_nation(spark, sf_dir):
    accepted, _ = accept_values(nation_values(spark, sf_dir))
    shown = map_features(snapshots_of(accepted, "v1.0", RUN_AT), nation_regions(spark, sf_dir), "v1.0")
    return shown.select(
        "region_id", "name", "admin_code", F.round("value", 9).alias("value"), "category", "headroom_mw", "peak_demand_mw",
        F.round("q_realistic_mw", 6).alias("q_realistic_mw"), F.size(F.get(F.get("geometry", F.lit(0)), F.lit(0))).alias("vertices"),
    )


SUPPLIER_POINTS = """
sp AS (SELECT s_suppkey AS k, -80 + ((s_suppkey * 37) % 81) / 4::DOUBLE AS x, 30 + ((s_suppkey * 53) % 79) / 4::DOUBLE AS y, s_acctbal FROM supplier),
shits AS (SELECT k, s_acctbal, d.id, 2 AS lvl FROM sp JOIN d ON abs(x - cx) + abs(y - cy) < 2
          UNION ALL SELECT k, s_acctbal, r.id, 1 FROM sp JOIN r ON x > x1 AND x < x2 AND y > y1 AND y < y2),
sbest AS (SELECT k, id, s_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lvl DESC, id) AS n FROM shits) WHERE n = 1)"""


@query(f"""WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {BEST}, {SUPPLIER_POINTS},
cap AS (SELECT id, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS installed FROM best JOIN p ON best.k = p.k GROUP BY id),
que AS (SELECT id, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders JOIN best ON o_custkey = best.k GROUP BY id),
dem AS (SELECT id, sum(s_acctbal::DECIMAL(18,2))::DOUBLE AS demand FROM sbest GROUP BY id),
val AS (SELECT id, coalesce(installed, 0) - coalesce(demand, 0) AS headroom_mw, coalesce(demand, 0) AS peak_demand_mw, total * (1.0::DOUBLE - 0.197::DOUBLE) * 0.002::DOUBLE AS q_realistic_mw
        FROM que FULL JOIN cap USING (id) LEFT JOIN dem USING (id) WHERE total > 0),
rat AS (SELECT *, headroom_mw / q_realistic_mw AS value FROM val),
names AS (SELECT id, name FROM d UNION ALL SELECT id, name FROM r)
SELECT id::BIGINT AS region_id, name, id::VARCHAR AS admin_code, round(value, 9) AS value,
  CASE WHEN id IN (2007, 2012) THEN 'dc_hotspot' WHEN value >= 2 THEN 'high_feasibility' WHEN value >= 1 THEN 'moderate_feasibility' WHEN value >= 0.5 THEN 'low_feasibility' ELSE 'critical_constraint' END AS category,
  headroom_mw, peak_demand_mw, round(q_realistic_mw, 6) AS q_realistic_mw FROM rat JOIN names USING (id)""")
def region_feasibility(spark, sf_dir):
    """Flagship: locate plants, projects and demand, roll them up per region, work out the index, take the
    latest snapshot and join it to the region shapes."""
    areas = t.areas(spark, sf_dir).withColumn("admin_code", F.col("id").cast("string")).withColumn("id", F.col("id").cast("bigint"))
    index = build_region_index(areas)
    plants = assign_region(t.customer_points(spark, sf_dir).select("c_custkey", F.col("c_acctbal").alias("capacity_mw"), "geometry"), index)
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", _fuel().alias("fuel_type"))
    projects = lookup_join(orders, plants.where("region_id IS NOT NULL").select("c_custkey", "region_id"), ["c_custkey"], "inner")
    x, y = t.place("s_suppkey")
    suppliers = assign_region(t.table(spark, sf_dir, "supplier").select("s_acctbal", point(x, y).alias("geometry")), index)
    demand = suppliers.groupBy("region_id").agg(F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("peak_demand_mw"))
    inputs = index_inputs(plant_capacity(plants), queue_rollup(projects, mw="o_totalprice"), demand)
    values = index_values(
        inputs,
        completion_rate=F.lit(COMPLETION_RATE["PJM"]),
        discount=F.lit(0.002),
        is_hotspot=F.col("region_id").isin(2007, 2012),
    )
    accepted, _ = accept_values(values)
    shown = feasibility_layer(snapshots_of(accepted, "v1.0", RUN_AT), areas, "v1.0")
    return shown.select(
        "region_id", "name", "admin_code", F.round("value", 9).alias("value"), "category", "headroom_mw", "peak_demand_mw",
        F.round("q_realistic_mw", 6).alias("q_realistic_mw"),
    )


@query("""SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS n FROM events) WHERE n = 1""")
def latest_events(spark, sf_dir):
    """Events as snapshots of (user, type)."""
    events = t.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return current_snapshot(events, ("user_id", "event_type"), "ts")


@query("""SELECT event_id, user_id, event_type, value FROM events
WHERE user_id = 8 AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def event_history(spark, sf_dir):
    """Snapshots of one key in a time range, newest first."""
    found = history(t.table(spark, sf_dir, "events"), 8, datetime(2024, 1, 5), datetime(2024, 1, 20), "user_id", "ts")
    return found.select("event_id", "user_id", "event_type", "value")


def yearly_snapshots(spark, sf_dir, year: int):
    orders = t.table(spark, sf_dir, "orders").where(F.year("o_orderdate") <= year)
    values = orders.groupBy(F.col("o_custkey").alias("region_id")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return snapshot_rows(values, "v1.0", datetime(year, 12, 31))


@query("""SELECT o_custkey AS region_id, 'v1.0' AS methodology_version, y AS year, count(*)::DOUBLE AS value
FROM orders, (SELECT unnest([1997, 1998]) AS y) WHERE year(o_orderdate) <= y GROUP BY 1, 3""")
def appended_snapshots(spark, sf_dir):
    """A second run appended to a first one, after the checks on keys and on the methodology version."""
    versions = register_methodology(
        spark.createDataFrame([], "version string, description string, published_at timestamp, methodology_url string"),
        "v1.0", "first version", RUN_AT,
    )
    first = yearly_snapshots(spark, sf_dir, 1997)
    second = append_snapshot(first, yearly_snapshots(spark, sf_dir, 1998), versions)
    both = first.unionByName(second)
    return both.select("region_id", "methodology_version", F.year("computed_at").alias("year"), "value")


@query("""SELECT c_nationkey AS region_id, count(*)::INTEGER AS q_projects, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS headroom_mw, 0.0::DOUBLE AS peak_demand_mw,
  CASE WHEN c_nationkey % 2 = 0 THEN max(c_acctbal) ELSE 0 END AS q_realistic_mw, c_nationkey IN (7, 12) AS is_dc_hotspot,
  CASE c_nationkey % 3 WHEN 0 THEN 'high_feasibility' WHEN 1 THEN 'dc_hotspot' ELSE 'low_feasibility' END AS category FROM customer GROUP BY c_nationkey""")
def nested_components(spark, sf_dir):
    """Flat measures nested and read back; missing ones read as zero and short category names as long ones."""
    k = F.col("c_nationkey")
    flat = t.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("q_projects"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("headroom_mw"),
        F.when(k % 2 == 0, F.max("c_acctbal")).alias("q_realistic_mw"),
    ).withColumn("is_dc_hotspot", k.isin(HOTSPOT_NATIONS))
    short = F.when(k % 3 == 0, "high").when(k % 3 == 1, "dc_hotspot").otherwise("low_feasibility")
    nested = flat.select(
        k.alias("region_id"),
        build_components(lambda n: F.col(n) if n in flat.columns else F.lit(None)).alias("components"),
        canonical_category(short).alias("category"),
    )
    return nested.select("region_id", "components.queue.q_projects", *flatten_components(), "components.is_dc_hotspot", "category")
