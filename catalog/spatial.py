"""Points, lines and regions. The SQL decides membership in closed form, never by ray casting."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import ORACLES, query
from gridloam.functions.geometry import EARTH_RADIUS_M, centroid, intersects, point, to_wgs84, within
from gridloam.operators.clustering import cluster_expansion_zoom, cluster_pyramid
from gridloam.operators.filters import line_region_bridge
from gridloam.operators.rollups import plant_capacity
from gridloam.operators.spatial_join import (
    assign_region,
    assign_regions_array,
    fill_region,
    line_region_pairs,
    lines_meeting,
    overlay_regions,
)
from gridloam.plans.stored_index import load_region_index, store_region_index, update_region_index
from gridloam.session import fresh_path
from gridloam.sources.parted import Store

POINTS = """
p AS (SELECT c_custkey AS k, -80 + ((c_custkey * 37) % 81) / 4::DOUBLE AS x, 30 + ((c_custkey * 53) % 79) / 4::DOUBLE AS y,
             c_acctbal, c_mktsegment, c_nationkey FROM customer)"""

DIAMONDS = """
d AS (SELECT 2000 + n_nationkey AS id, n_name AS name, -78 + 4 * (n_nationkey % 5) AS cx, 32 + 4 * (n_nationkey // 5) AS cy FROM nation)"""

RECTANGLES = """
r AS (SELECT 1000 + r_regionkey AS id, r_name AS name, -80 + 4 * r_regionkey AS x1, -76 + 4 * r_regionkey AS x2, 30 AS y1, 50 AS y2 FROM region)"""

SERVICE = """
s AS (SELECT s_suppkey AS id, px AS x1, py AS y1, px + (s_suppkey % 9 + 1) / 4::DOUBLE AS x2, py + (s_suppkey % 7 + 1) / 4::DOUBLE AS y2
      FROM (SELECT s_suppkey, -80 + ((s_suppkey * 37) % 81) / 4::DOUBLE AS px, 30 + ((s_suppkey * 53) % 79) / 4::DOUBLE AS py FROM supplier))"""

BEST = """
hits AS (SELECT k, d.id, 2 AS lvl FROM p JOIN d ON abs(x - cx) + abs(y - cy) < 2
         UNION ALL SELECT k, r.id, 1 FROM p JOIN r ON x > x1 AND x < x2 AND y > y1 AND y < y2),
best AS (SELECT k, id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lvl DESC, id) AS n FROM hits) WHERE n = 1)"""

# A segment meets a convex box when neither box axis nor the segment's normal separates them; every term is
# exact for these coordinates. A diamond is a box along x + y and x - y.
LINES = """
l AS (SELECT k, x AS ax, y AS ay, x + ((k * 7) % 33) / 4::DOUBLE - 4 AS ex, y + ((k * 17) % 31) / 4::DOUBLE - 4 AS ey FROM p),
boxed AS (
  SELECT k, id, ax + ay AS a1, ax - ay AS a2, ex + ey AS b1, ex - ey AS b2, cx + cy AS c1, cx - cy AS c2, 2 AS h1, 2 AS h2 FROM l, d
  UNION ALL
  SELECT k, id, ax, ay, ex, ey, (x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) / 2, (y2 - y1) / 2 FROM l, r),
met AS (SELECT k, id FROM boxed
        WHERE greatest(a1, b1) >= c1 - h1 AND least(a1, b1) <= c1 + h1
          AND greatest(a2, b2) >= c2 - h2 AND least(a2, b2) <= c2 + h2
          AND abs((b1 - a1) * (c2 - a2) - (b2 - a2) * (c1 - a1)) <= abs(b1 - a1) * h2 + abs(b2 - a2) * h1)"""


@query(f"WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {BEST} SELECT p.k AS c_custkey, best.id AS region_id FROM p LEFT JOIN best ON p.k = best.k")
def region_of_point(spark, sf_dir):
    points = t.customer_points(spark, sf_dir).select("c_custkey", "geometry")
    return assign_region(points, t.areas(spark, sf_dir)).select("c_custkey", F.col("region_id").cast("bigint").alias("region_id"))


@query(f"""WITH {POINTS}, {SERVICE}
SELECT p.k AS c_custkey, min(s.id) AS area_id FROM p LEFT JOIN s ON x > x1 AND x < x2 AND y > y1 AND y < y2 GROUP BY p.k""")
def area_of_point(spark, sf_dir):
    """Many overlapping areas of one level, as many as there are suppliers."""
    points = t.customer_points(spark, sf_dir).select("c_custkey", "geometry")
    return assign_region(points, t.supplier_areas(spark, sf_dir), region_col="area_id").select("c_custkey", "area_id")


@query(f"""WITH {POINTS}, {SERVICE}, moved AS (SELECT id, x1 + (id % 10 = 0)::INTEGER AS x1, x2 + (id % 10 = 0)::INTEGER AS x2, y1, y2 FROM s)
SELECT p.k AS c_custkey, min(m.id) AS area_id FROM p LEFT JOIN moved m ON x > x1 AND x < x2 AND y > y1 AND y < y2 GROUP BY p.k""")
def area_by_stored_index(spark, sf_dir):
    """An index of all areas kept in a store; after a tenth of them move, only those are cut again."""
    store, areas = Store(spark, fresh_path(spark, "store")), t.supplier_areas(spark, sf_dir)
    store_region_index(store, areas, buckets=8)
    east = F.transform("geometry", lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.struct((v["x"] + 1).alias("x"), v["y"].alias("y")))))
    update_region_index(store, areas.withColumn("geometry", F.when(F.col("id") % 10 == 0, east).otherwise(F.col("geometry"))))
    points = t.customer_points(spark, sf_dir).select("c_custkey", "geometry")
    return assign_region(points, load_region_index(store), region_col="area_id").select("c_custkey", "area_id")


@query(f"""WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {BEST}
SELECT p.k AS c_custkey, CASE WHEN p.k % 3 = 0 THEN 2000 + c_nationkey WHEN p.k % 7 <> 0 THEN best.id END::BIGINT AS region_id
FROM p LEFT JOIN best ON p.k = best.k""")
def fill_missing_region(spark, sf_dir):
    """Every third point comes with a region, every seventh without a geometry."""
    k = F.col("c_custkey")
    points = t.customer_points(spark, sf_dir).select(
        "c_custkey",
        F.when(k % 7 != 0, F.col("geometry")).alias("geometry"),
        F.when(k % 3 == 0, F.lit(2000) + F.col("c_nationkey")).alias("region_id"),
    )
    return fill_region(points, t.areas(spark, sf_dir)).select("c_custkey", F.col("region_id").cast("bigint").alias("region_id"))


@query(f"""WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {LINES} SELECT k AS c_custkey, id::BIGINT AS region_id FROM met""")
def lines_regions(spark, sf_dir):
    pairs = line_region_pairs(t.customer_lines(spark, sf_dir), t.areas(spark, sf_dir), key_col="c_custkey")
    return pairs.select("c_custkey", F.col("region_id").cast("bigint").alias("region_id"))


@query(f"""WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {LINES},
a AS (SELECT k, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM met GROUP BY k)
SELECT p.k AS c_custkey, CASE WHEN p.k % 5 = 0 THEN '7' ELSE ids END AS region_ids FROM p LEFT JOIN a ON p.k = a.k""")
def lines_region_array(spark, sf_dir):
    """Every fifth line comes with an array, the others with none or an empty one."""
    k = F.col("c_custkey")
    given = F.when(k % 5 == 0, F.array(F.lit(7))).when(k % 5 == 1, F.array().cast("array<int>"))
    lines = t.customer_lines(spark, sf_dir).withColumn("region_ids", given)
    filled = assign_regions_array(lines, t.areas(spark, sf_dir), key_col="c_custkey")
    return filled.select("c_custkey", F.array_join(F.col("region_ids").cast("array<string>"), ",").alias("region_ids"))


@query(f"WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {LINES} SELECT k AS c_custkey FROM met WHERE id = 2007")
def region_lines(spark, sf_dir):
    """Lines crossing one region: those whose box meets the region's, tested."""
    return lines_meeting(t.customer_lines(spark, sf_dir), t.areas(spark, sf_dir), 2007, key_col="c_custkey")


@query(ORACLES["region_lines"])
def stored_region_lines(spark, sf_dir):
    """The same from a stored bridge, sorted by region: only row groups that may hold the region are read."""
    store = Store(spark, fresh_path(spark, "store"))
    pairs = line_region_pairs(t.customer_lines(spark, sf_dir), t.areas(spark, sf_dir), key_col="c_custkey")
    store.commit(store.append_sorted("line_regions", pairs, ["region_id", "c_custkey"]))
    return store.read("line_regions").where("region_id = 2007").select("c_custkey")


@query(f"WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {LINES} SELECT id::BIGINT AS region_id, count(*) AS n_lines FROM met GROUP BY id")
def region_line_counts(spark, sf_dir):
    """Lines per region through the bridge table."""
    filled = assign_regions_array(t.customer_lines(spark, sf_dir), t.areas(spark, sf_dir), key_col="c_custkey")
    bridge = line_region_bridge(filled, "c_custkey")
    return bridge.groupBy(F.col("region_id").cast("bigint").alias("region_id")).agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"""WITH {DIAMONDS}, {RECTANGLES}, {SERVICE}
SELECT id::BIGINT AS id, 2 AS admin_level, cx::DOUBLE AS x, cy::DOUBLE AS y FROM d
UNION ALL SELECT id, 1, (x1 + x2) / 2, (y1 + y2) / 2 FROM r
UNION ALL SELECT id, 3, (x1 + x2) / 2, (y1 + y2) / 2 FROM s""")
def region_centroid(spark, sf_dir):
    shapes = t.areas(spark, sf_dir).unionByName(t.supplier_areas(spark, sf_dir))
    placed = shapes.select(F.col("id").cast("bigint").alias("id"), "admin_level", centroid("geometry").alias("centre"))
    return placed.select("id", "admin_level", "centre.x", "centre.y")


@query(f"""WITH {DIAMONDS}, {RECTANGLES}, {SERVICE}
SELECT s.id AS a_id, d.id::BIGINT AS b_id FROM s JOIN d
  ON greatest(x1 - cx, 0, cx - x2) + greatest(y1 - cy, 0, cy - y2) <= 2
UNION ALL SELECT s.id, r.id FROM s JOIN r ON s.x1 <= r.x2 AND s.x2 >= r.x1 AND s.y1 <= r.y2 AND s.y2 >= r.y1""")
def region_overlay(spark, sf_dir):
    pairs = overlay_regions(t.supplier_areas(spark, sf_dir), t.areas(spark, sf_dir))
    return pairs.select("a_id", F.col("b_id").cast("bigint").alias("b_id"))


@query("""SELECT c_custkey, abs(x - cx) + abs(y - cy) < 2 AS inside, meets FROM (
  SELECT c_custkey, -80 + ((c_custkey * 37) % 81) / 4::DOUBLE AS x, 30 + ((c_custkey * 53) % 79) / 4::DOUBLE AS y,
    -78 + 4 * (c_nationkey % 5) AS cx, 32 + 4 * (c_nationkey // 5) AS cy,
    x + ((c_custkey * 7) % 33) / 4::DOUBLE - 4 AS ex, y + ((c_custkey * 17) % 31) / 4::DOUBLE - 4 AS ey,
    greatest(x + y, ex + ey) >= cx + cy - 2 AND least(x + y, ex + ey) <= cx + cy + 2
    AND greatest(x - y, ex - ey) >= cx - cy - 2 AND least(x - y, ex - ey) <= cx - cy + 2
    AND abs((ex + ey - x - y) * (cx - cy - x + y) - (ex - ey - x + y) * (cx + cy - x - y))
        <= 2 * (abs(ex + ey - x - y) + abs(ex - ey - x + y)) AS meets FROM customer)""")
def own_region_tests(spark, sf_dir):
    """The two predicates on row pairs already brought together: each customer against its own nation."""
    nations = t.nation_areas(spark, sf_dir).select((F.col("id") - 2000).alias("c_nationkey"), F.col("geometry").alias("area"))
    points = t.customer_points(spark, sf_dir).select("c_custkey", "c_nationkey", "geometry")
    lines = t.customer_lines(spark, sf_dir).select("c_custkey", F.col("geometry").alias("line"))
    joined = points.join(lines, "c_custkey").join(nations, "c_nationkey")
    return joined.select("c_custkey", within("geometry", "area").alias("inside"), intersects("line", "area").alias("meets"))


@query(f"""WITH {POINTS}, {DIAMONDS}, {RECTANGLES}, {BEST}
SELECT best.id::BIGINT AS region_id, c_mktsegment AS fuel_type, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS installed_mw
FROM p JOIN best ON p.k = best.k GROUP BY 1, 2""")
def plant_capacity_by_fuel(spark, sf_dir):
    """Capacity per region and fuel: account balance as megawatts, market segment as fuel."""
    plants = t.customer_points(spark, sf_dir).select("geometry", F.col("c_acctbal").alias("capacity_mw"), F.col("c_mktsegment").alias("fuel_type"))
    located = assign_region(plants, t.areas(spark, sf_dir)).withColumn("region_id", F.col("region_id").cast("bigint"))
    return plant_capacity(located, by=("fuel_type",))


def shifted_points(spark, sf_dir):
    g = F.col("geometry")
    return t.customer_points(spark, sf_dir).withColumn("geometry", point(g["x"] + 0.0625, g["y"] + 0.0625))


PIXELS = """
q AS (SELECT k, x + 0.0625 AS x, y + 0.0625 AS y, c_mktsegment, (x + 0.0625 + 180) / 360 AS mx,
             0.5 - ln((1 + sin(radians(y + 0.0625))) / (1 - sin(radians(y + 0.0625)))) / (4 * pi()) AS my FROM p)"""


@query(f"""WITH {POINTS}, {PIXELS}, z AS (SELECT unnest([2, 3, 4, 5, 6, 7]) AS zoom),
g AS (SELECT zoom, floor(mx * 512 * pow(2, zoom) / 50) AS i, floor(my * 512 * pow(2, zoom) / 50) AS j, count(*) AS n, avg(mx) AS ax, avg(my) AS ay,
             any_value(x) AS x, any_value(y) AS y, any_value(c_mktsegment) AS seg FROM q, z WHERE zoom <= 6 GROUP BY ALL
      UNION ALL SELECT zoom, k, 0, 1, mx, my, x, y, c_mktsegment FROM q, z WHERE zoom > 6)
SELECT zoom, n AS point_count, round(CASE WHEN n = 1 THEN x ELSE ax * 360 - 180 END, 6) AS x,
       round(CASE WHEN n = 1 THEN y ELSE degrees(2 * atan(exp((0.5 - ay) * 2 * pi()))) - 90 END, 6) AS y,
       CASE WHEN n = 1 THEN seg END AS c_mktsegment FROM g""")
def clustered_points(spark, sf_dir):
    """Clusters of 50 pixels at zooms 2 to 7, clustered up to zoom 6; zooms 2 to 6 from one reading of the points."""
    pyramid = cluster_pyramid(shifted_points(spark, sf_dir), list(range(2, 8)), 50, 6, ["c_mktsegment"])
    return pyramid.select("zoom", "point_count", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "c_mktsegment")


@query(f"""WITH {POINTS}, {PIXELS}, c AS (
  SELECT floor(mx * 512 * 8 / 40)::BIGINT AS cell_x, floor(my * 512 * 8 / 40)::BIGINT AS cell_y, zoom,
         count(*) AS n, count(DISTINCT (floor(mx * 512 * pow(2, zoom) / 40), floor(my * 512 * pow(2, zoom) / 40))) AS cells
  FROM q, (SELECT unnest([4, 5, 6, 7]) AS zoom) GROUP BY ALL)
SELECT cell_x, cell_y, any_value(n) AS point_count, coalesce(min(zoom) FILTER (cells > 1), 8)::INTEGER AS expansion_zoom
FROM c GROUP BY 1, 2 HAVING any_value(n) > 1""")
def expansion_zoom(spark, sf_dir):
    return cluster_expansion_zoom(shifted_points(spark, sf_dir), 3, 40, 7)


@query(f"WITH {POINTS} SELECT k AS c_custkey, round(x, 6) AS x, round(y, 6) AS y FROM p")
def reprojected_points(spark, sf_dir):
    """Points taken to Web Mercator metres and read back as lon/lat."""
    g = F.col("geometry")
    metres = point(F.radians(g["x"]) * EARTH_RADIUS_M, F.log(F.tan(F.radians(g["y"]) / 2 + F.radians(F.lit(45.0)))) * EARTH_RADIUS_M)
    back = t.customer_points(spark, sf_dir).select("c_custkey", metres.alias("m")).select("c_custkey", to_wgs84("m", "point", 3857).alias("g"))
    return back.select("c_custkey", F.round("g.x", 6).alias("x"), F.round("g.y", 6).alias("y"))
