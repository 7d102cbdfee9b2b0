"""Table changes and checks."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from gridloam.operators.filters import attribute_filter
from gridloam.operators.quality import check_domain, check_unique, drop_null_geometry, load_metrics, out_of_range, outside, reject_missing_id
from gridloam.operators.tables import (
    cascade_delete,
    check_reference,
    clear_reference,
    last_wins,
    remove_regions,
    resolve_region_id,
    upsert,
    upsert_regions,
)
from gridloam.session import fresh_path, written
from gridloam.sources.stored import publish, read_published, scan

# Orders as a versioned source table: seven tenths are stored, five tenths arrive, some under a NULL id and
# some twice.
UPSERT_INPUT = """
stored AS (SELECT 'orders' AS source, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey::VARCHAR END AS source_id, '2026-01-01' AS source_version,
             o_orderpriority AS name, o_totalprice AS power, 'old' AS license FROM orders WHERE o_orderkey % 10 < 7),
arriving AS (SELECT 'orders' AS source, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey::VARCHAR END AS source_id,
               CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-01' ELSE '2026-02-01' END AS source_version,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS name, o_totalprice + copy AS power, 'new' AS license, copy AS row_idx
             FROM orders, (SELECT unnest([1, 2]) AS copy) WHERE o_orderkey % 10 >= 5 AND (copy = 1 OR o_orderkey % 10 = 9)),
batch AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY row_idx DESC) AS n FROM arriving WHERE source_id IS NOT NULL) WHERE n = 1)
"""


def upsert_sql(keys: str, version: str, on: str) -> str:
    return f"""WITH {UPSERT_INPUT.format(keys=keys)}
SELECT coalesce(s.source, b.source) AS source, coalesce(s.source_id, b.source_id) AS source_id, {version} AS source_version,
  CASE WHEN b.source IS NOT NULL THEN b.name ELSE s.name END AS name, CASE WHEN b.source IS NOT NULL THEN b.power ELSE s.power END AS power,
  CASE WHEN s.source IS NOT NULL THEN s.license ELSE b.license END AS license
FROM (SELECT * FROM stored WHERE source_id IS NOT NULL) s FULL JOIN batch b ON {on}
UNION ALL SELECT * FROM stored WHERE source_id IS NULL
UNION ALL SELECT * EXCLUDE (row_idx) FROM arriving WHERE source_id IS NULL"""


def upsert_input(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    source_id = F.when(k % 97 != 0, k.cast("string")).alias("source_id")
    first, second = F.lit(date(2026, 1, 1)), F.lit(date(2026, 2, 1))
    stored = orders.where(k % 10 < 7).select(
        F.lit("orders").alias("source"), source_id, first.alias("source_version"),
        F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("power"), F.lit("old").alias("license"),
    )
    copies = F.explode(F.when(k % 10 == 9, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("row_idx")
    arriving = orders.where(k % 10 >= 5).select("*", copies).select(
        F.lit("orders").alias("source"), source_id, F.when(k % 2 == 0, first).otherwise(second).alias("source_version"),
        F.when(k % 4 != 0, F.col("o_orderstatus")).alias("name"), (F.col("o_totalprice") + F.col("row_idx")).alias("power"),
        F.lit("new").alias("license"), "row_idx",
    )
    return stored, arriving


@query(upsert_sql("source, source_id, source_version", "coalesce(s.source_version, b.source_version)",
                  "s.source = b.source AND s.source_id = b.source_id AND s.source_version = b.source_version"))
def upsert_versioned(spark, sf_dir):
    """The version is part of the key, so versions live side by side."""
    stored, arriving = upsert_input(spark, sf_dir)
    merged = upsert(stored, arriving, ["source", "source_id", "source_version"], ["name", "power"], ["license"])
    return merged.withColumn("source_version", F.col("source_version").cast("string"))


@query(upsert_sql("source, source_id", "CASE WHEN b.source IS NOT NULL THEN b.source_version ELSE s.source_version END",
                  "s.source = b.source AND s.source_id = b.source_id"))
def upsert_unversioned(spark, sf_dir):
    """The version is an ordinary column and is overwritten."""
    stored, arriving = upsert_input(spark, sf_dir)
    merged = upsert(stored, arriving, ["source", "source_id"], ["source_version", "name", "power"], ["license"])
    return merged.withColumn("source_version", F.col("source_version").cast("string"))


@query("""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1""")
def last_rows(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    return last_wins(lines, ["l_orderkey", "l_linenumber"], *order)


@query("""SELECT 'customer' AS tab, c_custkey AS id, CASE WHEN n_regionkey <> 2 THEN c_nationkey END AS region_id FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 2
UNION ALL SELECT 'nation', n_nationkey, NULL FROM nation WHERE n_regionkey <> 2""")
def removed_regions(spark, sf_dir):
    """Nations of one region removed: customers lose the reference, suppliers go, other nations stay."""
    nations = t.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), "n_regionkey")
    removed = nations.where("n_regionkey = 2")
    customers = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("region_id"))
    suppliers = t.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("region_id"))
    left = remove_regions(nations, removed, {"announcements": customers, "grid_feasibility": suppliers})
    return (
        left["announcements"].withColumn("tab", F.lit("customer"))
        .unionByName(left["grid_feasibility"].withColumn("tab", F.lit("supplier")))
        .unionByName(left["regions"].select(F.col("id").cast("bigint").alias("id"), F.lit(None).cast("int").alias("region_id"), F.lit("nation").alias("tab")))
    )


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN o_custkey END AS o_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey")
def cleared_references(spark, sf_dir):
    """Orders of customers in debt lose their customer: a reference side that grows with the data."""
    removed = t.table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return clear_reference(t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", removed, "c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def cascaded_deletes(spark, sf_dir):
    removed = t.table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return cascade_delete(t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", removed, "c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orphans(spark, sf_dir):
    parents = t.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return check_reference(t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    return check_unique(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN l_quantity > 45 THEN 'quantity' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag' END, CASE WHEN l_discount > 0.09 THEN 'discount' END) AS violations
FROM lineitem WHERE l_quantity > 45 OR l_returnflag NOT IN ('A', 'N') OR l_discount > 0.09""")
def domain_violations(spark, sf_dir):
    rules = {"quantity": out_of_range("l_quantity", 0, 45), "flag": outside("l_returnflag", ["A", "N"]), "discount": F.col("l_discount") > 0.09}
    _, rejected = check_domain(t.table(spark, sf_dir, "lineitem"), rules)
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT count(*) FILTER (c_custkey % 7 = 0) AS without_geometry, count(*) AS read, count(*) FILTER (c_custkey % 5 <> 0) AS written, count(*) FILTER (c_custkey % 5 = 0) AS skipped FROM customer")
def load_counts(spark, sf_dir):
    """Counts observed while rows pass through a write, without scanning them again."""
    k = F.col("c_custkey")
    points = t.customer_points(spark, sf_dir).select(
        F.when(k % 7 != 0, F.col("geometry")).alias("geometry"), F.when(k % 5 != 0, k.cast("string")).alias("source_id")
    )
    counted, rows = load_metrics(points, F.col("source_id").isNotNull())
    located, lost = drop_null_geometry(counted)
    good, _ = reject_missing_id(located)
    good.write.format("noop").mode("overwrite").save()
    seen = {**rows.get, "without_geometry": lost.get["dropped"]}
    return spark.range(1).select(*[F.lit(seen[n]).cast("bigint").alias(n) for n in ("without_geometry", "read", "written", "skipped")])


@query("""SELECT c_custkey, sha256('["US","2","' || n_name || '"]') AS region_id FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def resolved_regions(spark, sf_dir):
    """Rows carrying a region's natural key get its id."""
    names = t.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("admin_code"))
    rows = t.table(spark, sf_dir, "customer").join(names, "c_nationkey").select(
        "c_custkey", F.lit("US").alias("country_code"), F.lit(2).alias("admin_level"), "admin_code"
    )
    return resolve_region_id(rows, stored_regions(spark, sf_dir)).select("c_custkey", "region_id")


STORED_AT = datetime(2026, 1, 1, tzinfo=timezone.utc)


def stored_regions(spark, sf_dir):
    """Nations loaded into an empty region table and stored."""
    empty = spark.createDataFrame(
        [], "id string, name string, country_code string, admin_level int, admin_code string, parent_region_id string, "
        "geometry array<array<array<struct<x:double,y:double>>>>, centroid struct<x:double,y:double>, created_at timestamp, updated_at timestamp"
    )
    return written(upsert_regions(empty, region_batch(spark, sf_dir), F.lit(STORED_AT)), "regions")


def region_batch(spark, sf_dir):
    """Nations as a batch of regions."""
    return t.nation_areas(spark, sf_dir).select(
        F.col("id").alias("row_idx"), "name", F.lit("US").alias("country_code"), F.lit(2).alias("admin_level"), F.col("name").alias("admin_code"), "geometry"
    )


@query("""SELECT sha256('["US","2","' || code || '"]') AS id, name, x, y, created, updated FROM (
  SELECT n_name AS code, CASE WHEN n_nationkey % 2 = 0 THEN 'new ' || n_name ELSE n_name END AS name, (-78 + 4 * (n_nationkey % 5))::DOUBLE AS x,
    (32 + 4 * (n_nationkey // 5))::DOUBLE + CASE WHEN n_nationkey % 2 = 0 THEN 0.5 ELSE 0 END::DOUBLE AS y, 1 AS created, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS updated FROM nation
  UNION ALL SELECT 'S' || s_suppkey, s_name, -80 + ((s_suppkey * 37) % 81) / 4::DOUBLE + (s_suppkey % 9 + 1) / 8::DOUBLE,
    30 + ((s_suppkey * 53) % 79) / 4::DOUBLE + (s_suppkey % 7 + 1) / 8::DOUBLE, 2, 2 FROM supplier)""")
def upserted_regions(spark, sf_dir):
    """Half of the stored regions are renamed and moved and one new region per supplier comes in."""
    n = F.col("id") - 2000
    moved = t.nation_areas(spark, sf_dir).where(n % 2 == 0).select(
        F.col("id").cast("bigint").alias("row_idx"), F.concat(F.lit("new "), "name").alias("name"), F.col("name").alias("admin_code"),
        F.transform("geometry", lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.struct(v["x"].alias("x"), (v["y"] + 0.5).alias("y"))))).alias("geometry"),
    )
    added = t.supplier_areas(spark, sf_dir).select(
        (F.col("id") + 100000).alias("row_idx"), "name", F.concat(F.lit("S"), "id").alias("admin_code"), "geometry"
    )
    batch = moved.unionByName(added).withColumns({"country_code": F.lit("US"), "admin_level": F.lit(2)})
    out = upsert_regions(stored_regions(spark, sf_dir), batch, F.lit(datetime(2026, 2, 1, tzinfo=timezone.utc)))
    return out.select("id", "name", "centroid.x", "centroid.y", F.month("created_at").alias("created"), F.month("updated_at").alias("updated"))


@query("SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer")
def published_table(spark, sf_dir):
    """Two versions published one after the other; readers see the second, whole."""
    path = fresh_path(spark, "published")
    rows = scan(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_acctbal"])

    def unique_keys(written):
        if not check_unique(written, ["c_custkey"]).isEmpty():
            raise ValueError("duplicate c_custkey")

    publish(rows, path, unique_keys)
    publish(rows.withColumn("c_acctbal", F.col("c_acctbal") + 1), path, unique_keys)
    return read_published(spark, path)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def attribute_lookup(spark, sf_dir):
    found = attribute_filter(
        scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]),
        o_orderstatus="F", o_orderpriority=["1-URGENT", "2-HIGH"],
    )
    return found.select("o_orderkey", "o_totalprice")
