"""Text, ids, numbers and property bags."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from gridloam.functions.numbers import fixed_text, float_text, number_text, round_exact, to_double
from gridloam.functions.text import (
    clean_text,
    entity_id,
    entity_id_indexed,
    falsy_to_null,
    is_unrecognised_status,
    normalize_status,
    osm_id,
    raw_attributes,
    raw_attributes_json,
    with_measure_text,
)


@query("""SELECT c_custkey, substr(sha256(c_name || '|' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE n_name END || '|' || r_name), 1, 16) AS source_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def entity_ids(spark, sf_dir):
    """Names padded with a tab and a no-break space; every third owner is missing."""
    joined = (
        t.table(spark, sf_dir, "customer")
        .join(t.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    name = F.concat(F.lit("\t"), F.col("c_name"), F.lit("  "))
    owner = F.when(F.col("c_custkey") % 3 != 0, F.col("n_name"))
    return joined.select("c_custkey", entity_id(name, owner, "r_name").alias("source_id"))


@query("""SELECT p_partkey, substr(sha256(p_name || '|' || p_brand || '|' || p_type || '|' || p_retailprice::VARCHAR || '|' ||
  CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE::VARCHAR ELSE '' END || '|' || p_partkey), 1, 16) AS source_id FROM part""")
def indexed_entity_ids(spark, sf_dir):
    power = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("double"))
    parts = with_measure_text(t.table(spark, sf_dir, "part").withColumn("power", power), {"price_text": "p_retailprice", "power_text": "power"})
    return parts.select("p_partkey", entity_id_indexed("p_name", "p_brand", "p_type", "price_text", "power_text", "p_partkey").alias("source_id"))


STATUS_CASE = """CASE event_type WHEN 'view' THEN 'operational' WHEN 'click' THEN 'planned' WHEN 'signup' THEN 'under_construction' WHEN 'purchase' THEN 'decommissioned' ELSE 'unknown' END"""


def raw_status():
    e = F.col("event_type")
    return (
        F.when(e == "view", " Existing").when(e == "click", "In Planning\t").when(e == "signup", "CONSTRUCTION")
        .when(e == "purchase", "retired").when(F.col("event_id") % 2 == 0, "foo").otherwise("")
    )


@query(f"SELECT event_id, {STATUS_CASE} AS status, event_type = 'error' AND event_id % 2 = 0 AS unrecognised FROM events")
def normalized_statuses(spark, sf_dir):
    return t.table(spark, sf_dir, "events").select(
        "event_id", normalize_status(raw_status()).alias("status"), is_unrecognised_status(raw_status()).alias("unrecognised")
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 <> 3 THEN c_mktsegment END AS cleaned,
  CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN ' ' || c_mktsegment || ' ' WHEN 2 THEN chr(9) || c_mktsegment || chr(160) END AS kept FROM customer""")
def cleaned_text(spark, sf_dir):
    k, seg = F.col("c_custkey") % 4, F.col("c_mktsegment")
    cleaned = F.when(k == 0, seg).when(k == 1, F.concat(F.lit(" "), seg, F.lit(" "))).when(k == 2, F.concat(F.lit("\t"), seg, F.lit(" "))).otherwise("  ")
    kept = F.when(k == 0, seg).when(k == 1, F.concat(F.lit(" "), seg, F.lit(" "))).when(k == 2, F.concat(F.lit("\t"), seg, F.lit(" "))).otherwise("")
    return t.table(spark, sf_dir, "customer").select("c_custkey", clean_text(cleaned).alias("cleaned"), falsy_to_null(kept).alias("kept"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_acctbal WHEN 1 THEN c_custkey * 1000.0::DOUBLE WHEN 2 THEN c_custkey::DOUBLE END AS number FROM customer""")
def parsed_numbers(spark, sf_dir):
    """Plain, exponent and padded numbers; suffixed, empty and NaN ones."""
    k, key = F.col("c_custkey") % 6, F.col("c_custkey").cast("string")
    text = (
        F.when(k == 0, F.col("c_acctbal").cast("string")).when(k == 1, F.concat(key, F.lit("e3"))).when(k == 2, F.concat(F.lit("\t+"), key, F.lit(".0 ")))
        .when(k == 3, F.concat(key, F.lit("d"))).when(k == 4, F.lit("nan")).otherwise("")
    )
    return t.table(spark, sf_dir, "customer").select("c_custkey", to_double(text).alias("number"))


@query("""SELECT o_orderkey, round(o_totalprice / 7, 4) AS rounded, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR || '.0' ELSE o_orderkey::VARCHAR || '.5' END AS float_text,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR ELSE o_orderkey::VARCHAR || '.5' END AS number_text, printf('%.2f', o_totalprice) AS fixed_text FROM orders""")
def number_texts(spark, sf_dir):
    value = F.col("o_orderkey") + F.when(F.col("o_orderkey") % 2 == 0, 0.0).otherwise(0.5)
    orders = t.table(spark, sf_dir, "orders").withColumns({"value": value, "seventh": F.col("o_totalprice") / 7})
    return orders.select(
        "o_orderkey", round_exact("seventh", 4).alias("rounded"), float_text("value").alias("float_text"),
        number_text("value").alias("number_text"), fixed_text("o_totalprice", 2).alias("fixed_text"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'way/' || p_partkey WHEN 1 THEN 'w' || p_partkey WHEN 2 THEN 'n' || p_partkey END AS source_id FROM part""")
def osm_ids(spark, sf_dir):
    """Type and number; a missing or empty type falls back to the full id; neither gives NULL."""
    k, key = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    kind = F.when(k == 0, "way").when(k == 2, "")
    number = F.when(k != 3, key)
    full = F.when(k == 0, "unused").when(k == 1, F.concat(F.lit("w"), key)).when(k == 2, F.concat(F.lit("n"), key)).otherwise("")
    return t.table(spark, sf_dir, "part").select("p_partkey", osm_id(kind, number, full).alias("source_id"))


@query("SELECT event_id, (props->>'k')::INTEGER AS k, json_exists(props, '$.absent') AS has_absent FROM events")
def json_attribute(spark, sf_dir):
    bag = raw_attributes_json("props")
    return t.table(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(bag, "$.k", "int").alias("k"), F.try_variant_get(bag, "$.absent", "string").isNotNull().alias("has_absent")
    )


@query("""SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN value END AS value, event_type, strftime(ts, '%Y-%m-%d') AS day, left(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 19) AS at FROM events""")
def raw_properties(spark, sf_dir):
    """A full property bag: NaN becomes null, dates and times ISO text."""
    rows = t.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.col("value")).otherwise(float("nan")).alias("value"), "event_type",
        F.to_date("ts").alias("day"), F.date_trunc("second", "ts").alias("at"),
    )
    bag = rows.select("event_id", raw_attributes(rows, ["value", "event_type", "day", "at"]).alias("bag"))
    return bag.select(
        "event_id", F.variant_get("bag", "$.value", "double").alias("value"),
        *[F.variant_get("bag", f"$.{n}", "string").alias(n) for n in ("event_type", "day", "at")],
    )
