"""Loads from features to table rows. Each is one plan; the driver only checks and publishes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloam.functions import formula
from gridloam.functions.geometry import decode_geometry, to_wgs84
from gridloam.functions.numbers import strict_double, strict_int, to_double
from gridloam.functions.text import (
    clean_text,
    entity_id,
    entity_id_indexed,
    falsy_to_null,
    is_unrecognised_status,
    natural_id,
    normalize_status,
    osm_id,
    raw_attributes_json,
    version_date,
    with_measure_text,
)
from gridloam.operators.filters import map_columns, with_has_geometry
from gridloam.operators.tables import TABLE_RULES, resolve_region_id, snapshot_rows, upsert_regions
from gridloam.sources.geojson import absent_properties, parse_properties

# --- fixed values: property names of the sources
FRONTIER_PROPERTIES = ["Name", "Owner", "Country", "Current power (MW)", "Current H100 equivalents", "citation"]
CLUSTER_PROPERTIES = [
    "Name", "Owner", "Country", "Status", "Certainty", "Power Capacity (MW)", "H100 equivalents", "Max OP/s", "citation",
]
OSM_PROPERTIES = ["name", "operator", "full_id", "osm_type", "osm_id"]
FEASIBILITY_PROPERTIES = [
    "county_name", "fips", "feasibility_ratio", "feasibility_category", "feasibility_score", "is_dc_hotspot",
    "headroom_mw", "summer_cap_mw", "net_gen_mwh", "peak_demand_mw",
    "q_projects", "q_total_mw", "q_realistic_mw", "q_solar_mw", "q_battery_mw", "q_wind_mw", "q_gas_mw",
    "completion_rate_pct", "sub_critical", "sub_high", "sub_throughput",
]

# --- fixed values: source names and licenses
FRONTIER_SOURCE, CLUSTER_SOURCE, OSM_SOURCE = "epoch_ai_frontier", "epoch_ai_gpu_clusters", "openstreetmap"
EPOCH_LICENSE, OSM_LICENSE = "CC-BY-4.0", "ODbL"


def placed(features: DataFrame, kind: str, epsg: int | None) -> Column:
    """The geometry in 4326. What the caller names counts first, then the code each feature brings along in a column
    `epsg`; a feature without either is in 4326 already, and one in any other system fails the run."""
    decoded = decode_geometry("geometry", kind)
    if epsg is not None or "epsg" not in features.columns:
        return to_wgs84(decoded, kind, epsg)
    code = F.coalesce("epsg", F.lit(4326))
    refused = F.raise_error(F.concat(F.lit("no conversion to EPSG:4326 from EPSG:"), code)).cast("void")
    return F.when(code == 4326, decoded).when(code == 3857, to_wgs84(decoded, kind, 3857)).otherwise(refused)


def _text(name: str):
    return clean_text(F.col(f"`{name}`"))


def _number(name: str):
    return to_double(F.col(f"`{name}`"))


def with_status_count(features: DataFrame, name: str = "Status") -> tuple[DataFrame, Observation]:
    """The features, and how many give a status that has no canonical form, known once their rows have been written."""
    seen, given = Observation(), F.get_json_object("properties", f"$['{name}']")
    return features.observe(seen, F.count_if(is_unrecognised_status(given)).alias("unrecognised")), seen


def frontier_rows(features: DataFrame, source_version: str, at: datetime, epsg: int | None = None, use_status: bool = False) -> DataFrame:
    """Frontier sites. The source carries no status, so all are `unknown` unless `use_status` reads one."""
    names = FRONTIER_PROPERTIES + (["Status"] if use_status else [])
    named = parse_properties(features, names)
    rows = map_columns(
        named,
        {
            "row_idx": "row_idx",
            "source_id": entity_id(_text("Name"), _text("Owner"), _text("Country")),
            "name": _text("Name"),
            "owner": _text("Owner"),
            "country": _text("Country"),
            "status": normalize_status(_text("Status")) if use_status else F.lit("unknown"),
            "power_capacity_mw": _number("Current power (MW)"),
            "h100_equivalent": _number("Current H100 equivalents"),
            "geometry": placed(features, "point", epsg),
            "citation": _text("citation"),
            "raw_attributes": raw_attributes_json("properties"),
        },
        {
            "source": FRONTIER_SOURCE,
            "ops_total": F.lit(None).cast("double"),
            "build_start": F.lit(None).cast("date"),
            "expected_operational": F.lit(None).cast("date"),
            "source_version": version_date(source_version),
            "license": EPOCH_LICENSE,
            "ingested_at": at,
        },
    )
    return with_has_geometry(rows).withColumn("id", natural_id("source", "source_id", "source_version"))


def cluster_rows(features: DataFrame, source_version: str, at: datetime, epsg: int | None = None) -> DataFrame:
    """GPU clusters. Their id includes the position in the file, so `row_idx` must be present."""
    parsed = parse_properties(features, CLUSTER_PROPERTIES).withColumns(
        {"power": _number("Power Capacity (MW)"), "h100": _number("H100 equivalents")}
    )
    named = with_measure_text(parsed, {"power_text": "power", "h100_text": "h100"})
    rows = map_columns(
        named,
        {
            "row_idx": "row_idx",
            "source_id": entity_id_indexed("Name", "Owner", "Country", "h100_text", "power_text", "row_idx"),
            "name": _text("Name"),
            "owner": _text("Owner"),
            "country": _text("Country"),
            "status": normalize_status(_text("Status")),
            "certainty": _text("Certainty"),
            "power_capacity_mw": "power",
            "h100_equivalent": "h100",
            "ops_total": _number("Max OP/s"),
            "geometry": placed(features, "point", epsg),
            "citation": _text("citation"),
            "raw_attributes": raw_attributes_json("properties"),
        },
        {
            "source": CLUSTER_SOURCE,
            "geocoding_precision": F.lit(None).cast("string"),
            "source_version": version_date(source_version),
            "license": EPOCH_LICENSE,
            "ingested_at": at,
        },
    )
    return with_has_geometry(rows).withColumn("id", natural_id("source", "source_id", "source_version"))


def osm_rows(features: DataFrame, snapshot_date: str, at: datetime, epsg: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows without geometry or id). Features without geometry are left out of both counts
    of written rows and stay visible in the second frame."""
    named = parse_properties(features, OSM_PROPERTIES)
    rows = map_columns(
        named,
        {
            "row_idx": "row_idx",
            "source_id": osm_id("osm_type", "osm_id", "full_id"),
            "name": falsy_to_null("name"),
            "operator": falsy_to_null("operator"),
            "geometry": placed(features, "point", epsg),
            "raw_tags": raw_attributes_json("properties"),
        },
        {
            "source": OSM_SOURCE,
            "source_version": version_date(snapshot_date),
            "license": OSM_LICENSE,
            "ingested_at": at,
        },
    ).withColumn("id", natural_id("source", "source_id"))
    usable = F.col("geometry").isNotNull() & F.col("source_id").isNotNull()
    return rows.where(usable), rows.where(~usable)


def feasibility_features(features: DataFrame, epsg: int | None = None, country: str = "US", admin_level: int = 2) -> DataFrame:
    """Region features with their index values. A missing or invalid required property fails the run."""
    lacking = absent_properties(FEASIBILITY_PROPERTIES)
    complete = features.withColumn(
        "properties",
        F.when(F.size(lacking) == 0, F.col("properties")).otherwise(
            F.raise_error(F.concat(F.lit("feature lacks properties: "), F.array_join(lacking, ", ")))
        ),
    )
    named = parse_properties(complete, FEASIBILITY_PROPERTIES)
    # A hotspot flag given as null counts as false; the flag itself must be present.
    components = formula.build_components(
        F.col, strict_double, strict_int, lambda c, _: F.coalesce(c.try_cast("boolean"), F.lit(False))
    )
    return map_columns(
        named,
        {
            "row_idx": "row_idx",
            "name": F.col("county_name"),
            "admin_code": F.col("fips"),
            "geometry": placed(features, "multipolygon", epsg),
            "value": strict_double("feasibility_ratio", "feasibility_ratio"),
            "category": formula.canonical_category("feasibility_category"),
            "components": components,
        },
        {"country_code": country, "admin_level": admin_level},
    )


def load_feasibility(features: DataFrame, regions: DataFrame, version: str, at: datetime) -> tuple[DataFrame, DataFrame]:
    """(regions after the upsert, index rows to append) for one set of `feasibility_features`."""
    batch = features.select("row_idx", "name", "country_code", "admin_level", "admin_code", "geometry")
    merged = upsert_regions(regions, batch, F.lit(at))
    return merged, index_values(features, merged, version, at)


def index_values(features: DataFrame, regions: DataFrame, version: str, at: datetime) -> DataFrame:
    """The index rows of a set of `feasibility_features`, with the ids of their regions, which came with them."""
    values = features.select("row_idx", "country_code", "admin_level", "admin_code", "value", "category", "components")
    # A region with a NULL in its key is found by no key; its id follows from the run and the position, as at the upsert.
    own = natural_id(*TABLE_RULES["regions"]["keys"], distinguish=(F.lit(""), F.col("row_idx")))
    resolved = resolve_region_id(values, regions, "left").withColumn("region_id", F.coalesce("region_id", own))
    rows = snapshot_rows(resolved, version, at)
    return rows.select("id", "region_id", "methodology_version", "computed_at", "value", "category", "components")
