"""Reads for a map: current index values joined to regions, and the datacenter layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloam.functions.formula import flatten_components
from gridloam.operators.filters import only_spatial, status_filter
from gridloam.operators.history import current_snapshot
from gridloam.operators.skew import lookup_join
from gridloam.sources.geojson import feature_json

# --- fixed values: properties each layer shows
LAYER_PROPERTIES = {
    "feasibility": ["name", "admin_code", "value", "category", "headroom_mw", "peak_demand_mw", "q_realistic_mw"],
    "frontier": ["id", "name", "owner", "country", "status", "power_capacity_mw", "h100_equivalent", "citation"],
    "clusters": [
        "id", "name", "owner", "country", "status", "certainty", "power_capacity_mw", "h100_equivalent", "ops_total",
        "geocoding_precision", "citation",
    ],
    "osm": ["id", "name", "operator"],
}


def map_features(current: DataFrame, regions: DataFrame, methodology_version: str | None = None) -> DataFrame:
    """Current index values with the name, code and shape of their region; regions without a shape drop out.

    Without a methodology version, a region appears once per version it has values for.
    """
    if methodology_version is not None:
        current = current.where(F.col("methodology_version") == methodology_version)
    shapes = regions.where(F.col("geometry").isNotNull()).select(F.col("id").alias("region_id"), "name", "admin_code", "geometry")
    joined = lookup_join(current, shapes, ["region_id"], "inner")
    return joined.select("region_id", "name", "admin_code", "value", "category", *flatten_components(), "geometry")


def feasibility_layer(snapshots: DataFrame, regions: DataFrame, methodology_version: str | None = None) -> DataFrame:
    return map_features(current_snapshot(snapshots), regions, methodology_version)


def datacenter_layer(rows: DataFrame, layer: str, planned: bool = True, decommissioned: bool = False) -> DataFrame:
    """Shown columns of the located facilities of one layer; layers with a status are filtered by it."""
    located = only_spatial(rows) if "has_geometry" in rows.columns else rows
    shown = located.select(*LAYER_PROPERTIES[layer], "geometry")
    if "status" in LAYER_PROPERTIES[layer]:
        shown = status_filter(shown.withColumn("status", F.coalesce("status", F.lit("unknown"))), planned, decommissioned)
    return shown


def as_features(layer_rows: DataFrame, layer: str) -> DataFrame:
    """One GeoJSON Feature per row, so that layers with different columns can be put in one output."""
    kind = "multipolygon" if layer == "feasibility" else "point"
    return layer_rows.select(F.lit(layer).alias("layer"), feature_json(kind, LAYER_PROPERTIES[layer]).alias("feature"))
