"""Column mapping, row filters and layer selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_columns(df: DataFrame, mapping: dict[str, str | Column], constants: dict | None = None) -> DataFrame:
    """Target columns from source columns or expressions, then constants such as source and license."""
    picked = [(F.col(f"`{src}`") if isinstance(src, str) else src).alias(name) for name, src in mapping.items()]
    fixed = [(val if isinstance(val, Column) else F.lit(val)).alias(name) for name, val in (constants or {}).items()]
    return df.select(*picked, *fixed)


def with_has_geometry(df: DataFrame, geometry_col: str = "geometry") -> DataFrame:
    """Stored as a column, so that readers can push the filter on it into the scan."""
    return df.withColumn("has_geometry", F.col(geometry_col).isNotNull())


def only_spatial(df: DataFrame) -> DataFrame:
    return df.where(F.col("has_geometry"))


def shown_statuses(planned: bool = True, decommissioned: bool = False) -> list[str]:
    statuses = ["operational", "under_construction", "unknown"]
    if planned:
        statuses += ["planned", "announced"]
    if decommissioned:
        statuses += ["decommissioned"]
    return statuses


def status_filter(df: DataFrame, planned: bool = True, decommissioned: bool = False, status_col: str = "status") -> DataFrame:
    return df.where(F.col(status_col).isin(shown_statuses(planned, decommissioned)))


def attribute_filter(df: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns equal a value or are among a list of values; plain predicates that reach the scan."""
    tests = [F.col(c).isin(list(x)) if isinstance(x, (list, tuple, set)) else F.col(c) == x for c, x in wanted.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def lines_in_region(lines: DataFrame, region_id, array_col: str = "region_ids") -> DataFrame:
    return lines.where(F.array_contains(array_col, region_id))


def line_region_bridge(lines: DataFrame, key_col: str = "id", array_col: str = "region_ids") -> DataFrame:
    """One row per line and region: written sorted by region, it serves many lookups without array scans."""
    return lines.select(key_col, F.explode(array_col).alias("region_id"))


# --- fixed values: layers shown unless asked otherwise
DEFAULT_LAYERS = ("feasibility", "frontier")
STATUS_LAYERS = ("frontier", "clusters")


def select_layers(
    layers: dict[str, DataFrame],
    names=DEFAULT_LAYERS,
    planned: dict[str, bool] | None = None,
    decommissioned: dict[str, bool] | None = None,
) -> DataFrame:
    """Union of the chosen layers, each after its own status filter; records of different sources that
    describe the same facility all stay. No names means no rows."""
    planned, decommissioned = planned or {}, decommissioned or {}
    chosen = []
    for name, df in layers.items():
        if name in STATUS_LAYERS and "status" in df.columns:
            df = status_filter(df, planned.get(name, True), decommissioned.get(name, False))
        df = df.withColumn("layer", F.lit(name))
        chosen.append(df if name in names else df.where(F.lit(False)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chosen)
