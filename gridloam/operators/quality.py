"""Checks that split or count rows: domains, keys, geometry and load metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloam.functions import vocabulary as v


def missing(name: str) -> Column:
    return F.col(name).isNull()


def outside(name: str, allowed: list) -> Column:
    """Present but not an allowed value; NULL passes, as it does in a check constraint."""
    return F.col(name).isNotNull() & ~F.col(name).isin(allowed)


def out_of_range(name: str, low, high) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).between(low, high)


def _required(*names: str) -> dict[str, Column]:
    return {f"{n} is null": missing(n) for n in names}


def domain_rules(table: str) -> dict[str, Column]:
    """Violations to look for in a stored table, by name."""
    if table == "regions":
        return _required("name", "country_code", "admin_level", "geometry") | {
            "admin_level": outside("admin_level", v.ADMIN_LEVEL)
        }
    if table == "substations":
        return _required("geometry", "source") | {"dc_relevance": out_of_range("dc_relevance", 1, 4)}
    if table == "powerlines":
        return _required("geometry", "source") | {"dc_relevance": out_of_range("dc_relevance", 1, 6)}
    if table == "power_plants":
        return _required("geometry", "source") | {"status": outside("status", v.PLANT_STATUS)}
    if table == "announcements":
        return _required("project_name", "status") | {"status": outside("status", v.ANNOUNCEMENT_STATUS)}
    if table == "grid_feasibility":
        return _required("region_id", "methodology_version", "computed_at", "value", "category", "components") | {
            "category": outside("category", v.CATEGORY)
        }
    if table == "methodology_versions":
        return _required("version", "description", "published_at")
    if table == "datacenters_osm":
        return _required("source", "source_id", "geometry", "source_version", "license")
    if table == "datacenters_clusters":
        return _required("source", "source_id", "status", "source_version", "license") | {
            "status": outside("status", v.DC_STATUS),
            "geocoding_precision": outside("geocoding_precision", v.GEOCODING_PRECISION),
        }
    if table == "datacenters_frontier":
        return _required("source", "source_id", "status", "source_version", "license") | {
            "status": outside("status", v.DC_STATUS)
        }
    raise ValueError(f"no rules for table: {table}")


def check_domain(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, rejected rows with the names of the rules they break)."""
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    flagged = df.withColumn("violations", broken)
    return flagged.where(F.size("violations") == 0).drop("violations"), flagged.where(F.size("violations") > 0)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the count. A key with a NULL in it never collides."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def drop_null_geometry(df: DataFrame, geometry_col: str = "geometry") -> tuple[DataFrame, Observation]:
    """Rows with a geometry, and the count of those without, known once the rows have been written."""
    seen = Observation()
    counted = df.observe(seen, F.count_if(F.col(geometry_col).isNull()).alias("dropped"))
    return counted.where(F.col(geometry_col).isNotNull()), seen


def reject_missing_id(df: DataFrame, id_col: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rows without one)."""
    return df.where(F.col(id_col).isNotNull()), df.where(F.col(id_col).isNull())


def load_metrics(df: DataFrame, written: Column) -> tuple[DataFrame, Observation]:
    """Counts of rows read, written and skipped, taken while the rows pass through; no second scan."""
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(written).alias("written"),
        F.count_if(~written).alias("skipped"),
    )
    return counted, seen
