"""Aggregates per region, category and layer. All have partial counts or sums before their one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloam.operators.skew import lookup_join

MEGAWATTS = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_summary(df: DataFrame, category_col: str = "category") -> DataFrame:
    return df.groupBy(category_col).agg(F.count(F.lit(1)).alias("n")).orderBy(category_col)


def geometry_coverage(layers: dict[str, DataFrame]) -> DataFrame:
    """Spatial and non-spatial row counts per layer."""
    out = None
    for name, df in layers.items():
        counts = df.groupBy("has_geometry").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "has_geometry", "n")
        out = counts if out is None else out.unionByName(counts)
    return out


def queue_rollup(projects: DataFrame, region_col="region_id", mw="capacity_mw", fuel="fuel_type", fuels=("solar", "battery", "wind", "gas")) -> DataFrame:
    """Queued projects per region: count, total and per-fuel megawatts, summed as decimals."""
    amount = _col(mw).cast(MEGAWATTS)
    kind = _col(fuel)
    sums = [F.coalesce(F.sum(F.when(kind == f, amount)), F.lit(0).cast(MEGAWATTS)).cast("double").alias(f"q_{f}_mw") for f in fuels]
    return (
        projects.where(_col(region_col).isNotNull())
        .groupBy(region_col)
        .agg(F.count(F.lit(1)).cast("int").alias("q_projects"), F.sum(amount).cast("double").alias("q_total_mw"), *sums)
    )


def plant_capacity(plants: DataFrame, region_col="region_id", mw="capacity_mw", by: tuple[str, ...] = ()) -> DataFrame:
    """Installed megawatts per region, optionally also by fuel and status."""
    located = plants.where(_col(region_col).isNotNull())
    return located.groupBy(region_col, *by).agg(F.sum(_col(mw).cast(MEGAWATTS)).cast("double").alias("installed_mw"))


def substation_counts(substations: DataFrame, critical: Column, high: Column, throughput: Column, region_col="region_id") -> DataFrame:
    """Substations per region by class. What counts as each class is the caller's rule."""
    return (
        substations.where(_col(region_col).isNotNull())
        .groupBy(region_col)
        .agg(
            F.count_if(critical).cast("int").alias("sub_critical"),
            F.count_if(high).cast("int").alias("sub_high"),
            F.count_if(throughput).cast("int").alias("sub_throughput"),
        )
    )


def allocate_by_weight(df: DataFrame, group_col: str, total_col: str, weight_col: str, out_col: str = "allocated") -> DataFrame:
    """Split each group's total over its rows by weight.

    The weights are summed with partial sums and joined back, so a group with very many rows is never
    gathered in one task the way a window over it would.
    """
    sums = df.groupBy(group_col).agg(F.sum(weight_col).alias("_weights"))
    shared = lookup_join(df, sums, [group_col], "left")
    return shared.withColumn(out_col, F.try_divide(F.col(total_col) * F.col(weight_col), F.col("_weights"))).drop("_weights")
