"""Snapshot history: the latest row per key and time-ordered reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def current_snapshot(snapshots: DataFrame, keys=("region_id", "methodology_version"), at: str = "computed_at") -> DataFrame:
    """The latest row per key with all its columns.

    The rank filter is applied per map task before the shuffle, so long histories send one row per key and
    task. NULL keys form a group of their own, as they do in a distinct-on.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_first())
    return snapshots.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def history(
    snapshots: DataFrame,
    region_id=None,
    start: datetime | None = None,
    end: datetime | None = None,
    region_col: str = "region_id",
    at: str = "computed_at",
) -> DataFrame:
    """Snapshots of a region in [start, end], newest first. Over a stored history the run date prunes."""
    out = snapshots
    if region_id is not None:
        out = out.where(F.col(region_col) == region_id)
    if start is not None:
        out = out.where(F.col(at) >= F.lit(start))
    if end is not None:
        out = out.where(F.col(at) <= F.lit(end))
    if "run_date" in snapshots.columns:
        if start is not None:
            out = out.where(F.col("run_date") >= F.to_date(F.lit(start)))
        if end is not None:
            out = out.where(F.col("run_date") <= F.to_date(F.lit(end)))
    return out.orderBy(F.col(at).desc())
