"""From located plants and queue projects to index snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloam.functions import formula
from gridloam.operators.tables import snapshot_rows


def index_inputs(capacity: DataFrame, queue: DataFrame, demand: DataFrame, substations: DataFrame | None = None) -> DataFrame:
    """Per-region inputs side by side. Each side has one row per region, so the joins cannot fan out."""
    out = capacity.join(queue, "region_id", "full").join(demand, "region_id", "left")
    if substations is not None:
        out = out.join(substations, "region_id", "left")
    zero = {c: 0 for c, t in out.dtypes if c != "region_id" and t in ("double", "int", "bigint")}
    return out.na.fill(zero)


def index_values(
    inputs: DataFrame,
    completion_rate: Column,
    discount: Column | None = None,
    substation_bonus: Column | None = None,
    transmission_penalty: Column | None = None,
    water_penalty: Column | None = None,
    is_hotspot: Column | None = None,
) -> DataFrame:
    """Add headroom, available capacity, realistic queue, ratio and both categories."""
    out = inputs.withColumns(
        {
            "headroom_mw": formula.headroom("installed_mw", "peak_demand_mw"),
            "q_realistic_mw": formula.realistic_queue("q_total_mw", completion_rate, discount),
            "is_dc_hotspot": F.coalesce(is_hotspot, F.lit(False)) if is_hotspot is not None else F.lit(False),
        }
    )
    out = out.withColumn(
        "available_mw", formula.available_capacity("headroom_mw", substation_bonus, transmission_penalty, water_penalty)
    )
    out = out.withColumn("value", formula.feasibility_ratio("available_mw", "q_realistic_mw"))
    return out.withColumns(
        {
            "ratio_category": formula.ratio_category("value"),
            "category": formula.feasibility_category("value", "is_dc_hotspot"),
        }
    )


def accept_values(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a ratio, rows without one because nothing is queued)."""
    return values.where(F.col("value").isNotNull()), values.where(F.col("value").isNull())


def snapshots_of(values: DataFrame, version: str, at: datetime) -> DataFrame:
    """Accepted values as snapshot rows with nested components; measures not worked out are NULL."""
    def get(name: str) -> Column:
        return F.col(name) if name in values.columns else F.lit(None)

    rows = values.select("region_id", "value", "category", formula.build_components(get).alias("components"))
    return snapshot_rows(rows, version, at)
