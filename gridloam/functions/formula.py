"""The feasibility index: headroom, available capacity, realistic queue, ratio and category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloam.functions.vocabulary import CATEGORY_LONG_FORM, PRESSURE_LABEL, lookup


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_zero(c) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0)) if c is not None else F.lit(0.0)


def headroom(installed_mw, peak_demand_mw) -> Column:
    return _col(installed_mw) - _col(peak_demand_mw)


def available_capacity(headroom_mw, substation_bonus=None, transmission_penalty=None, water_penalty=None) -> Column:
    """Headroom plus bonus less penalties. Their sizes are inputs; absent ones count as zero."""
    return _col(headroom_mw) + _or_zero(substation_bonus) - _or_zero(transmission_penalty) - _or_zero(water_penalty)


def realistic_queue(announced_mw, completion_rate, discount=None) -> Column:
    """Announced capacity times one less the completion rate, times an explicit multiplier (1 if absent)."""
    factor = F.lit(1.0) if discount is None else F.coalesce(_col(discount).cast("double"), F.lit(1.0))
    return _col(announced_mw) * (F.lit(1.0) - _col(completion_rate)) * factor


def feasibility_ratio(available_mw, queue_mw) -> Column:
    """NULL without queue pressure; such rows belong in the reject output."""
    return F.try_divide(_col(available_mw), _col(queue_mw))


def ratio_category(ratio) -> Column:
    r = _col(ratio)
    return (
        F.when(r >= 2.0, "high_feasibility")
        .when(r >= 1.0, "moderate_feasibility")
        .when(r >= 0.5, "low_feasibility")
        .when(r.isNotNull(), "critical_constraint")
    )


def feasibility_category(ratio, is_hotspot) -> Column:
    """Category by ratio; a hotspot is one whatever its ratio."""
    hot = F.coalesce(_col(is_hotspot), F.lit(False))
    return F.when(hot, "dc_hotspot").otherwise(ratio_category(ratio))


def canonical_category(category) -> Column:
    """Long category name; short ones are translated and unknown ones kept for the domain check."""
    return lookup(category, CATEGORY_LONG_FORM, _col(category))


def pressure_label(category) -> Column:
    return lookup(canonical_category(category), PRESSURE_LABEL)


# --- fixed values: fields of the nested components, in their groups
HEADROOM_FIELDS = ["headroom_mw", "summer_cap_mw", "net_gen_mwh", "peak_demand_mw"]
QUEUE_MW_FIELDS = ["q_total_mw", "q_realistic_mw", "q_solar_mw", "q_battery_mw", "q_wind_mw", "q_gas_mw", "completion_rate_pct"]
SUBSTATION_FIELDS = ["sub_critical", "sub_high", "sub_throughput"]


def build_components(get, as_double=None, as_int=None, as_bool=None) -> Column:
    """Nest flat properties. `get(name)` gives a property's column; the casts default to plain ones."""
    double = as_double or (lambda c, _: c.cast("double"))
    whole = as_int or (lambda c, _: c.cast("int"))
    flag = as_bool or (lambda c, _: c.cast("boolean"))

    def group(cast, names) -> list[Column]:
        return [cast(get(n), n).alias(n) for n in names]

    return F.struct(
        flag(get("is_dc_hotspot"), "is_dc_hotspot").alias("is_dc_hotspot"),
        F.struct(*group(double, HEADROOM_FIELDS)).alias("headroom"),
        F.struct(*group(whole, ["q_projects"]), *group(double, QUEUE_MW_FIELDS)).alias("queue"),
        F.struct(*group(whole, SUBSTATION_FIELDS)).alias("substations"),
        whole(get("feasibility_score"), "feasibility_score").alias("feasibility_score"),
    )


def flatten_components(components="components") -> list[Column]:
    """The three measures a map shows, zero where the nested value is missing."""
    c = _col(components)
    return [
        F.coalesce(c["headroom"]["headroom_mw"], F.lit(0.0)).alias("headroom_mw"),
        F.coalesce(c["headroom"]["peak_demand_mw"], F.lit(0.0)).alias("peak_demand_mw"),
        F.coalesce(c["queue"]["q_realistic_mw"], F.lit(0.0)).alias("q_realistic_mw"),
    ]
