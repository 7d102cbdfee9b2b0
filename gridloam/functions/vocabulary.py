"""Names, lookups and labels that stored tables and their readers agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: allowed values of the coded columns
DC_STATUS = ["operational", "under_construction", "planned", "announced", "decommissioned", "unknown"]
PLANT_STATUS = ["operating", "construction", "pre-construction", "announced", "cancelled", "retired", "mothballed"]
ANNOUNCEMENT_STATUS = ["announced", "planned", "under_construction", "operational", "cancelled"]
GEOCODING_PRECISION = ["street_level", "city", "region", "country_centroid"]
CATEGORY = ["high_feasibility", "moderate_feasibility", "low_feasibility", "critical_constraint", "dc_hotspot"]
ADMIN_LEVEL = [1, 2]

# --- fixed values: short category names and the long ones they stand for
CATEGORY_LONG_FORM = {
    "high": "high_feasibility",
    "moderate": "moderate_feasibility",
    "low": "low_feasibility",
    "critical": "critical_constraint",
    "dc_hotspot": "dc_hotspot",
}

# --- fixed values: source spellings of a status
STATUS_SPELLINGS = {
    "operational": "operational",
    "in operation": "operational",
    "active": "operational",
    "existing": "operational",
    "under construction": "under_construction",
    "construction": "under_construction",
    "planned": "planned",
    "in planning": "planned",
    "announced": "announced",
    "decommissioned": "decommissioned",
    "retired": "decommissioned",
}

# --- fixed values: labels
CATEGORY_LABEL = {
    "high_feasibility": "High — grid headroom exceeds queue pressure",
    "moderate_feasibility": "Moderate — balanced",
    "low_feasibility": "Low — constrained",
    "critical_constraint": "Critical — severely constrained",
    "dc_hotspot": "DC Hotspot — local substation exhaustion",
}
STATUS_LABEL = {
    "operational": "Operational",
    "under_construction": "Under construction",
    "planned": "Planned",
    "announced": "Announced",
    "decommissioned": "Decommissioned",
    "unknown": "Status unknown",
}
PRESSURE_LABEL = {
    "high_feasibility": "low pressure",
    "moderate_feasibility": "moderate pressure",
    "low_feasibility": "high pressure",
    "critical_constraint": "severe pressure",
    "dc_hotspot": "existing concentration",
}

# --- fixed values: colours and weights
CATEGORY_COLOUR = {
    "high_feasibility": "#2ecc71",
    "moderate_feasibility": "#f1c40f",
    "low_feasibility": "#e67e22",
    "critical_constraint": "#e74c3c",
    "dc_hotspot": "#922b21",
}
OTHER_CATEGORY_COLOUR = "#cccccc"
STATUS_COLOUR = {
    "operational": "#2563eb",
    "under_construction": "#f59e0b",
    "planned": "#8b5cf6",
    "announced": "#c084fc",
    "decommissioned": "#6b7280",
    "unknown": "#94a3b8",
}
PRECISION_WEIGHT = {"street_level": 1.0, "city": 0.85, "region": 0.6, "country_centroid": 0.4}
OTHER_PRECISION_WEIGHT = 0.85

# --- fixed values: bubble size steps per layer, (from count, size)
BUBBLE_STEPS = {
    "osm": [(0, 12), (100, 16), (500, 20)],
    "clusters": [(0, 14), (50, 18), (200, 24)],
}

# --- fixed values: published completion rates and the regions on the hotspot list
COMPLETION_RATE = {"PJM": 0.197, "Norway": 0.40, "Gulf": 0.55}


def lookup(col, table: dict, default=None) -> Column:
    """Value of a small fixed table for a column; `default` may be a Column or a plain value."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    found = F.when(c.isNotNull(), F.try_element_at(pairs, c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
