"""Whole loads into stored tables: check, upsert or append, commit. A load that breaks a rule leaves every table as it was."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridloam.operators.quality import check_unique, domain_rules
from gridloam.operators.tables import SNAPSHOT_KEYS, TABLE_RULES, check_reference, region_rows
from gridloam.plans.loads import index_values
from gridloam.session import written
from gridloam.sources.parted import Change, Store

#: Versions of these tables live side by side, so a load of one leaves the others' parts alone.
LAID_OUT_BY = {"clusters": ["source_version"], "frontier": ["source_version"], "osm": []}


def _seen(batch: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The batch, with its rows and those that break a rule of the table counted as it is written."""
    read, rules = Observation(), domain_rules(table)
    broken = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    return batch.observe(read, F.count(F.lit(1)).alias("rows read"), *broken), read


def _accept(table: str, read: Observation) -> None:
    broken = sorted(name for name, n in read.get.items() if name != "rows read" and n)
    if broken:
        raise ValueError(f"{table}: rows break the rules {broken}")


def _unique(keys: dict[str, list[str]]):
    def check(change: Change) -> None:
        if not check_unique(change.rows, keys[change.table]).isEmpty():
            raise ValueError(f"{change.table}: a key is held twice")

    return check


def store_rows(name: str, store: Store, batch: DataFrame, rejected: DataFrame | None = None, statuses: Observation | None = None, buckets: int = 64) -> dict[str, int]:
    """Upsert a batch of `osm`, `clusters` or `frontier` rows into the table of that name and commit it.

    Returns the number of rows read, written (one per key) and rejected, and of rows now stored; with what
    `with_status_count` gives for `statuses` also that of unrecognised ones. Only the parts of the table that the batch's
    keys fall into are read and written.
    """
    rules, table = TABLE_RULES[name], f"datacenters_{name}"
    seen, read = _seen(batch, table)
    change = store.upsert(name, seen, **rules, by=LAID_OUT_BY[name], buckets=buckets, accept=lambda _: _accept(table, read))
    store.commit(change, check=_unique({name: rules["keys"]}))
    lost = rejected.count() if rejected is not None else 0
    counts = {"read": read.get["rows read"] + lost, "written": change.counts["batch"], "rejected": lost, "stored": store.count(name)}
    return counts if statuses is None else counts | statuses.get


def store_regions(store: Store, batch: DataFrame, at, run_id: str = "", buckets: int = 64) -> Change:
    """The change that upserts regions; see `operators.tables.upsert_regions`."""
    rules = TABLE_RULES["regions"]
    rows = region_rows(batch, at, run_id).withColumn("parent_region_id", F.lit(None).cast("string"))
    seen, read = _seen(rows, "regions")
    return store.upsert("regions", seen, **rules, buckets=buckets, accept=lambda _: _accept("regions", read))


def store_feasibility(features: DataFrame, store: Store, versions: DataFrame, version: str, at: datetime, buckets: int = 64) -> dict[str, int]:
    """Upsert the regions of a feature set, append its index values to the history and bring the current values up to
    date, in one commit: a failure on the way, such as a value of an unknown category, a key held twice or an unregistered
    version, leaves regions, history and current values as they were.

    The history grows by the batch alone, and only the parts of regions and current values that the batch falls into are
    read and written.
    """
    features = written(features, "features")
    regions = store_regions(store, features.select("row_idx", "name", "country_code", "admin_level", "admin_code", "geometry"), F.lit(at), buckets=buckets)
    # Every value's region came with it, so it is among the parts just written.
    stamped = index_values(features, regions.rows, version, at)
    seen, read = _seen(stamped, "grid_feasibility")
    fresh = written(seen, "values")
    _accept("grid_feasibility", read)
    if not check_reference(fresh, "methodology_version", versions, "version").isEmpty():
        raise ValueError("snapshot names an unregistered methodology version")
    if store.has("grid_feasibility"):
        clash = store.clashes("grid_feasibility", fresh, SNAPSHOT_KEYS, "computed_at").first()
        if clash is not None:
            raise ValueError(f"snapshot already stored: {clash.asDict()}")
    history = store.append("grid_feasibility", fresh, "computed_at")
    current = store.latest("current_feasibility", fresh, ["region_id", "methodology_version"], "computed_at", buckets=buckets)
    keys = {"regions": TABLE_RULES["regions"]["keys"], "grid_feasibility": SNAPSHOT_KEYS, "current_feasibility": SNAPSHOT_KEYS}
    store.commit(regions, history, current, check=_unique(keys))
    return {"regions": store.count("regions"), "appended": read.get["rows read"]}
