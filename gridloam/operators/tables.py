"""Table changes: last row per key, upsert, snapshots, references and removals."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloam.functions.geometry import centroid
from gridloam.functions.text import natural_id
from gridloam.operators.skew import SMALL_SIDE_ROWS, fits_broadcast, lookup_join


def _key_is_null(keys: list[str]) -> Column:
    absent = F.lit(False)
    for k in keys:
        absent = absent | F.col(k).isNull()
    return absent


def _latest(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The last row per key. A rank filter on row_number lets Spark keep one row per key inside each map
    task before the shuffle, so a key held by many rows costs one row per task."""
    descending = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    window = Window.partitionBy(*keys).orderBy(*descending)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The last row per key in the given order; rows with a NULL in the key are all kept."""
    absent = _key_is_null(keys)
    return _latest(df.where(~absent), keys, order).unionByName(df.where(absent))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    replace: list[str],
    keep: list[str] = (),
    order: list[str] = ("row_idx",),
    small_rows: int = SMALL_SIDE_ROWS,
) -> DataFrame:
    """Insert batch rows or update the target row with the same key.

    `replace` columns take the batch value even when it is NULL; `keep` columns keep the target's value on
    a match. Within the batch the last row per key wins. Keys are unique in the target, as its constraint
    demands, and a NULL in a key never matches.

    A batch measured to be small is broadcast, and the target is then rewritten in place without a shuffle;
    otherwise both sides meet in one full outer join, in which no key can be hot.
    """
    keys, replace, keep = list(keys), list(replace), list(keep)
    columns = target.columns
    missing = set(columns) - set(keys) - set(replace) - set(keep)
    if missing:
        raise ValueError(f"columns neither replaced nor kept: {sorted(missing)}")
    absent = _key_is_null(keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    aligned = [(F.col(c) if c in batch.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns]

    loose = target.where(absent).unionByName(batch.where(absent).select(*aligned))
    old, new = target.where(~absent), batch.where(~absent)
    lacking = [o for o in order if o not in batch.columns]
    if lacking:
        raise ValueError(f"the batch lacks the columns that say which row of a key is the last: {lacking}")
    new = _latest(new, keys, order)
    # The batch is measured and then joined more than once; its cached parts are worked out again if lost.
    new = new.select(*aligned).persist(StorageLevel.MEMORY_AND_DISK)
    incoming = new.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_new"))

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in replace:
            return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        return F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)

    existing = old.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_old"))
    if fits_broadcast(new, small_rows):
        updated = existing.join(F.broadcast(incoming), keys, "left").select(*[merged(c) for c in columns])
        # Target keys are unique, so the matched keys are at most as many as the batch rows just counted.
        matched = old.select(*keys).join(F.broadcast(new.select(*keys)), keys, "left_semi")
        inserted = new.join(F.broadcast(matched), keys, "left_anti").select(*columns)
        combined = updated.unionByName(inserted)
    else:
        combined = existing.join(incoming, keys, "full").select(*[merged(c) for c in columns])
    return combined.unionByName(loose)


def merged_once(target: DataFrame | None, batch: DataFrame, keys: list[str], replace: list[str], keep: list[str], order: list[str]) -> DataFrame:
    """As `upsert`, reading the target once, with `_stored` and `_arrived` saying where each row came from.

    One full outer join; rows with a NULL in the key match nothing and are spread by a hash of themselves. Without a
    target all rows are new.
    """
    columns = [*keys, *replace, *keep]
    lacking = [o for o in order if o not in batch.columns]
    if lacking:
        raise ValueError(f"the batch lacks the columns that say which row of a key is the last: {lacking}")
    absent = _key_is_null(keys)
    new = _latest(batch.where(~absent), keys, order).unionByName(batch.where(absent))
    if target is None:
        flat = [(F.col(c) if c in batch.columns else F.lit(None)).alias(c) for c in columns]
        return new.select(*flat, F.lit(False).alias("_stored"), F.lit(True).alias("_arrived"))
    types = {f.name: f.dataType for f in target.schema.fields}
    new = new.select(*((F.col(c) if c in batch.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns))
    salt = F.when(absent, F.xxhash64(*keys, F.monotonically_increasing_id())).otherwise(F.lit(0))

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = F.struct(*(c for c in columns if c not in keys))
        return df.select(*keys, salt.alias("_salt"), rest.alias(name))

    both = side(target, "_old").join(side(new, "_new"), [*keys, "_salt"], "full")
    stored, arrived = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    from_batch = {c: arrived if c in replace else arrived & ~stored for c in columns if c not in keys}
    values = [F.when(rule, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c, rule in from_batch.items()]
    return both.select(*keys, *values, stored.alias("_stored"), arrived.alias("_arrived")).select(*columns, "_stored", "_arrived")


# --- fixed values: key, replaced and kept columns of the stored tables
TABLE_RULES = {
    "regions": {
        "keys": ["country_code", "admin_level", "admin_code"],
        "replace": ["name", "geometry", "centroid", "updated_at"],
        "keep": ["id", "parent_region_id", "created_at"],
    },
    "osm": {
        "keys": ["source", "source_id"],
        "replace": ["name", "operator", "geometry", "raw_tags", "source_version", "ingested_at"],
        "keep": ["id", "license"],
    },
    "clusters": {
        "keys": ["source", "source_id", "source_version"],
        "replace": [
            "name", "owner", "country", "status", "certainty", "power_capacity_mw", "h100_equivalent", "ops_total",
            "geometry", "has_geometry", "geocoding_precision", "citation", "raw_attributes", "ingested_at",
        ],
        "keep": ["id", "license"],
    },
    "frontier": {
        "keys": ["source", "source_id", "source_version"],
        "replace": [
            "name", "owner", "country", "status", "power_capacity_mw", "h100_equivalent", "ops_total", "build_start",
            "expected_operational", "geometry", "has_geometry", "citation", "raw_attributes", "ingested_at",
        ],
        "keep": ["id", "license"],
    },
}


def upsert_table(name: str, target: DataFrame, batch: DataFrame, **options) -> DataFrame:
    return upsert(target, batch, **TABLE_RULES[name], **options)


def region_rows(batch: DataFrame, at: Column, run_id: str = "") -> DataFrame:
    """Regions as stored, without their parent. Where a part of the key is NULL the id follows from run and position."""
    keys = TABLE_RULES["regions"]["keys"]
    return batch.withColumns(
        {
            "id": natural_id(*keys, distinguish=(F.lit(run_id), F.col("row_idx"))),
            "centroid": centroid("geometry"),
            "created_at": at,
            "updated_at": at,
        }
    )


def upsert_regions(target: DataFrame, batch: DataFrame, at: Column, run_id: str = "", **options) -> DataFrame:
    """Regions by (country, level, code): replaces name and geometry and works the centroid out again.

    `batch` needs name, country_code, admin_level, admin_code, geometry and row_idx.
    """
    return upsert_table("regions", target, region_rows(batch, at, run_id), **options)


def resolve_region_id(rows: DataFrame, regions: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the region id to rows that carry the region's natural key."""
    keys = TABLE_RULES["regions"]["keys"]
    return lookup_join(rows, regions.select(*keys, F.col("id").alias("region_id")), keys, how)


# ---------------------------------------------------------------- snapshots

SNAPSHOT_KEYS = ["region_id", "methodology_version", "computed_at"]


def snapshot_rows(batch: DataFrame, version: str, computed_at: datetime) -> DataFrame:
    """Stamp a batch of index values with its methodology version and the one timestamp of the run."""
    stamped = batch.withColumns({"methodology_version": F.lit(version), "computed_at": F.lit(computed_at)})
    # The instant itself is hashed, not its text, which would follow the session's time zone.
    return stamped.withColumn("id", natural_id("region_id", "methodology_version", F.unix_micros("computed_at")))


def append_snapshot(existing: DataFrame | None, batch: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """Batch rows fit to be appended. A key held twice, or already stored, fails the run, and so does an
    unregistered methodology version."""
    repeated = batch.groupBy(*SNAPSHOT_KEYS).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"duplicate snapshot key in batch: {repeated.first().asDict()}")
    if existing is not None:
        # One timestamp per run is the rule; the batch's span narrows the stored rows to compare with.
        span = batch.agg(F.min("computed_at").alias("low"), F.max("computed_at").alias("high")).first()
        stored = existing.where(F.col("computed_at").between(span["low"], span["high"]))
        clash = batch.select(*SNAPSHOT_KEYS).join(stored.select(*SNAPSHOT_KEYS), SNAPSHOT_KEYS, "left_semi")
        if not clash.isEmpty():
            raise ValueError(f"snapshot already stored: {clash.first().asDict()}")
    if versions is not None:
        orphan = check_reference(batch, "methodology_version", versions, "version")
        if not orphan.isEmpty():
            raise ValueError("snapshot names an unregistered methodology version")
    return batch


def write_snapshot(batch: DataFrame, path: str) -> None:
    """Append to the stored history, laid out by version and run date so that reads prune to what they ask."""
    dated = batch.withColumn("run_date", F.to_date("computed_at"))
    dated.write.mode("append").partitionBy("methodology_version", "run_date").parquet(path)


def register_methodology(versions: DataFrame, version: str, description: str, published_at: datetime, url: str | None = None) -> DataFrame:
    """Add a methodology version; a version already there fails the run."""
    if not versions.where(F.col("version") == version).isEmpty():
        raise ValueError(f"methodology version already registered: {version}")
    row = versions.sparkSession.range(1).select(
        F.lit(version).alias("version"),
        F.lit(description).alias("description"),
        F.lit(published_at).alias("published_at"),
        F.lit(url).cast("string").alias("methodology_url"),
    )
    return versions.unionByName(row)


# ---------------------------------------------------------------- references and removals

def check_reference(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent; a NULL key refers to nothing and passes."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return lookup_join(child.where(F.col(child_key).isNotNull()), known, [child_key], "left_anti")


def clear_reference(child: DataFrame, child_key: str, removed: DataFrame, removed_key: str = "id") -> DataFrame:
    """Set the key to NULL in child rows that refer to a removed row."""
    gone = removed.select(F.col(removed_key).alias(child_key)).distinct().withColumn("_gone", F.lit(True))
    marked = lookup_join(child, gone, [child_key], "left")
    kept = F.when(F.col("_gone").isNull(), F.col(child_key))
    return marked.withColumn(child_key, kept).select(*child.columns)


def cascade_delete(child: DataFrame, child_key: str, removed: DataFrame, removed_key: str = "id") -> DataFrame:
    """Drop child rows that refer to a removed row."""
    gone = removed.select(F.col(removed_key).alias(child_key)).distinct()
    return lookup_join(child, gone, [child_key], "left_anti").select(*child.columns)


# --- fixed values: what removing a region does to the tables that refer to it
REGION_CHILDREN = {
    "substations": ("region_id", clear_reference),
    "power_plants": ("region_id", clear_reference),
    "announcements": ("region_id", clear_reference),
    "grid_feasibility": ("region_id", cascade_delete),
}


def remove_regions(regions: DataFrame, removed: DataFrame, children: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables after regions are removed. Region arrays of lines carry no reference and stay."""
    left = lookup_join(regions, removed.select("id").distinct(), ["id"], "left_anti").select(*regions.columns)
    if "parent_region_id" in regions.columns:
        left = clear_reference(left, "parent_region_id", removed)
    out = {"regions": left}
    for name, df in children.items():
        if name in REGION_CHILDREN:
            key, effect = REGION_CHILDREN[name]
            df = effect(df, key, removed)
        out[name] = df
    return out


def remove_methodology(versions: DataFrame, snapshots: DataFrame, version: str) -> DataFrame:
    """Versions without the given one; a version in use cannot be removed."""
    if not snapshots.where(F.col("methodology_version") == version).isEmpty():
        raise ValueError(f"methodology version in use: {version}")
    return versions.where(F.col("version") != version)
