"""Stored tables in parts, changed by rewriting only the parts a change touches.

A store holds tables. A table is a set of parts, folders of rows: one per key bucket (and per value of some key columns)
where rows are replaced, one per run where they are only added. A commit is a single file naming the parts it brings, of
one table or several; a part replaces the earlier one of the same key. Readers see the parts of all commits or none of
one, so tables changed together become current together, and rows not touched are neither read nor written again.
One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from gridloam.operators.tables import merged_once
from gridloam.session import written

_PART = "tab string, key string, folder string, rows bigint, low timestamp, high timestamp, schema string"
_COMMIT = f"version bigint, committed_at timestamp, {_PART}"
BUCKETS = 64
# Of rows kept in order, how much is skipped or read at once.
ROW_GROUP_BYTES = 1 << 20


@dataclass(frozen=True)
class Change:
    """Parts of one table that are written but not yet current, and counts made while writing."""

    table: str
    parts: DataFrame
    rows: DataFrame
    counts: dict[str, int]


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---------------------------------------------------------------- reading

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def version(self) -> int:
        return self._commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def parts(self, table: str, version: int | None = None) -> list[Row]:
        """The parts of a table, as of a version or now: a row per folder, so their number bounds what the driver holds."""
        seen = self._commits().where(F.col("tab") == table)
        if version is not None:
            seen = seen.where(F.col("version") <= version)
        last = seen.groupBy("key").agg(F.max(F.struct("version", "folder", "rows", "low", "high", "schema")).alias("p"))
        return last.select("key", "p.*").where("folder <> ''").orderBy("version", "key").collect()

    def count(self, table: str) -> int:
        """Rows of a table, from its commits alone."""
        return sum(p["rows"] for p in self.parts(table))

    def has(self, table: str) -> bool:
        return not self._commits().where(F.col("tab") == table).isEmpty()

    def read(self, table: str, parts: Iterable[Row] | None = None, version: int | None = None) -> DataFrame:
        """A table, or only the given ones of its parts."""
        chosen = self.parts(table, version) if parts is None else list(parts)
        if chosen:
            return self._read(table, chosen)
        last = self._commits().where(F.col("tab") == table).agg(F.max(F.struct("version", "schema")).alias("last")).first()["last"]
        if last is None:
            raise FileNotFoundError(f"no table {table} at {self.path}")
        return self.spark.createDataFrame([], StructType.fromJson(json.loads(last["schema"])))

    def _read(self, table: str, parts: list[Row]) -> DataFrame:
        schema = StructType.fromJson(json.loads(max(parts, key=lambda p: p["version"])["schema"]))
        hidden = StructType([*schema.fields, StructField("_bucket", IntegerType()), StructField("_run", StringType())])
        base = f"{self.path}/{table}"
        rows = self.spark.read.schema(hidden).option("basePath", base).parquet(*(f"{base}/{p['folder']}" for p in parts))
        return rows.select(*(f"`{n}`" for n in schema.names))

    def read_between(self, table: str, at: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Rows with `at` in [start, end] of a table written by `append`. Parts outside it are not opened."""
        parts = [p for p in self.parts(table) if _meets(p, start, end)]
        rows = self.read(table, parts)
        if start is not None:
            rows = rows.where(F.col(at) >= F.lit(start))
        if end is not None:
            rows = rows.where(F.col(at) <= F.lit(end))
        return rows

    # ---------------------------------------------------------------- writing

    def _write(self, table: str, rows: DataFrame, by: list[str], columns: list[str], counted: dict[str, Column] | None = None, at: str | None = None, group_bytes: int | None = None) -> Change:
        """Write rows below a run folder of their own, with `by` and `_bucket` (where there is one) as folders."""
        run, base = uuid.uuid4().hex, f"{self.path}/{table}"
        folders = [*by, *(["_bucket"] if "_bucket" in rows.columns else [])]
        schema = rows.select(*(f"`{c}`" for c in columns)).schema
        out = rows.select(*(f"`{c}`" for c in columns), *(["_bucket"] if "_bucket" in rows.columns else []))
        counts: dict[str, int] = {}
        if counted:
            # Counted before the columns that carry the tags are left out.
            seen = Observation()
            out = rows.observe(seen, *(c.alias(n) for n, c in counted.items())).select(out.columns)
        if folders:
            # Whole parts come to tasks together, and adaptive execution cuts the large ones again.
            out = out.hint("rebalance", *folders)
            out.write.partitionBy(*folders).parquet(f"{base}/_run={run}")
        else:
            writer = out.write if group_bytes is None else out.write.option("parquet.block.size", group_bytes).option("parquet.page.size", group_bytes // 8)
            writer.parquet(f"{base}/_run={run}")
        if counted:
            counts = {n: seen.get[n] for n in counted}
        hidden = StructType([*schema.fields, StructField("_bucket", IntegerType()), StructField("_run", StringType())])
        back = self.spark.read.schema(hidden).option("basePath", base).parquet(f"{base}/_run={run}")
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(_run=[^/]+(?:/[^/]+=[^/]*)*)/[^/]+\z", 1)
        key = F.to_json(F.struct(*folders)) if folders else F.lit(run)
        span = [F.min(at).cast("timestamp"), F.max(at).cast("timestamp")] if at else [F.lit(None).cast("timestamp")] * 2
        parts = back.groupBy(key.alias("key")).agg(F.min(folder).alias("folder"), F.count(F.lit(1)).alias("rows"), span[0].alias("low"), span[1].alias("high"))
        parts = parts.select(F.lit(table).alias("tab"), "key", "folder", "rows", "low", "high", F.lit(schema.json()).alias("schema"))
        # A row without a folder tells of the table itself, so that one without rows is known too.
        parts = parts.unionByName(self.spark.createDataFrame([(table, "", "", 0, None, None, schema.json())], _PART))
        return Change(table, parts, back.select(*(f"`{c}`" for c in columns)), counts)

    def _touched(self, table: str, arriving: DataFrame, by: list[str]) -> tuple[list[Row], DataFrame | None]:
        """The parts that arriving rows fall into, and their rows; None where the table is new or they are all new."""
        wanted = {r["key"] for r in arriving.select(F.to_json(F.struct(*by, "_bucket")).alias("key")).distinct().collect()}
        parts = [p for p in self.parts(table) if p["key"] in wanted]
        return parts, self._read(table, parts) if parts else None

    def _bucketed(self, table: str, rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def upsert(self, table: str, batch: DataFrame, keys: list[str], replace: list[str], keep: list[str] = (), order: list[str] = ("row_idx",), by: list[str] = (), buckets: int = BUCKETS, accept: Callable[[DataFrame], None] | None = None) -> Change:
        """`operators.tables.upsert` of a batch: only the parts its keys fall into are read, once, and written.

        `by` names key columns to lay parts out by, so that versions living side by side are apart; both it and the
        number of buckets stay as the table's first change had them. The batch is read once, into a copy that `accept` may
        refuse. Counts: `batch` (rows that arrived, one per key) and `new`.
        """
        by, keys = list(by), list(keys)
        if set(by) - set(keys):
            raise ValueError(f"parts can be laid out by key columns only: {sorted(set(by) - set(keys))}")
        arriving = written(self._bucketed(table, batch, keys, buckets), f"{table}-arriving")
        if accept is not None:
            accept(arriving)
        _, target = self._touched(table, arriving, by)
        columns = [*keys, *replace, *keep]
        if target is not None:
            target = target.select(*columns)
        merged = merged_once(target, arriving, keys, list(replace), list(keep), list(order))
        counted = {"batch": F.count_if("_arrived"), "new": F.count_if(F.col("_arrived") & ~F.col("_stored"))}
        return self._write(table, self._bucketed(table, merged, keys, buckets), by, columns, counted)

    def latest(self, table: str, batch: DataFrame, keys: list[str], at: str, by: list[str] = (), buckets: int = BUCKETS) -> Change:
        """Merge a run into a table of the latest row per key, whenever it arrives: an older run changes nothing that a
        newer one has written. Only the parts its keys fall into are read. Of rows of one key and instant the stored one
        stays. NULL keys form a group of their own."""
        by = list(by)
        arriving = written(self._bucketed(table, batch, list(keys), buckets).withColumn("_age", F.lit(1)), f"{table}-run")
        _, target = self._touched(table, arriving, by)
        rows = arriving
        if target is not None:
            rows = rows.unionByName(self._bucketed(table, target, list(keys), buckets).withColumn("_age", F.lit(0)))
        order = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), "_age")
        last = rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
        return self._write(table, last, by, batch.columns, {"changed": F.count_if(F.col("_age") == 1)})

    def replace(self, table: str, rows: DataFrame, touched: list[Row] = ()) -> Change:
        """Write rows with a column `_bucket` as the new parts of their buckets. Of the touched parts those that get no
        rows are gone."""
        columns = [c for c in rows.columns if c != "_bucket"]
        change = self._write(table, rows, [], columns)
        empty = self.spark.createDataFrame([(table, p["key"], "", 0, None, None, p["schema"]) for p in touched], _PART)
        left = empty.join(change.parts.select("key"), "key", "left_anti").select(*change.parts.columns)
        return Change(table, change.parts.unionByName(left), change.rows, {})

    def append(self, table: str, rows: DataFrame, at: str | None = None) -> Change:
        """Add rows as a part of their own, with the span of `at` they hold."""
        return self._write(table, rows, [], rows.columns, at=at)

    def append_sorted(self, table: str, rows: DataFrame, by: list[str]) -> Change:
        """Add rows in the order of `by`, ranges of it to files and small row groups, so that a reading for one value
        skips the rest by its statistics."""
        ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
        return self._write(table, ordered, [], rows.columns, group_bytes=ROW_GROUP_BYTES)

    def clashes(self, table: str, rows: DataFrame, keys: list[str], at: str) -> DataFrame:
        """Keys of `rows` that the table already holds. Only parts whose span of `at` (one of the keys) meets that of the
        rows are opened."""
        span = rows.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
        wanted = rows.select(*keys)
        parts = [] if span["low"] is None else [p for p in self.parts(table) if _meets(p, span["low"], span["high"])]
        return wanted.join(self._read(table, parts).select(*keys), keys, "left_semi") if parts else wanted.limit(0)

    def commit(self, *changes: Change, check: Callable[[Change], None] | None = None) -> int:
        """Make changes current, all together, by one file. `check` may refuse any of them before."""
        for change in changes:
            if check is not None:
                check(change)
        parts = changes[0].parts
        for change in changes[1:]:
            parts = parts.unionByName(change.parts)
        version = self.version() + 1
        rows = parts.select(F.lit(version).cast("bigint").alias("version"), F.lit(datetime.now(timezone.utc)).alias("committed_at"), "*")
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return version


def _meets(part: Row, start: datetime | None, end: datetime | None) -> bool:
    """Whether a part's span meets [start, end]; a part without one might."""
    early = end is not None and part["low"] is not None and part["low"] > _naive(end)
    late = start is not None and part["high"] is not None and part["high"] < _naive(start)
    return not (early or late)


def _naive(at: datetime) -> datetime:
    """As Spark hands timestamps to Python: in the machine's zone, without naming it."""
    return at.astimezone().replace(tzinfo=None) if at.tzinfo else at
