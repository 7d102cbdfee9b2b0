"""Stored tables: column scans, all-or-nothing publishing and optional layers."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

_MANIFEST = "run_id string, version bigint, published_at timestamp, rows bigint, schema string"


def scan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Named columns only; unused ones are never read."""
    return spark.read.parquet(path).select(*columns)


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None, partition_by: tuple[str, ...] = ()) -> str:
    """Write a new version of a table so that readers see all of its rows or none.

    Rows go to a folder of their own, are read back and checked, and only then does one manifest row make
    the version current. A run that fails earlier leaves the manifest as it was. One writer at a time. The schema
    is kept in the manifest, so partition columns come back as what they were.
    """
    spark, run_id = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/runs/{run_id}"
    df.write.partitionBy(*partition_by).parquet(folder) if partition_by else df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    if check is not None:
        check(written)
    entry = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(_current(spark, path)["version"] + 1).cast("bigint").alias("version"),
        F.lit(datetime.now(timezone.utc)).alias("published_at"),
        F.lit(written.count()).alias("rows"),
        F.lit(df.schema.json()).alias("schema"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return run_id


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    latest = _current(spark, path)
    if latest["run_id"] is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return spark.read.schema(StructType.fromJson(json.loads(latest["schema"]))).parquet(f"{path}/runs/{latest['run_id']}")


def _current(spark: SparkSession, path: str) -> dict:
    """The manifest row of the highest version; version 0 and no run where nothing is published."""
    nothing = {"run_id": None, "version": 0, "schema": None}
    try:
        manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing
    row = manifest.agg(F.max(F.struct("version", "run_id", "schema")).alias("last")).first()["last"]
    return row.asDict() if row else nothing


def on_optional_missing(spark: SparkSession, read: Callable[[], DataFrame], schema: StructType | str) -> DataFrame:
    """An optional layer that is not there is an empty one, and a warning says so. Any other error is raised, such as
    that of a misspelt column. Required tables are read without this."""
    try:
        return read()
    except (AnalysisException, FileNotFoundError) as e:
        if isinstance(e, AnalysisException) and e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        log.warning("optional layer is missing and read as empty: %s", e)
        return spark.createDataFrame([], schema)
