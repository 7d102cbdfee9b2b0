"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITION_BYTES = 200_000_000
FEWEST_PARTITIONS, UNKNOWN_INPUT, MOST_PARTITIONS = 200, 5_000, 100_000


def build_session(app: str = "gridloam", master: str | None = None, shuffle_partitions: int | None = None, input_bytes: int | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave `master` and `shuffle_partitions` unset: spark-submit names the master and adaptive
    execution sizes the shuffles. It only merges shuffle partitions, so it starts from enough of them for some 200 MB
    each of `input_bytes`, the size of the largest input; from `UNKNOWN_INPUT` partitions if that is not given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif not (master or "").startswith("local"):
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions(input_bytes)))
    return builder.getOrCreate()


def initial_partitions(input_bytes: int | None) -> int:
    """Shuffle partitions to start from: one for 200 MB, within bounds that keep the bookkeeping small."""
    if input_bytes is None:
        return UNKNOWN_INPUT
    return min(max(-(-input_bytes // PARTITION_BYTES), FEWEST_PARTITIONS), MOST_PARTITIONS)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by `spark.checkpoint.dir`.

    Only where that is unset and the session runs on one machine, as in tests, a local folder is made, recorded in
    its place and removed when Python ends. Elsewhere executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("gridloam.scratch", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gridloam-", dir="/tmp")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("gridloam.scratch", folder)
    return folder.rstrip("/")


_inner: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, or below that of the innermost `scratch`; no two calls share one."""
    return f"{_inner[-1] if _inner else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, wherever the shared folder is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession, name: str = "scratch") -> Iterator[str]:
    """What is written to new paths inside goes below one folder, removed at the end. Results to keep are written to a
    path taken before."""
    folder = fresh_path(spark, name)
    _inner.append(folder)
    try:
        yield folder
    finally:
        _inner.remove(folder)
        remove(spark, folder)


def written(df, name: str):
    """`df` written once to the shared folder and read back: a lineage cut that outlives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
