"""One order over the rows of many files that many tasks read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloam.operators.skew import lookup_join
from gridloam.session import written


def numbered(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a file scan with `file`, `block` (where their split begins) and `place`, which grows within a split;
    written once, so that every later reading sees the same splits."""
    placed = rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return written(placed.withColumn("place", F.monotonically_increasing_id()), path)


def before_blocks(blocks: DataFrame, *sums: str) -> DataFrame:
    """`blocks` (a row per `file` and `block`) with each of the named columns replaced by its sum over the blocks before,
    in the order of file path and block."""
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(*(F.sum(c).alias(c) for c in sums))
    files = files.select("file", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in sums))
    own = blocks.select("file", "block", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in sums))
    return own.join(files, "file").select("file", "block", *((F.col(c) + F.col(f"_{c}")).alias(c) for c in sums))


def row_numbers(rows: DataFrame) -> DataFrame:
    """`numbered` rows with `row_idx`, counting from 0 through the files in the order of their paths, lines in theirs."""
    blocks = written(rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")), "blocks")
    starts = before_blocks(blocks, "n").join(blocks.select("file", "block", "first"), ["file", "block"])
    return lookup_join(rows, starts, ["file", "block"], "inner").withColumn("row_idx", F.col("n") + F.col("place") - F.col("first")).drop("n", "first")
