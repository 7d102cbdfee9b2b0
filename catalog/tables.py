"""The given tables and the geography derived from their keys.

Coordinates are multiples of a quarter, so boundary cases are exact in floating point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloam.functions.geometry import point, polygon


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(key: str) -> tuple[Column, Column]:
    """Coordinates of a key."""
    k = F.col(key)
    return F.lit(-80.0) + ((k * 37) % 81) / F.lit(4.0), F.lit(30.0) + ((k * 53) % 79) / F.lit(4.0)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = place("c_custkey")
    return table(spark, sf_dir, "customer").withColumn("geometry", point(x, y))


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = place("c_custkey")
    k = F.col("c_custkey")
    far = point(x + ((k * 7) % 33) / F.lit(4.0) - 4, y + ((k * 17) % 31) / F.lit(4.0) - 4)
    return table(spark, sf_dir, "customer").select("c_custkey", F.array(point(x, y), far).alias("geometry"))


def rectangle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return polygon(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2))


def region_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level 1: one rectangle per row of `region`."""
    r = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        (F.lit(1000) + r).alias("id"),
        F.col("r_name").alias("name"),
        F.lit(1).alias("admin_level"),
        rectangle(F.lit(-80.0) + r * 4, F.lit(30.0), F.lit(-76.0) + r * 4, F.lit(50.0)).alias("geometry"),
    )


def nation_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level 2: one diamond of radius 2 per row of `nation`, inside the rectangle of its region."""
    n = F.col("n_nationkey")
    cx, cy = F.lit(-78.0) + (n % 5) * 4, F.lit(32.0) + F.floor(n / 5) * 4
    return table(spark, sf_dir, "nation").select(
        (F.lit(2000) + n).alias("id"),
        F.col("n_name").alias("name"),
        F.lit(2).alias("admin_level"),
        polygon(point(cx + 2, cy), point(cx, cy + 2), point(cx - 2, cy), point(cx, cy - 2)).alias("geometry"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_areas(spark, sf_dir).unionByName(nation_areas(spark, sf_dir))


def supplier_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level 3: one service rectangle per supplier, so that the region side grows with the data too.

    Widths and heights run from 1/4 to 9/4; many overlap and, with enough suppliers, many coincide.
    """
    x, y = place("s_suppkey")
    k = F.col("s_suppkey")
    w, h = (k % 9 + 1) / F.lit(4.0), (k % 7 + 1) / F.lit(4.0)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lit(3).alias("admin_level"),
        rectangle(x, y, x + w, y + h).alias("geometry"),
    )
