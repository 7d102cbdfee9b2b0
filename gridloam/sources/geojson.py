"""GeoJSON in and out."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloam.functions.geometry import encode_geometry
from gridloam.sources.order import numbered, row_numbers

log = logging.getLogger(__name__)

# Coordinates and properties stay JSON text here: their shape depends on the geometry type and the source.
_FEATURE = "struct<type:string,geometry:struct<type:string,coordinates:string>,properties:string>"
_LINE = "type string, geometry struct<type:string,coordinates:string>, properties string"
_COLLECTION = f"type string, crs struct<properties:struct<name:string>>, features array<{_FEATURE}>"


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """One row per FeatureCollection document. A document is read by one task; for large ones see
    `split_geojson.read_split_features`, and `read_feature_lines` for one feature per line."""
    return spark.read.schema(_COLLECTION).option("multiLine", True).json(path)


def read_features(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """One row per feature of a checked FeatureCollection: row_idx, geometry, properties."""
    return features_of(check_collection(read_collection(spark, path), expected))


def features_of(collection: DataFrame) -> DataFrame:
    """The features of each document with their position in it and the EPSG code the document names, if any."""
    exploded = collection.select(epsg_code(F.col("crs.properties.name")).alias("epsg"), F.posexplode("features").alias("row_idx", "f"))
    return exploded.select(F.col("row_idx").cast("bigint").alias("row_idx"), "f.geometry", "f.properties", "epsg")


def read_feature_lines(spark: SparkSession, path: str, index_property: str | None = None, rejects: bool = False):
    """One row per feature from files with one feature per line, split over many tasks.

    `row_idx` says which of two rows came later. It is the property named, which every feature must have as a whole
    number. Where none is named it counts the lines that are not blank, from 0 through the files in the order of their
    paths; the lines are then written once, so that all that follows sees them in the same splits.

    A line that is no feature fails the run when it is reached, and so does an input without lines. With `rejects`
    such lines are returned instead, as a second frame of `line` and `reason`; blank lines are neither.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    if lines.isEmpty():
        raise ValueError("input contains no features")
    if index_property is None:
        lines, index = row_numbers(numbered(lines, "lines")), F.col("row_idx")
    else:
        index = F.get_json_object("f.properties", f"$['{index_property}']").try_cast("bigint")
    parsed = lines.withColumn("f", F.from_json("value", _LINE))
    reason = (
        F.when(F.try_parse_json("value").isNull(), "no JSON")
        .when(F.coalesce(F.col("f.type"), F.lit("")) != "Feature", "not a Feature")
        .when(index.isNull(), "no position")
    )
    judged = parsed.withColumns({"row_idx": index, "reason": reason})
    if rejects:
        good = judged.where("reason IS NULL")
        return good.select("row_idx", "f.geometry", "f.properties"), judged.where("reason IS NOT NULL").select(F.col("value").alias("line"), "reason")
    refused = F.raise_error(F.concat(F.lit("bad line, "), "reason", F.lit(": "), F.substring("value", 1, 200))).cast("bigint")
    checked = judged.withColumn("row_idx", F.when(F.col("reason").isNull(), F.col("row_idx")).otherwise(refused))
    return checked.select("row_idx", "f.geometry", "f.properties")


def check_collection(collection: DataFrame, expected: int | None = None) -> DataFrame:
    """Refuse a wrong document type or an empty one; a count other than expected only warns."""
    seen = collection.agg(
        F.count_if(F.coalesce(F.col("type"), F.lit("")) != "FeatureCollection").alias("wrong"),
        F.coalesce(F.sum(F.greatest(F.size(F.coalesce("features", F.array())), F.lit(0))), F.lit(0)).alias("features"),
    ).first()
    if seen["wrong"]:
        raise ValueError("expected a FeatureCollection")
    if not seen["features"]:
        raise ValueError("collection contains no features")
    if expected is not None and seen["features"] != expected:
        log.warning("found %d features, expected %d", seen["features"], expected)
    return collection


def epsg_code(name):
    """EPSG code of a coordinate system's name. CRS84 is 4326 with the same axis order; an odd name fails the run."""
    code = F.regexp_extract(name, r":(\d+)$", 1).try_cast("int")
    known = F.when(F.upper(name).endswith("CRS84"), F.lit(4326)).otherwise(code)
    return F.when(name.isNotNull(), F.coalesce(known, F.raise_error(F.concat(F.lit("unknown coordinate system: "), name)).cast("int")))


def epsg_of(collection: DataFrame) -> int | None:
    """The one EPSG code that all documents of a collection name, None when none names any.

    Documents with different codes, or some with one and some without, are refused: `features_of` keeps the code of each.
    """
    rows = collection.select(epsg_code(F.col("crs.properties.name")).alias("epsg")).distinct().limit(2).collect()
    if len(rows) > 1:
        raise ValueError("documents with different coordinate systems must be read apart")
    return rows[0]["epsg"] if rows else None


def parse_properties(df: DataFrame, names: list[str], column: str = "properties") -> DataFrame:
    """Properties by name as text columns; absent and null ones are NULL."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = df.withColumn("_p", F.from_json(column, schema))
    return parsed.select("*", *[F.col("_p")[n].alias(n) for n in names]).drop("_p")


def absent_properties(names: list[str], column: str = "properties"):
    """Names a feature's property bag does not have at all, as opposed to having them as null."""
    return F.array_except(F.array(*[F.lit(n) for n in names]), F.coalesce(F.json_object_keys(column), F.array().cast("array<string>")))


def feature_json(kind: str, properties: list[str], geometry_col: str = "geometry"):
    """One GeoJSON Feature as text; missing properties become null and a missing status `unknown`."""
    bag = [
        (F.coalesce(F.col("status"), F.lit("unknown")) if p == "status" else F.col(f"`{p}`")).alias(p) for p in properties
    ]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        encode_geometry(geometry_col, kind).alias("geometry"),
        (F.struct(*bag) if bag else F.create_map().cast("map<string,string>")).alias("properties"),
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})


def write_features(df: DataFrame, path: str, kind: str, properties: list[str], mode: str = "errorifexists") -> None:
    """One feature per line, written by all tasks."""
    df.select(feature_json(kind, properties).alias("value")).write.mode(mode).text(path)
