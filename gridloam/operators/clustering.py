"""Point clusters on a Web Mercator pixel grid.

A cluster is all points of one grid cell at one zoom. This is an aggregate, so its clusters differ from
those of a sequential greedy pass; totals and the nesting of zooms are the same kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloam.session import written

TILE_PX = 512


def mercator_x(lon: Column) -> Column:
    """Longitude to [0, 1]."""
    return (lon + 180.0) / 360.0


def mercator_y(lat: Column) -> Column:
    """Latitude to [0, 1] from north to south, cut off at the poles."""
    s = F.sin(F.radians(lat))
    y = F.lit(0.5) - F.log((1 + s) / (1 - s)) / F.lit(4 * math.pi)
    return F.when(lat >= 90, 0.0).when(lat <= -90, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), y)))


def latitude(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp((F.lit(0.5) - y) * F.lit(2 * math.pi)))) - 90.0


def _pixel_cell(m: Column, zoom: int, radius_px: float) -> Column:
    return F.floor(m * F.lit(TILE_PX * 2.0**zoom / radius_px))


def _placed(points: DataFrame, geometry_col: str) -> DataFrame:
    located = points.where(F.col(geometry_col).isNotNull())
    return located.withColumns(
        {"_mx": mercator_x(F.col(f"{geometry_col}.x")), "_my": mercator_y(F.col(f"{geometry_col}.y"))}
    )


def cluster_points(
    points: DataFrame,
    zoom: int,
    radius_px: float,
    max_zoom: int,
    attributes: list[str] = (),
    geometry_col: str = "geometry",
    status_statuses: list[str] | None = None,
    filter_before: bool = False,
    status_col: str = "status",
) -> DataFrame:
    """Clusters and lone points at a zoom: point_count, x, y and, for lone points, their attributes.

    Above `max_zoom` every point stands alone. A status filter applies to lone points only, so bubbles
    count every status, unless `filter_before` is set.
    """
    if status_statuses is not None and filter_before:
        points = points.where(F.col(status_col).isin(status_statuses))
    wanted = list(dict.fromkeys([*attributes, *([status_col] if status_statuses is not None else [])]))
    x, y = F.col(f"{geometry_col}.x"), F.col(f"{geometry_col}.y")
    if zoom > max_zoom:
        located = points.where(F.col(geometry_col).isNotNull())
        out = located.select(F.lit(1).cast("bigint").alias("point_count"), x.alias("x"), y.alias("y"), *wanted)
    else:
        one = F.struct(x.alias("x"), y.alias("y"), *wanted)
        grouped = (
            _placed(points, geometry_col)
            .groupBy(_pixel_cell(F.col("_mx"), zoom, radius_px).alias("cell_x"), _pixel_cell(F.col("_my"), zoom, radius_px).alias("cell_y"))
            .agg(
                F.count(F.lit(1)).alias("point_count"),
                F.avg("_mx").alias("_ax"),
                F.avg("_my").alias("_ay"),
                F.any_value(one).alias("_one"),
            )
        )
        lone = F.col("point_count") == 1
        out = grouped.select(
            "point_count",
            F.when(lone, F.col("_one.x")).otherwise(F.col("_ax") * 360.0 - 180.0).alias("x"),
            F.when(lone, F.col("_one.y")).otherwise(latitude(F.col("_ay"))).alias("y"),
            *[F.when(lone, F.col(f"_one.{a}")).alias(a) for a in wanted],
        )
    if status_statuses is not None and not filter_before:
        out = out.where((F.col("point_count") > 1) | F.col(status_col).isin(status_statuses))
    return out.select("point_count", "x", "y", *attributes)


def cluster_pyramid(
    points: DataFrame,
    zooms: list[int],
    radius_px: float,
    max_zoom: int,
    attributes: list[str] = (),
    geometry_col: str = "geometry",
) -> DataFrame:
    """`cluster_points` at several zooms, with `zoom`, from one reading of the points.

    Points are put into the cells of the finest zoom asked for, at most `max_zoom`, once; a cell keeps their number,
    their sums and one member. Cells nest, so each coarser zoom is made from the cells of the one below it, of which
    there are ever fewer. Above `max_zoom` the points themselves are the answer and are read once more.
    """
    wanted, x, y = list(attributes), F.col(f"{geometry_col}.x"), F.col(f"{geometry_col}.y")
    clustered, out = sorted((z for z in zooms if z <= max_zoom), reverse=True), None
    if clustered:
        finest = clustered[0]
        level = (
            _placed(points, geometry_col)
            .groupBy(_pixel_cell(F.col("_mx"), finest, radius_px).alias("cell_x"), _pixel_cell(F.col("_my"), finest, radius_px).alias("cell_y"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_mx").alias("sx"), F.sum("_my").alias("sy"), F.any_value(F.struct(x.alias("x"), y.alias("y"), *wanted)).alias("one"))
        )
        for zoom in range(finest, clustered[-1] - 1, -1):
            if zoom < finest:
                # Rounding down twice is rounding down once: a cell of this zoom is four of the one below.
                level = level.groupBy(F.shiftright("cell_x", 1).alias("cell_x"), F.shiftright("cell_y", 1).alias("cell_y")).agg(
                    F.sum("n").alias("n"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), F.any_value("one").alias("one")
                )
            level = written(level, "clusters")
            if zoom in clustered:
                lone = F.col("n") == 1
                shown = level.select(
                    F.lit(zoom).alias("zoom"),
                    F.col("n").alias("point_count"),
                    F.when(lone, F.col("one.x")).otherwise(F.col("sx") / F.col("n") * 360.0 - 180.0).alias("x"),
                    F.when(lone, F.col("one.y")).otherwise(latitude(F.col("sy") / F.col("n"))).alias("y"),
                    *[F.when(lone, F.col(f"one.{a}")).alias(a) for a in wanted],
                )
                out = shown if out is None else out.unionByName(shown)
    above = [z for z in zooms if z > max_zoom]
    if above:
        located = points.where(F.col(geometry_col).isNotNull())
        alone = located.select(F.explode(F.array(*map(F.lit, above))).alias("zoom"), F.lit(1).cast("bigint").alias("point_count"), x.alias("x"), y.alias("y"), *wanted)
        out = alone if out is None else out.unionByName(alone)
    return out


def cluster_expansion_zoom(points: DataFrame, zoom: int, radius_px: float, max_zoom: int, geometry_col: str = "geometry") -> DataFrame:
    """Per cluster at a zoom, the smallest zoom at which it falls apart.

    Cells nest from zoom to zoom and floor is monotonic, so the extremes of a cluster's points tell for
    every zoom whether they still share a cell; no point is repeated per zoom.
    """
    cell_x, cell_y = _pixel_cell(F.col("_mx"), zoom, radius_px), _pixel_cell(F.col("_my"), zoom, radius_px)
    clusters = (
        _placed(points, geometry_col)
        .groupBy(cell_x.alias("cell_x"), cell_y.alias("cell_y"))
        .agg(
            F.count(F.lit(1)).alias("point_count"),
            F.min("_mx").alias("x1"), F.max("_mx").alias("x2"),
            F.min("_my").alias("y1"), F.max("_my").alias("y2"),
        )
        .where("point_count > 1")
    )
    answer = F.lit(max_zoom + 1)
    for z in range(max_zoom, zoom, -1):
        apart = (_pixel_cell(F.col("x1"), z, radius_px) != _pixel_cell(F.col("x2"), z, radius_px)) | (
            _pixel_cell(F.col("y1"), z, radius_px) != _pixel_cell(F.col("y2"), z, radius_px)
        )
        answer = F.when(apart, z).otherwise(answer)
    return clusters.select("cell_x", "cell_y", "point_count", answer.alias("expansion_zoom"))
