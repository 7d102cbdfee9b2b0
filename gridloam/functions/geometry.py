"""Geometry as nested structs, with the predicates and conversions written as Column expressions.

Point: STRUCT<x, y>. Line: ARRAY<point>. Region: ARRAY<ARRAY<ARRAY<point>>> (part, ring, vertex);
the first ring of a part is its outline, the others are holes. Coordinates are planar lon/lat.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"
MULTIPOLYGON = f"array<array<array<{POINT}>>>"

EARTH_RADIUS_M = 6378137.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def line(*points: Column) -> Column:
    return F.array(*points)


def polygon(*ring: Column) -> Column:
    """One part with one ring; the ring is closed here if the caller leaves it open."""
    return F.array(F.array(F.array(*ring, ring[0])))


# ---------------------------------------------------------------- GeoJSON

def _vertex(c: Column) -> Column:
    return F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y"))


def decode_geometry(geometry, kind: str) -> Column:
    """GeoJSON geometry (STRUCT<type, coordinates as JSON text>) to a nested struct; NULL stays NULL.

    `kind` is point, line or multipolygon. A Polygon becomes a MultiPolygon of one part. Any other
    geometry type fails the run, as a typed geometry column would refuse it.
    """
    g = _col(geometry)
    gtype, text = g["type"], g["coordinates"]
    if kind == "point":
        known = {"Point": _vertex(F.from_json(text, "array<double>"))}
    elif kind == "line":
        known = {"LineString": F.transform(F.from_json(text, "array<array<double>>"), _vertex)}
    elif kind == "multipolygon":
        def part(p: Column) -> Column:
            return F.transform(p, lambda ring: F.transform(ring, _vertex))

        known = {
            "Polygon": F.array(part(F.from_json(text, "array<array<array<double>>>"))),
            "MultiPolygon": F.transform(F.from_json(text, "array<array<array<array<double>>>>"), part),
        }
    else:
        raise ValueError(f"unknown geometry kind: {kind}")
    out = F.when(g.isNull() | gtype.isNull(), F.lit(None))
    for name, value in known.items():
        out = out.when(gtype == name, value)
    return out.otherwise(F.raise_error(F.concat(F.lit(f"expected a {kind} geometry, got "), gtype)))


def encode_geometry(geometry, kind: str) -> Column:
    """Nested struct to a GeoJSON geometry struct, ready for `to_json`."""
    g = _col(geometry)

    def pair(v: Column) -> Column:
        return F.array(v["x"], v["y"])

    if kind == "point":
        name, coordinates = "Point", pair(g)
    elif kind == "line":
        name, coordinates = "LineString", F.transform(g, pair)
    elif kind == "multipolygon":
        name = "MultiPolygon"
        coordinates = F.transform(g, lambda p: F.transform(p, lambda ring: F.transform(ring, pair)))
    else:
        raise ValueError(f"unknown geometry kind: {kind}")
    return F.when(g.isNotNull(), F.struct(F.lit(name).alias("type"), coordinates.alias("coordinates")))


def _wgs84_vertex(v: Column) -> Column:
    lon = F.degrees(v["x"] / F.lit(EARTH_RADIUS_M))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(v["y"] / F.lit(EARTH_RADIUS_M)))) - F.lit(90.0)
    return F.when(v.isNotNull(), F.struct(lon.alias("x"), lat.alias("y")))


def to_wgs84(geometry, kind: str, epsg: int | None) -> Column:
    """Reproject to 4326. No code means 4326 already; 3857 has a closed form; others are refused."""
    g = _col(geometry)
    if epsg in (None, 4326):
        return g
    if epsg != 3857:
        raise ValueError(f"no conversion from EPSG:{epsg} to EPSG:4326")
    if kind == "point":
        return _wgs84_vertex(g)
    if kind == "line":
        return F.transform(g, _wgs84_vertex)
    return F.transform(g, lambda p: F.transform(p, lambda ring: F.transform(ring, _wgs84_vertex)))


# ---------------------------------------------------------------- measures

def ring_edges(ring: str) -> str:
    """SQL for the consecutive vertex pairs of a ring, closed whether or not its last vertex repeats the first."""
    return (
        f"zip_with({ring}, concat(slice({ring}, 2, size({ring})), slice({ring}, 1, 1)), "
        "(a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))"
    )


def line_segments(line: str) -> str:
    """SQL for the consecutive vertex pairs of a line. The last vertex pairs with itself: a zero-length
    segment, which also covers lines of one vertex."""
    return (
        f"zip_with({line}, concat(slice({line}, 2, size({line})), slice({line}, -1, 1)), "
        "(a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))"
    )


# Bound step by step through one-element transforms, so that every value is worked out once:
# g the region, o its first vertex, rings the shoelace sums of each ring with +1 for outlines and -1 for holes.
_CENTROID = """
get(transform(array({region}), g -> get(transform(array(get(get(get(g, 0), 0), 0)), o -> get(transform(array(
  flatten(transform(g, part -> transform(part, (ring, i) -> get(transform(array(
    zip_with(ring, concat(slice(ring, 2, size(ring)), slice(ring, 1, 1)),
             (a, b) -> named_struct('x1', a.x - o.x, 'y1', a.y - o.y, 'x2', b.x - o.x, 'y2', b.y - o.y))),
    edges -> named_struct(
      'edges', edges,
      'area2', aggregate(edges, 0D, (s, e) -> s + (e.x1 * e.y2 - e.x2 * e.y1)),
      'mx', aggregate(edges, 0D, (s, e) -> s + (e.x1 + e.x2) * (e.x1 * e.y2 - e.x2 * e.y1)),
      'my', aggregate(edges, 0D, (s, e) -> s + (e.y1 + e.y2) * (e.x1 * e.y2 - e.x2 * e.y1)),
      'side', if(i = 0, 1D, -1D))), 0))))), rings -> get(transform(array(named_struct(
    'area2', aggregate(rings, 0D, (s, r) -> s + r.side * abs(r.area2)),
    'mx', aggregate(rings, 0D, (s, r) -> s + r.side * sign(r.area2) * r.mx),
    'my', aggregate(rings, 0D, (s, r) -> s + r.side * sign(r.area2) * r.my))),
  t -> if(t.area2 <> 0,
    named_struct('x', o.x + t.mx / (3 * t.area2), 'y', o.y + t.my / (3 * t.area2)),
    get(transform(array(aggregate(flatten(transform(rings, r -> r.edges)), named_struct('l', 0D, 'x', 0D, 'y', 0D),
      (s, e) -> named_struct('l', s.l + sqrt(pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)),
                             'x', s.x + sqrt(pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)) * (e.x1 + e.x2) / 2,
                             'y', s.y + sqrt(pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)) * (e.y1 + e.y2) / 2))),
      m -> named_struct('x', o.x + coalesce(try_divide(m.x, m.l), 0D), 'y', o.y + coalesce(try_divide(m.y, m.l), 0D))), 0))), 0)), 0)), 0)), 0)
"""


def centroid(region: str) -> Column:
    """Area centroid of the named region column: shoelace sums taken from its first vertex, holes subtract.

    Ring order, not winding, says what is a hole. A region without area falls back to the
    length-weighted centre of its edges, and one without length to its first vertex.
    """
    return F.expr(_CENTROID.format(region=region))


# ---------------------------------------------------------------- predicates
#
# Written as SQL text over named values, because they are used inside lambdas over edges.

def orientation(e: str, x: str, y: str) -> str:
    """Positive when (x, y) lies left of the edge, negative when right, zero on its line."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def on_edge(e: str, x: str, y: str) -> str:
    return (
        f"({x} between least({e}.x1, {e}.x2) and greatest({e}.x1, {e}.x2) "
        f"and {y} between least({e}.y1, {e}.y2) and greatest({e}.y1, {e}.y2) and {orientation(e, x, y)} = 0)"
    )


def crosses_right(e: str, x: str, y: str) -> str:
    """Whether the ray from (x, y) to the right crosses the edge; its lower end counts, its upper end does not."""
    return f"((({e}.y1 > {y}) <> ({e}.y2 > {y})) and (({orientation(e, x, y)} > 0) = ({e}.y2 > {e}.y1)))"


def segments_meet(s: str, e: str) -> str:
    """Closed test: a shared point of any kind counts."""
    boxes = (
        f"greatest({s}.x1, {s}.x2) >= least({e}.x1, {e}.x2) and least({s}.x1, {s}.x2) <= greatest({e}.x1, {e}.x2) "
        f"and greatest({s}.y1, {s}.y2) >= least({e}.y1, {e}.y2) and least({s}.y1, {s}.y2) <= greatest({e}.y1, {e}.y2)"
    )

    def astride(p: str, q: str) -> str:
        return f"sign({orientation(p, q + '.x1', q + '.y1')}) * sign({orientation(p, q + '.x2', q + '.y2')}) <= 0"

    return f"({boxes} and {astride(s, e)} and {astride(e, s)})"


def within(pt: str, region: str) -> Column:
    """Strict interior test of one point against the whole region in the same row, by column names.

    For a pair already at hand; joining many points to many regions goes through `assign_region`.
    """
    edges = f"flatten(transform(flatten({region}), ring -> {ring_edges('ring')}))"
    x, y = f"{pt}.x", f"{pt}.y"
    inside = (
        f"not exists(edges, e -> {on_edge('e', x, y)}) and pmod(size(filter(edges, e -> {crosses_right('e', x, y)})), 2) = 1"
    )
    return F.expr(f"get(transform(array({edges}), edges -> {inside}), 0)")


def intersects(ln: str, region: str) -> Column:
    """Closed test of one line against the whole region in the same row, by column names."""
    edges = f"flatten(transform(flatten({region}), ring -> {ring_edges('ring')}))"
    touching = f"exists({line_segments(ln)}, s -> exists(edges, e -> {segments_meet('s', 'e')}))"
    first = F.expr(f"get(transform(array({edges}), edges -> {touching}), 0)")
    return first | within(f"get({ln}, 0)", region)
