"""Geometry as a plain column, with distances in metres.

A geometry is ``struct<kind:string, pts:array<struct<lon:double,lat:double>>>`` with kind
``point``, ``line`` or ``polygon`` (closed: the last point repeats the first). Distances are taken the
short way round, also across the antimeridian; shapes themselves must not cross it.

Arguments are column names, or SQL expressions, as text: the expressions are large, and one parsed
text costs the driver far less than hundreds of column calls. Names that start with an underscore
are taken by the lambda variables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180
GEOMETRY_TYPE = "struct<kind:string,pts:array<struct<lon:double,lat:double>>>"

SIDES = ("x0", "x1", "y0", "y1")
Vertex = tuple[str, str]


# Constructors


def _geometry(kind: str, vertices: list[Vertex]) -> Column:
    pts = ", ".join(f"named_struct('lon', CAST({lon} AS DOUBLE), 'lat', CAST({lat} AS DOUBLE))" for lon, lat in vertices)
    return F.expr(f"named_struct('kind', '{kind}', 'pts', array({pts}))")


def point(lon: str, lat: str) -> Column:
    return _geometry("point", [(lon, lat)])


def line(*vertices: Vertex) -> Column:
    return _geometry("line", list(vertices))


def polygon(*vertices: Vertex) -> Column:
    """A ring; the closing vertex is added."""
    return _geometry("polygon", [*vertices, vertices[0]])


def box(min_lon: str, min_lat: str, max_lon: str, max_lat: str) -> Column:
    return polygon((min_lon, min_lat), (max_lon, min_lat), (max_lon, max_lat), (min_lon, max_lat))


# Vertices and edges


def bounds(geom: str) -> list[Column]:
    """The four sides of the bounding box: x0, x1, y0, y1."""
    parts = [("x0", "min", "lon"), ("x1", "max", "lon"), ("y0", "min", "lat"), ("y1", "max", "lat")]
    return [F.expr(f"array_{pick}(transform({geom}.pts, _p -> _p.{axis}))").alias(side) for side, pick, axis in parts]


def _edges(geom: str) -> str:
    """Edges as structs of two vertices; a point is an edge without length."""
    pts = f"{geom}.pts"
    pairs = f"zip_with(slice({pts}, 1, size({pts}) - 1), slice({pts}, 2, size({pts}) - 1), (_a, _b) -> named_struct('a', _a, 'b', _b))"
    return f"IF(size({pts}) = 1, transform({pts}, _p -> named_struct('a', _p, 'b', _p)), {pairs})"


def _haversine(a: str, b: str) -> str:
    """Great-circle distance between two vertices."""
    h = (
        f"pow(sin(radians({b}.lat - {a}.lat) / 2), 2)"
        f" + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_M!r}D * asin(sqrt(least(1D, {h})))"


def _short(degrees: str) -> str:
    """A difference of longitudes the short way round; one below 180 degrees stays as it is, to the last bit."""
    return f"(({degrees}) - 360D * rint(({degrees}) / 360D))"


def _to_edges(geom: str, other: str) -> str:
    """Smallest distance from a vertex of one geometry to an edge of the other, each in the plane
    that touches the vertex."""
    flat = (
        f"transform({_edges(other)}, _e -> named_struct("
        f"'x', {_short('_e.a.lon - _v.lon')} * cos(radians(_v.lat)), 'y', _e.a.lat - _v.lat, "
        "'dx', (_e.b.lon - _e.a.lon) * cos(radians(_v.lat)), 'dy', _e.b.lat - _e.a.lat))"
    )
    # Share of the edge at which it comes closest; an edge without length has only its start.
    share = "coalesce(greatest(0D, least(1D, try_divide(-(_s.x * _s.dx + _s.y * _s.dy), _s.dx * _s.dx + _s.dy * _s.dy))), 0D)"
    squared = (
        f"transform(transform({flat}, _s -> named_struct('s', _s, 't', {share})), "
        "_c -> pow(_c.s.x + _c.t * _c.s.dx, 2) + pow(_c.s.y + _c.t * _c.s.dy, 2))"
    )
    return f"array_min(transform({geom}.pts, _v -> sqrt(array_min({squared})))) * {METRES_PER_DEGREE!r}D"


def _turn(o: str, a: str, b: str) -> str:
    return f"signum(({a}.lon - {o}.lon) * ({b}.lat - {o}.lat) - ({a}.lat - {o}.lat) * ({b}.lon - {o}.lon))"


def _edges_meet() -> str:
    """Whether edges ``_e`` and ``_f`` share a point: their boxes overlap and each straddles the other."""
    overlap = [
        f"least({p}.a.{axis}, {p}.b.{axis}) <= greatest({q}.a.{axis}, {q}.b.{axis})"
        for axis in ("lon", "lat")
        for p, q in (("_e", "_f"), ("_f", "_e"))
    ]
    straddle = [f"{_turn(f'{p}.a', f'{p}.b', f'{q}.a')} * {_turn(f'{p}.a', f'{p}.b', f'{q}.b')} <= 0" for p, q in (("_e", "_f"), ("_f", "_e"))]
    return " AND ".join(overlap + straddle)


def _inside(vertex: str, geom: str) -> str:
    """Even-odd rule: a ray to the east leaves the ring an odd number of times."""
    share = f"try_divide({vertex}.lat - _e.a.lat, _e.b.lat - _e.a.lat)"
    crossed = f"(_e.a.lat > {vertex}.lat) <> (_e.b.lat > {vertex}.lat) AND {vertex}.lon < _e.a.lon + {share} * (_e.b.lon - _e.a.lon)"
    return f"({geom}.kind = 'polygon' AND size(filter({_edges(geom)}, _e -> {crossed})) % 2 = 1)"


def _intersects(a: str, b: str) -> str:
    meet = f"exists({_edges(a)}, _e -> exists({_edges(b)}, _f -> {_edges_meet()}))"
    return f"({meet} OR {_inside(f'{a}.pts[0]', b)} OR {_inside(f'{b}.pts[0]', a)})"


def intersects(a: str, b: str) -> Column:
    """True when the two geometries share a point; a polygon includes its interior and its border."""
    return F.expr(_intersects(a, b))


def distance(a: str, b: str) -> Column:
    """Metres between two geometries; 0 where they intersect."""
    return F.expr(
        f"""CASE
        WHEN {a}.kind = 'point' AND {b}.kind = 'point' THEN {_haversine(f'{a}.pts[0]', f'{b}.pts[0]')}
        WHEN {a}.kind = 'point' AND {b}.kind = 'line' THEN {_to_edges(a, b)}
        WHEN {b}.kind = 'point' AND {a}.kind = 'line' THEN {_to_edges(b, a)}
        WHEN {_intersects(a, b)} THEN 0D
        WHEN {a}.kind = 'point' THEN {_to_edges(a, b)}
        WHEN {b}.kind = 'point' THEN {_to_edges(b, a)}
        ELSE least({_to_edges(a, b)}, {_to_edges(b, a)}) END"""
    )


# End vertices as plain columns, for which distances need no arrays

ENDS = ("ax", "ay", "bx", "by")


def ends(geom: str) -> list[Column]:
    """``spot`` (a point), ``plain`` (a point or a line of two vertices) and the first and last vertex."""
    last = f"{geom}.pts[size({geom}.pts) - 1]"
    vertices = [f"{geom}.pts[0].lon", f"{geom}.pts[0].lat", f"{last}.lon", f"{last}.lat"]
    spot = f"{geom}.kind = 'point'"
    plain = f"({spot} OR ({geom}.kind = 'line' AND size({geom}.pts) = 2))"
    return [F.expr(f"{spot} AS spot"), F.expr(f"{plain} AS plain"), *[F.expr(f"{v} AS {n}") for v, n in zip(vertices, ENDS)]]


def rebuilt(p: str) -> str:
    """The geometry of a plain shape from its end columns."""
    a, b = (f"named_struct('lon', {p}{e}x, 'lat', {p}{e}y)" for e in "ab")
    return f"named_struct('kind', IF({p}spot, 'point', 'line'), 'pts', IF({p}spot, array({a}), array({a}, {b})))"


def with_plain_distance(df: DataFrame, p: str, q: str, name: str, cosine: str | None = None) -> DataFrame:
    """``df`` with the distance of two plain shapes, one of them a point, as ``name``; equal to ``distance`` to the last bit.
    ``cosine`` names that of the latitude of the point, where it is known.

    It takes three steps, so that every part is worked out once and all of it is compiled code."""
    point_x, point_y = f"IF({q}spot, {q}ax, {p}ax)", f"IF({q}spot, {q}ay, {p}ay)"
    edge = {e: f"IF({q}spot, {p}{e}, {q}{e})" for e in ENDS}
    first = df.selectExpr(
        "*", f"{point_x} AS _vx", f"{point_y} AS _vy", f"{cosine or f'cos(radians({point_y}))'} AS _k", *[f"{v} AS _{e}" for e, v in edge.items()],
    ).selectExpr(
        "*", f"{_short('_ax - _vx')} * _k AS _x", "_ay - _vy AS _y", "(_bx - _ax) * _k AS _dx", "_by - _ay AS _dy",
    )
    share = "coalesce(greatest(0D, least(1D, try_divide(-(_x * _dx + _y * _dy), _dx * _dx + _dy * _dy))), 0D)"
    second = first.selectExpr("*", f"{share} AS _t").selectExpr("*", "_x + _t * _dx AS _ex", "_y + _t * _dy AS _ey")
    flat = f"sqrt(_ex * _ex + _ey * _ey) * {METRES_PER_DEGREE!r}D"
    vertex = [f"named_struct('lon', {v}ax, 'lat', {v}ay)" for v in (p, q)]
    both = _haversine(*vertex)
    taken = ("_vx", "_vy", "_k", *[f"_{e}" for e in ENDS], "_x", "_y", "_dx", "_dy", "_t", "_ex", "_ey")
    return second.selectExpr("*", f"IF({p}spot AND {q}spot, {both}, {flat}) AS {name}").drop(*taken)


# Bounding boxes, given by the prefixes of their side columns


# Bounds give way by more than rounding can take.
_SHRUNK, _GROWN = f"{1 - 1e-9!r}D - 1e-6D", f"{1 + 1e-9!r}D + 1e-6D"


def box_gap(p: str, q: str) -> str:
    """A distance no two points of the two boxes can fall below, as one expression."""
    dlon = f"greatest(0D, least(greatest({p}x0 - {q}x1, {q}x0 - {p}x1), 360D - greatest({p}x1 - {q}x0, {q}x1 - {p}x0)))"
    dlat = f"greatest(0D, {p}y0 - {q}y1, {q}y0 - {p}y1)"
    shrink = f"cos(radians(greatest(abs({p}y0), abs({p}y1), abs({q}y0), abs({q}y1))))"
    sphere = f"{2 * EARTH_RADIUS_M!r}D * asin(sqrt(least(1D, pow(sin(radians({dlat}) / 2), 2) + pow({shrink} * sin(radians({dlon}) / 2), 2))))"
    plane = f"{METRES_PER_DEGREE!r}D * sqrt(pow({dlat}, 2) + pow({shrink} * {dlon}, 2))"
    return f"(least({sphere}, {plane}) * {_SHRUNK})"


def with_bounds(df: DataFrame, p: str, q: str) -> DataFrame:
    """``df`` with ``gap`` and ``reach``, the least and the largest distance of a shape of ``p`` (box and ends) from what the
    box of ``q`` holds.

    Boxes bound any two shapes. A line of two vertices is also bounded by itself, however long and slanting it is: from
    below by the way from its straight to the box, from above by the way to the centre of the box and on to a corner.
    Distances are taken with the smallest and the largest cosine of a latitude in either box; those from a line to points
    (``spots`` of ``q``: it holds nothing else) are taken at the points, so only the box of ``q`` matters there.
    """
    # Either way round: between the near sides, or across the antimeridian between the far ones.
    wide = f"greatest({p}x1 - {q}x0, {q}x1 - {p}x0)"
    south, north = f"least({p}y0, {q}y0)", f"greatest({p}y1, {q}y1)"
    at_points = f"({p}plain AND NOT {p}spot AND {q}spots)"
    south, north = f"IF({at_points}, {q}y0, {south})", f"IF({at_points}, {q}y1, {north})"
    farthest = "greatest(abs(_south), abs(_north))"
    nearest = "IF(_south <= 0 AND _north >= 0, 0D, least(abs(_south), abs(_north)))"
    first = df.selectExpr("*", f"{south} AS _south", f"{north} AS _north").selectExpr(
        "*",
        f"cos(radians({farthest})) AS _low", f"cos(radians({nearest})) AS _high", f"{wide} AS _wide",
        f"greatest({p}x0 - {q}x1, {q}x0 - {p}x1) AS _between",
        f"greatest(0D, {p}y0 - {q}y1, {q}y0 - {p}y1) AS _dlat", f"greatest({p}y1 - {q}y0, {q}y1 - {p}y0) AS _tall",
        f"greatest({p}x1, {q}x1) - least({p}x0, {q}x0) AS _span",
        f"{p}bx - {p}ax AS _ux", f"{p}by - {p}ay AS _uy", f"({q}x0 + {q}x1) / 2 - {p}ax AS _wx", f"({q}y0 + {q}y1) / 2 - {p}ay AS _wy",
        f"({q}x1 - {q}x0) / 2 AS _hx", f"({q}y1 - {q}y0) / 2 AS _hy",
    )
    second = first.selectExpr(
        "*",
        "greatest(0D, least(_between, 360D - _wide)) AS _dlon",
        "sqrt(pow(_ux * _low, 2) + _uy * _uy) AS _length", "pow(_ux * _high, 2) + _uy * _uy AS _squared",
        "_low * (abs(_ux * _wy - _uy * _wx) - abs(_uy) * _hx - abs(_ux) * _hy) AS _off",
    ).selectExpr(
        "*",
        "sqrt(_dlat * _dlat + pow(_low * _dlon, 2)) AS _apart",
        f"asin(sqrt(least(1D, pow(sin(radians(_dlat) / 2), 2) + pow(_low * sin(radians(_dlon) / 2), 2)))) * {2 * EARTH_RADIUS_M!r}D AS _sphere",
        "IF(_squared > 0, greatest(0D, least(1D, (_ux * _wx * _high * _high + _uy * _wy) / _squared)), 0D) AS _share",
    )
    edge_gap = f"IF({p}plain AND _span <= 180D AND _length > 0, greatest(0D, _off / _length), 0D) * {METRES_PER_DEGREE!r}D"
    box_reach = "sqrt(_tall * _tall + pow(_high * _wide, 2))"
    edge_reach = "sqrt(pow((_wx - _share * _ux) * _high, 2) + pow(_wy - _share * _uy, 2)) + sqrt(pow(_high * _hx, 2) + _hy * _hy)"
    told = second.selectExpr(
        "*",
        f"greatest(least(_sphere, _apart * {METRES_PER_DEGREE!r}D), {edge_gap}) * {_SHRUNK} AS gap",
        f"IF({p}plain, least({box_reach}, {edge_reach}), {box_reach}) * {METRES_PER_DEGREE!r}D * {_GROWN} AS reach",
    )
    return told.select(*df.columns, "gap", "reach")


def with_line_bounds(df: DataFrame, p: str, q: str) -> DataFrame:
    """``with_bounds`` for a line of two vertices (ends of ``p``) and a box of points (sides of ``q`` with ``low`` and ``high``, the
    least and the largest cosine of its latitudes): the same bounds without the cases that cannot occur, in plain arithmetic."""
    x0, x1, y0, y1 = (f"{pick}({p}a{axis}, {p}b{axis})" for axis in "xy" for pick in ("least", "greatest"))
    low, high = f"{q}low", f"{q}high"
    first = df.selectExpr(
        "*",
        f"{x0} AS _x0", f"{x1} AS _x1", f"{y0} AS _y0", f"{y1} AS _y1", f"{p}bx - {p}ax AS _ux", f"{p}by - {p}ay AS _uy",
        f"({q}x0 + {q}x1) / 2 - {p}ax AS _wx", f"({q}y0 + {q}y1) / 2 - {p}ay AS _wy",
        f"({q}x1 - {q}x0) / 2 AS _hx", f"({q}y1 - {q}y0) / 2 AS _hy",
    ).selectExpr(
        "*",
        f"greatest(0D, least(greatest(_x0 - {q}x1, {q}x0 - _x1), 360D - greatest(_x1 - {q}x0, {q}x1 - _x0))) * {low} AS _dlon",
        f"greatest(0D, _y0 - {q}y1, {q}y0 - _y1) AS _dlat", f"greatest(_x1, {q}x1) - least(_x0, {q}x0) AS _span",
        f"_ux * {low} AS _ul", f"_ux * {high} AS _uh",
    ).selectExpr(
        "*",
        "sqrt(_ul * _ul + _uy * _uy) AS _length", "_uh * _uh + _uy * _uy AS _squared",
        f"{low} * (abs(_ux * _wy - _uy * _wx) - abs(_uy) * _hx - abs(_ux) * _hy) AS _off",
    ).selectExpr(
        "*", f"IF(_squared > 0, greatest(0D, least(1D, (_uh * _wx * {high} + _uy * _wy) / _squared)), 0D) AS _share",
    ).selectExpr(
        "*", f"(_wx - _share * _ux) * {high} AS _ex", "_wy - _share * _uy AS _ey", f"{high} * _hx AS _gx",
    )
    edge_gap = "IF(_span <= 180D AND _length > 0, _off / _length, 0D)"
    told = first.selectExpr(
        "*",
        f"greatest(sqrt(_dlat * _dlat + _dlon * _dlon), {edge_gap}) * {METRES_PER_DEGREE!r}D * {_SHRUNK} AS gap",
        f"(sqrt(_ex * _ex + _ey * _ey) + sqrt(_gx * _gx + _hy * _hy)) * {METRES_PER_DEGREE!r}D * {_GROWN} AS reach",
    )
    return told.select(*df.columns, "gap", "reach")


def latitude_cosines(y0: str, y1: str) -> tuple[str, str]:
    """The least and the largest cosine of the latitudes from ``y0`` to ``y1``."""
    nearest = f"IF({y0} <= 0 AND {y1} >= 0, 0D, least(abs({y0}), abs({y1})))"
    return f"cos(radians(greatest(abs({y0}), abs({y1}))))", f"cos(radians({nearest}))"


def may_meet(p: str, q: str) -> str:
    """Whether the boxes overlap and, where ``p`` is a line of two vertices, the line comes through the box of ``q``."""
    overlap = f"{p}x0 <= {q}x1 AND {q}x0 <= {p}x1 AND {p}y0 <= {q}y1 AND {q}y0 <= {p}y1"
    ux, uy = f"({p}bx - {p}ax)", f"({p}by - {p}ay)"
    wx, wy = f"(({q}x0 + {q}x1) / 2 - {p}ax)", f"(({q}y0 + {q}y1) / 2 - {p}ay)"
    off = f"abs({ux} * {wy} - {uy} * {wx}) - abs({uy}) * ({q}x1 - {q}x0) / 2 - abs({ux}) * ({q}y1 - {q}y0) / 2"
    # Rounding must not part shapes that touch.
    size = f"(abs({ux}) + abs({uy})) * (abs({wx}) + abs({wy}) + ({q}x1 - {q}x0) + ({q}y1 - {q}y0))"
    return f"({overlap} AND (NOT {p}plain OR {p}spot OR {off} <= 1e-9D * {size}))"
