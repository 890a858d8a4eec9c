"""Distance and intersection joins over packed hierarchies of boxes.

Shapes to be found are numbered along a space-filling curve; sixteen neighbours make a leaf, sixty-four leaves a cell,
and so on, each with the box around what it holds and its number of items. So all levels come from one numbering, and
every leaf is equally deep, however shapes crowd. Searching starts from the few cells at the top and follows only
cells that can matter, by an equi-join from cell to cells below: no pair of shapes is formed outside the last cells, and
a cell that lies inside the search radius as a whole is counted without looking at its shapes.

One descent answers both questions, what is nearest and how much is near. Rows of a searched shape stay together in a
partition, so after every level its bound for the nearest item and its count are sums over its own rows; a cell
that is counted, or too far away, leaves the search at once. Bounds for a line of two vertices follow the line itself,
not its box. Every level is a table of its own, and broadcast where the planner knows its size in bytes to be small.

Counting points near lines of two vertices stops the descent at tiles of up to sixty-four leaves. Only there, and once, rows
are shuffled: one for each tile that the rim of what is in reach crosses. A tile is one row that holds its leaves and their
points, and whatever is looked at below is looked at where the two meet.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.operators.ranking import row_number
from tessera.session import lanes, materialise_by

_LEAF = 16  # shapes in a leaf
_FAN = 64  # cells in the cell above, and cells at the top at most
_CURVE_BITS = 31
# Masks that move the bits of a number to the even places, step by step.
_STEPS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
_END_COLUMNS = ("spot", "plain", *G.ENDS)


@dataclass(frozen=True)
class ShapeIndex:
    levels: list[DataFrame]  # from the top: key, parent, cell, weight, spots (points only), sides of the box
    leaves: DataFrame  # key, cell, shape, weight, sides, ends
    tiles: DataFrame | None = None  # where all shapes are points: key, tile, leaves with their sides and points

    @property
    def depth(self) -> int:
        return len(self.levels)


def build_index(items: DataFrame, geom: str, key: str | None = None) -> ShapeIndex | None:
    """Index of the distinct shapes per key; None when there are none."""
    return build_indexes({"items": (items, geom, key)})["items"]


def build_indexes(sources: dict[str, tuple[DataFrame, str, str | None]]) -> dict[str, ShapeIndex | None]:
    """Indexes of several (table, geometry, key), made together by one numbering."""
    keyed = [df.selectExpr(f"'{name}' AS of", f"CAST({key or 0} AS STRING) AS key", f"{geom} AS shape").dropna() for name, (df, geom, key) in sources.items()]
    distinct = reduce(DataFrame.unionByName, keyed).groupBy("of", "key", "shape").agg(F.expr("count(*) AS weight"))
    placed = _on_curve(distinct.select("*", *G.bounds("shape"), *G.ends("shape")))
    numbered = row_number(placed, ["of", "key"], [F.col(c) for c in ("curve", "ax", "ay", "shape")], "place")
    shape = "IF(plain, NULL, shape) AS shape"
    leaves = numbered.selectExpr("of", "key", f"(place - 1) DIV {_LEAF} AS cell", shape, "weight", *G.SIDES, *_END_COLUMNS)
    read_leaves = materialise_by(leaves, "leaves", "of")
    leaves = read_leaves()
    sizes = leaves.groupBy("of").agg(F.expr("max(cell) AS last"), F.expr("bool_and(spot) AS spots")).collect()
    last = {r.of: r.last for r in sizes}
    depths = {}
    for name, top in last.items():
        depths[name] = 1
        while top >= _FAN:
            top, depths[name] = top // _FAN, depths[name] + 1
    if not depths:
        return dict.fromkeys(sources)
    box = [F.expr(f"{'min' if s.endswith('0') else 'max'}({s}) AS {s}") for s in G.SIDES]
    lowest = leaves.groupBy("of", "key", "cell").agg(F.expr("sum(weight) AS weight"), F.expr("bool_and(spot) AS spots"), *box)
    deep = f"CASE of {' '.join(f'WHEN {name!r} THEN {d}' for name, d in depths.items())} END"
    raised = lowest.selectExpr("of", "key", "weight", "spots", *G.SIDES, "cell AS low", f"explode(sequence(1, {deep})) AS level")
    raised = raised.selectExpr("*", f"low DIV CAST(pow({_FAN}, level - 1) AS BIGINT) AS cell")
    cells = raised.groupBy("of", "key", "level", "cell").agg(F.expr("sum(weight) AS weight"), F.expr("bool_and(spots) AS spots"), *box)
    read_cells = materialise_by(cells.selectExpr("*", f"cell DIV {_FAN} AS parent"), "cells", "of", "level")
    pointed = [r.of for r in sizes if r.spots]
    read_tiles = materialise_by(_tiles(leaves.filter(F.col("of").isin(pointed))), "tiles", "of") if pointed else None
    found = {}
    for name in sources:
        levels = [read_cells(name, level) for level in range(depths.get(name, 0), 0, -1)]
        tiles = read_tiles(name) if name in pointed else None
        found[name] = ShapeIndex(levels, read_leaves(name), tiles) if levels else None
    return found


def _tiles(leaves: DataFrame) -> DataFrame:
    """One row for each cell above the leaves of points, with the leaves and the points in them: no more than a fixed number."""
    box = [F.expr(f"{'min' if s.endswith('0') else 'max'}({s}) AS {s}") for s in G.SIDES]
    points = F.expr("collect_list(struct(ax, ay, cos(radians(ay)) AS k, weight)) AS points")
    filled = leaves.groupBy("of", "key", "cell").agg(points, F.expr("sum(weight) AS weight"), *box)
    low, high = G.latitude_cosines("y0", "y1")
    leaf = f"struct(cell % {_FAN} = 0 AS first, {', '.join(G.SIDES)}, {low} AS low, {high} AS high, weight, points) AS leaf"
    return filled.selectExpr("of", "key", f"cell DIV {_FAN} AS tile", leaf).groupBy("of", "key", "tile").agg(F.expr("collect_list(leaf) AS leaves"))


def _on_curve(shapes: DataFrame) -> DataFrame:
    """Adds ``curve``, the interleaved bits of the centre of the box."""
    side = (1 << _CURVE_BITS) - 1
    x, y = (f"CAST(greatest(0D, least({side}D, floor(({a}0 + {a}1 + {2 * half}) / {4 * half} * {side}))) AS BIGINT)" for a, half in (("x", 180), ("y", 90)))
    moved = shapes.selectExpr("*", f"{x} AS _m", f"{y} AS _n")
    for shift, mask in _STEPS:
        spread = [f"(shiftleft({c}, {shift}) | {c}) & {mask}L AS {c}" for c in ("_m", "_n")]
        moved = moved.selectExpr(*[c for c in moved.columns if c not in ("_m", "_n")], *spread)
    return moved.selectExpr("*", "shiftleft(_n, 1) | _m AS curve").drop("_m", "_n")


_BOX = [f"{s} AS c_{s}" for s in G.SIDES]


def _children(cells: DataFrame) -> DataFrame:
    """Cells of a level, named by the cell above them."""
    return cells.selectExpr("key AS c_key", "parent AS c_at", "cell AS c_cell", "weight AS c_weight", "spots AS c_spots", *_BOX)


def _shapes(index: ShapeIndex) -> DataFrame:
    return index.leaves.selectExpr("key AS c_key", "cell AS c_at", "shape AS c_shape", "weight AS c_weight", *_BOX, *[f"{c} AS c_{c}" for c in _END_COLUMNS])


def _below(cell: str = "cell") -> Column:
    return F.expr(f"key = c_key AND {cell} = c_at")


def _probes(df: DataFrame, identifier: str, geom: str, key: str | None) -> DataFrame:
    """Shapes to search for; rows without a shape are not searched for. All rows of an id lie in one partition."""
    # A literal would turn the equi-join with the cells at the top into a nested loop.
    shapes = df.selectExpr(f"{identifier} AS id", f"CAST({key or f'pmod(xxhash64({identifier}), 1)'} AS STRING) AS key", f"{geom} AS probe")
    # In the order of the ids, which broadcast joins keep, so that looking at the rows of an id together needs no further sort. The
    # place keeps the optimizer from dropping the order.
    shapes = shapes.filter("probe IS NOT NULL").repartition(lanes(df.sparkSession), "id").sortWithinPartitions("id")
    shapes = shapes.withColumn("place", F.monotonically_increasing_id()).filter("place >= 0").drop("place")
    plain = shapes.select("*", *G.bounds("probe"), *G.ends("probe"))
    return plain.withColumn("probe", F.expr("IF(plain, NULL, probe)"))


_CARRY = ("id", "key", "probe", *G.SIDES, *_END_COLUMNS)


def _descend(probes: DataFrame, levels: list[DataFrame], near: str | None, seek: bool) -> DataFrame:
    """Probes with the cells of the last level in which something may be near (``near``: metres as SQL) or nearest
    (``seek``). ``counted`` is what whole cells have added for the id, ``counting`` whether the shapes of the cell may count;
    ``lead`` marks one cell of an id where they may, and is NULL for an id without any.
    """
    every = "OVER (PARTITION BY id)"
    # Without a search for the nearest one row of every id follows the first cells, to carry the count.
    start = ["0L AS cell", "CAST('Infinity' AS DOUBLE) AS most", "0L AS counted", f"{'true' if near else 'false'} AS counting", f"{'false' if seek else 'true'} AS carrier", "true AS lead"]
    rows = probes.selectExpr(*_CARRY, *start)
    for cells in levels:
        measured = G.with_bounds(rows.join(_children(cells), _below()), "", "c_").selectExpr(
            *_CARRY, "c_cell AS cell", "most", "counted", "gap", "reach", "c_weight",
            f"carrier AND c_cell = {_FAN} * cell AS carrier", f"counting AND gap < {near} AS counting" if near else "counting",
            "monotonically_increasing_id() AS _row",
        )
        # What neither counts nor may be nearest leaves before the rows of an id are looked at together. The row number keeps the
        # optimizer from moving the filter below the bounds, which it would have to repeat there in full.
        open_ = measured.filter(f"(counting OR carrier{' OR gap <= most' * seek}) AND _row >= 0")
        told = open_.selectExpr(
            *_CARRY, "cell", "gap", "carrier",
            f"least(most, min(reach) {every}) AS most" if seek else "most",
            f"counted + sum(IF(counting AND reach < {near}, c_weight, 0L)) {every} AS counted" if near else "counted",
            f"counting AND reach >= {near} AS counting" if near else "counting",
            f"_row = min(IF(counting AND reach >= {near}, _row, NULL)) {every} AS lead" if near else "true AS lead",
        )
        rows = told.filter("counting OR carrier" + " OR gap <= most" * seek).drop("gap")
    return rows


def _candidates(probes: DataFrame, index: ShapeIndex, near: str | None, seek: bool) -> DataFrame:
    """Probes with the shapes of the leaves that the descent has left open."""
    return _descend(probes, index.levels, near, seek).join(_shapes(index), _below())


def _nearest_points(lines: DataFrame, index: ShapeIndex) -> DataFrame:
    """``id, metres`` of lines of two vertices, from an index of points."""
    pairs = _candidates(lines, index, None, True).withColumn("c_spot", F.lit(True))
    return G.with_plain_distance(pairs, "", "c_", "metres").groupBy("id").agg(F.expr("min(metres) AS metres"))


def _points_within(lines: DataFrame, index: ShapeIndex, near: str) -> DataFrame:
    """``id, hits`` of lines of two vertices, from an index of points: the open tiles of every line meet their leaves and points in
    one shuffle, whatever their number."""
    rows = _descend(lines, index.levels[:-1], near, False)
    # One row of every id bears its count; where no tile is open, that which has followed the first cells.
    rows = rows.filter("counting OR (carrier AND lead IS NULL AND counted > 0)").selectExpr(
        "id", "key", *G.ENDS, "cell", "counted", "counting", "coalesce(lead, carrier) AS bearer"
    )
    tiles = index.tiles.selectExpr("key AS c_key", "tile AS c_at", "leaves").hint("shuffle_hash")
    kept = ["id", *G.ENDS, "counted"]
    leaf = ", ".join(["first", *[f"c_{s}" for s in G.SIDES], "c_low", "c_high", "held", "points"])
    leaves = rows.join(tiles, _below()).selectExpr(*kept, "counting", "bearer", f"inline(leaves) AS ({leaf})")
    # Row numbers keep filters above what they judge by, as in the descent.
    told = G.with_line_bounds(leaves, "", "c_").selectExpr(
        *kept, "bearer AND first AS bears", f"counting AND gap < {near} AS open", f"counting AND reach < {near} AS whole", "held", "points",
        "monotonically_increasing_id() AS _row",
    )
    # A leaf in reach as a whole, or one that only bears the count, is a row without a point.
    points = told.filter("(open OR bears) AND _row >= 0").selectExpr(*kept, "bears", "whole", "held", "IF(open AND NOT whole, points, NULL) AS points")
    points = points.selectExpr(*kept, "bears", "whole", "held", "inline_outer(points) AS (c_ax, c_ay, c_k, c_weight)")
    spots = points.selectExpr("*", "false AS spot", "true AS c_spot", "c_ax AS c_bx", "c_ay AS c_by")
    pairs = G.with_plain_distance(spots, "", "c_", "metres", cosine="c_k").selectExpr(
        "id", "counted", "bears", f"CASE WHEN whole THEN held WHEN metres < {near} THEN c_weight ELSE 0L END AS hits", "monotonically_increasing_id() AS _row"
    )
    hits = pairs.filter("(bears OR hits > 0) AND _row >= 0")
    return hits.groupBy("id").agg(F.expr("max(counted) + sum(hits) AS hits"))


def _search(df: DataFrame, index: ShapeIndex, identifier: str, geom: str, metres: float | None, seek: bool, key: str | None) -> DataFrame:
    """``id, metres, hits`` for every id of ``df``."""
    near = f"{float(metres)!r}D" if metres is not None else None
    probes = _probes(df, identifier, geom, key)
    if index.tiles is None:
        told = _found(probes, index, near, seek)
    else:
        edge = "plain AND NOT spot"
        lines = probes.filter(edge).withColumns({"plain": F.lit(True), "spot": F.lit(False), "probe": F.lit(None).cast(G.GEOMETRY_TYPE)})
        parts = [_found(probes.filter(f"NOT ({edge})"), index, near, seek)]
        if seek:
            parts.append(_nearest_points(lines, index).selectExpr("id", "metres", "0L AS hits"))
        if near:
            parts.append(_points_within(lines, index, near).selectExpr("id", "CAST(NULL AS DOUBLE) AS metres", "hits"))
        told = reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.expr("min(metres) AS metres"), F.expr("sum(hits) AS hits"))
    # All ids, so that those without a hit or a shape are in the result.
    return df.selectExpr(f"{identifier} AS id").distinct().join(told, "id", "left").selectExpr(f"id AS {identifier}", "metres", "coalesce(hits, 0L) AS hits")


def _found(probes: DataFrame, index: ShapeIndex, near: str | None, seek: bool) -> DataFrame:
    """``id, metres, hits`` of shapes of any kind, without the ids that meet no leaf."""
    pairs = _candidates(probes, index, near, seek)
    quick = G.with_plain_distance(pairs, "", "c_", "quick")
    # Other shapes are worth the long way only where their boxes leave it open.
    shapes = [f"IF({p}plain, {G.rebuilt(p)}, {g})" for p, g in (("", "probe"), ("c_", "c_shape"))]
    wanted = [f"counting AND slack < {near}"] * bool(near) + ["slack <= most"] * seek
    slack = quick.selectExpr("*", "(plain AND c_plain AND (spot OR c_spot)) AS _quick").selectExpr(
        "id", "counted", "counting", "c_weight", "quick", f"IF(_quick, NULL, {G.box_gap('', 'c_')}) AS slack", "most", "_quick",
        *[f"IF(_quick, NULL, {s}) AS {n}" for s, n in zip(shapes, ("_p", "_q"))],
    )
    long_way = F.when(F.expr(" OR ".join(wanted)), G.distance("_p", "_q"))
    exact = slack.select("id", "counted", "counting", "c_weight", F.when(F.col("_quick"), F.col("quick")).otherwise(long_way).alias("metres"))
    hits = exact.selectExpr("id", "metres", "counted", f"IF(counting AND metres < {near}, c_weight, 0L) AS hits" if near else "0L AS hits")
    return hits.groupBy("id").agg(F.expr("min(metres) AS metres"), F.expr("max(counted) + sum(hits) AS hits"))


def nearest_and_count(df: DataFrame, index: ShapeIndex | None, identifier: str, geom: str, metres: float, closest: str, near: str, key: str | None = None) -> DataFrame:
    """For every id of ``df`` the distance to the nearest indexed item in metres (NULL without any) as ``closest``, and the
    number of items nearer than ``metres`` as ``near``, from one search.

    With ``key``, the column that goes with the key of the index, only items of the same key are looked at.
    """
    if index is None:
        return df.selectExpr(identifier, f"CAST(NULL AS DOUBLE) AS {closest}", f"0L AS {near}").distinct()
    return _search(df, index, identifier, geom, metres, True, key).selectExpr(identifier, f"metres AS {closest}", f"hits AS {near}")


def count_within(df: DataFrame, index: ShapeIndex | None, identifier: str, geom: str, metres: float, out: str, key: str | None = None) -> DataFrame:
    """For every id of ``df`` the number of indexed items nearer than ``metres``, 0 without any."""
    if index is None:
        return df.selectExpr(identifier, f"0L AS {out}").distinct()
    return _search(df, index, identifier, geom, metres, False, key).selectExpr(identifier, f"hits AS {out}")


def nearest(df: DataFrame, index: ShapeIndex | None, identifier: str, geom: str, out: str, key: str | None = None) -> DataFrame:
    """For every id of ``df`` the distance to the nearest indexed item in metres, NULL without any."""
    if index is None:
        return df.selectExpr(identifier, f"CAST(NULL AS DOUBLE) AS {out}").distinct()
    return _search(df, index, identifier, geom, None, True, key).selectExpr(identifier, f"metres AS {out}")


def meeting_candidates(df: DataFrame, index: ShapeIndex, identifier: str, geom: str, key: str | None = None) -> DataFrame:
    """Probes with the shapes that they may meet, judged by boxes and by lines against boxes from either side."""
    rows = _probes(df, identifier, geom, key).withColumn("cell", F.lit(0).cast("bigint"))
    for cells in index.levels:
        joined = rows.join(_children(cells), _below() & F.expr(G.may_meet("", "c_")))
        rows = joined.selectExpr(*_CARRY, "c_cell AS cell")
    return rows.join(_shapes(index), _below() & F.expr(f"{G.may_meet('', 'c_')} AND {G.may_meet('c_', '')}"))


def intersecting(df: DataFrame, index: ShapeIndex | None, identifier: str, geom: str, key: str | None = None) -> DataFrame:
    """The ids of ``df`` whose shape meets at least one indexed item."""
    if index is None:
        return df.select(identifier).limit(0)
    pairs = meeting_candidates(df, index, identifier, geom, key)
    shapes = [f"IF({p}plain, {G.rebuilt(p)}, {g}) AS {n}" for p, g, n in (("", "probe", "_p"), ("c_", "c_shape", "_q"))]
    hits = pairs.selectExpr("id", *shapes).filter(G.intersects("_p", "_q"))
    return hits.select(F.col("id").alias(identifier)).distinct()
