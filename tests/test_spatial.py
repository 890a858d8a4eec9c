from __future__ import annotations

import math
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.operators import spatial
from tessera.session import planned_bytes

R = 6371008.8


# Plain arithmetic


def hav(p, q):
    (x1, y1), (x2, y2) = p, q
    h = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(min(1, h)))


def to_edge(p, a, b):
    k = math.cos(math.radians(p[1]))
    ax, ay, dx, dy = (a[0] - p[0]) * k, a[1] - p[1], (b[0] - a[0]) * k, b[1] - a[1]
    length = dx * dx + dy * dy
    t = max(0.0, min(1.0, -(ax * dx + ay * dy) / length)) if length else 0.0
    return math.hypot(ax + t * dx, ay + t * dy) * math.pi / 180 * R


def edges(pts):
    return list(zip(pts, pts[1:])) or [(pts[0], pts[0])]


def turn(o, a, b):
    v = (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    return (v > 0) - (v < 0)


def cross(e, f):
    for i in (0, 1):
        if min(e[0][i], e[1][i]) > max(f[0][i], f[1][i]) or min(f[0][i], f[1][i]) > max(e[0][i], e[1][i]):
            return False
    return turn(*e, f[0]) * turn(*e, f[1]) <= 0 and turn(*f, e[0]) * turn(*f, e[1]) <= 0


def inside(p, shape):
    kind, pts = shape
    hit = False
    for a, b in edges(pts):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]):
            hit = not hit
    return kind == "polygon" and hit


def meets(s, t):
    return any(cross(e, f) for e in edges(s[1]) for f in edges(t[1])) or inside(s[1][0], t) or inside(t[1][0], s)


def apart(s, t):
    vertices = lambda a, b: min(to_edge(p, *e) for p in a[1] for e in edges(b[1]))
    kinds = {s[0], t[0]}
    if kinds == {"point"}:
        return hav(s[1][0], t[1][0])
    if kinds == {"point", "line"}:
        return vertices(s, t) if s[0] == "point" else vertices(t, s)
    if meets(s, t):
        return 0.0
    if s[0] == "point":
        return vertices(s, t)
    if t[0] == "point":
        return vertices(t, s)
    return min(vertices(s, t), vertices(t, s))


def shape(rng, kind, x, y, size):
    jitter = lambda: (x + rng.uniform(-size, size), y + rng.uniform(-size, size))
    if kind == "point":
        return "point", [(x, y)]
    if kind == "line":
        return "line", [jitter() for _ in range(rng.randint(2, 4))]
    a = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 5)))
    ring = [(x + size * math.cos(v), y + size * math.sin(v)) for v in a]
    return "polygon", [*ring, ring[0]]


def shapes(seed, n, kinds, hot=1 / 3):
    """A third of the shapes crowd into one spot; some are the same shape again."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        crowded = rng.random() < hot
        x, y = (-92 + rng.gauss(0, 0.001), 39 + rng.gauss(0, 0.001)) if crowded else (rng.uniform(-96, -88), rng.uniform(36, 42))
        out.append((i, f"k{rng.randrange(3)}", shape(rng, rng.choice(kinds), x, y, rng.choice([0.0005, 0.02, 0.5]))))
    return out + [(n + j, k, s) for j, (_, k, s) in enumerate(out[:5])]


def frame(spark, rows):
    data = [(i, k, (s[0], [tuple(p) for p in s[1]])) for i, k, s in rows]
    return spark.createDataFrame(data, f"id int, k string, geom {G.GEOMETRY_TYPE}")


MIXES = [(("line",), ("point",)), (("line",), ("line", "point")), (("point",), ("point",)), (("line", "polygon", "point"), ("polygon", "line", "point"))]


@pytest.mark.parametrize("mix", MIXES)
def test_search_against_all_pairs(spark, join_mode, mix):
    probes, items = shapes(1, 120, mix[0]), shapes(2, 250, mix[1])
    left, right = frame(spark, probes), frame(spark, items)
    index = spatial.build_index(right, "geom")
    assert index.depth > 0
    gaps = {i: [(apart(s, t), k == kk) for _, kk, t in items] for i, k, s in probes}
    closest = {r.id: r.m for r in spatial.nearest(left, index, "id", "geom", "m").collect()}
    assert closest.keys() == gaps.keys()
    for i, all_gaps in gaps.items():
        assert closest[i] == pytest.approx(min(g for g, _ in all_gaps), rel=1e-9, abs=1e-5)
    for metres in (100.0, 60000.0):
        near = {r.id: r.n for r in spatial.count_within(left, index, "id", "geom", metres, "n").collect()}
        assert near == {i: sum(g < metres for g, _ in all_gaps) for i, all_gaps in gaps.items()}
    found = {r.id for r in spatial.intersecting(left, index, "id", "geom").collect()}
    assert found == {i for i, _, s in probes if any(meets(s, t) for _, _, t in items)}


def test_search_within_a_key(spark, join_mode):
    probes, items = shapes(3, 80, ("line",)), shapes(4, 200, ("point",))
    items = [r for r in items if r[1] != "k2"]
    left = frame(spark, probes)
    index = spatial.build_index(frame(spark, items), "geom", key="k")
    gaps = {i: [apart(s, t) for _, kk, t in items if kk == k] for i, k, s in probes}
    near = {r.id: r.n for r in spatial.count_within(left, index, "id", "geom", 20000.0, "n", key="k").collect()}
    assert near == {i: sum(g < 20000 for g in gs) for i, gs in gaps.items()}
    closest = {r.id: r.m for r in spatial.nearest(left, index, "id", "geom", "m", key="k").collect()}
    for i, gs in gaps.items():
        assert closest[i] == (pytest.approx(min(gs), rel=1e-9, abs=1e-5) if gs else None)


def test_nothing_to_find(spark):
    left = frame(spark, shapes(5, 10, ("line",)))
    index = spatial.build_index(left.limit(0), "geom")
    assert index is None
    assert {r.n for r in spatial.count_within(left, index, "id", "geom", 1.0, "n").collect()} == {0}
    assert {r.m for r in spatial.nearest(left, index, "id", "geom", "m").collect()} == {None}
    assert spatial.intersecting(left, index, "id", "geom").count() == 0


def test_plans_have_no_nested_loops(spark):
    left = frame(spark, shapes(6, 30, ("line",)))
    index = spatial.build_index(left, "geom")
    plans = [spatial.count_within(left, index, "id", "geom", 1.0, "n"), spatial.nearest(left, index, "id", "geom", "m")]
    for df in (*plans, spatial.intersecting(left, index, "id", "geom")):
        text = plan_of(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def around_the_line(seed, n):
    """Points on both sides of the antimeridian."""
    rng = random.Random(seed)
    side = lambda: rng.choice([179.99 - rng.random() ** 3, -179.99 + rng.random() ** 3])
    return [(i, "k", ("point", [(side(), rng.uniform(-60, 60))])) for i in range(n)]


def test_search_across_the_antimeridian(spark, join_mode):
    probes, items = around_the_line(11, 60), around_the_line(12, 300)
    left, index = frame(spark, probes), spatial.build_index(frame(spark, items), "geom")
    gaps = {i: [hav(s[1][0], t[1][0]) for _, _, t in items] for i, _, s in probes}
    closest = {r.id: r.m for r in spatial.nearest(left, index, "id", "geom", "m").collect()}
    assert closest == {i: pytest.approx(min(g), rel=1e-9, abs=1e-5) for i, g in gaps.items()}
    for metres in (50_000.0, 900_000.0):
        near = {r.id: r.n for r in spatial.count_within(left, index, "id", "geom", metres, "n").collect()}
        assert near == {i: sum(g < metres for g in gs) for i, gs in gaps.items()}


def test_point_to_line_across_the_antimeridian(spark):
    rows = [(1, ("line", [(-179.9, 10.0), (-179.5, 10.0)]), ("point", [(179.9, 10.0)]))]
    data = [(i, (a[0], a[1]), (b[0], b[1])) for i, a, b in rows]
    df = spark.createDataFrame(data, f"id int, a {G.GEOMETRY_TYPE}, b {G.GEOMETRY_TYPE}")
    metres = df.select(G.distance("a", "b").alias("m")).first().m
    assert metres == pytest.approx(hav((179.9, 10.0), (-179.9, 10.0)), rel=1e-3)


def test_rows_without_a_shape(spark, join_mode):
    left = frame(spark, shapes(7, 20, ("line",))).unionByName(spark.createDataFrame([(99, "k0", None)], f"id int, k string, geom {G.GEOMETRY_TYPE}"))
    items = frame(spark, shapes(8, 40, ("point",))).unionByName(spark.createDataFrame([(99, "k0", None)], f"id int, k string, geom {G.GEOMETRY_TYPE}"))
    index = spatial.build_index(items, "geom")
    near = {r.id: r.n for r in spatial.count_within(left, index, "id", "geom", 1e7, "n").collect()}
    assert near[99] == 0 and near[0] == 45
    closest = {r.id: r.m for r in spatial.nearest(left, index, "id", "geom", "m").collect()}
    assert closest[99] is None and closest[0] is not None
    assert 99 not in {r.id for r in spatial.intersecting(left, index, "id", "geom").collect()}


def test_cells_are_cut_by_their_own_crowding(spark):
    """A cluster a millionth of a degree wide in a wide extent, and a spot with several shapes on one centre."""
    cluster = spark.range(20_000).selectExpr("-92 + id % 150 * 1e-8 AS lon", "39 + floor(id / 150) * 1e-8 AS lat")
    wide = spark.createDataFrame([(-170.0, -60.0), (170.0, 60.0)], "lon double, lat double")
    spot = spark.range(40).select(G.line(("-50D - id", "10D"), ("-50D + id", "10D")).alias("geom"))
    items = cluster.unionByName(wide).select(G.point("lon", "lat").alias("geom")).unionByName(spot)
    index = spatial.build_index(items, "geom")
    sizes = index.leaves.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.expr("x0 + x1")).alias("low"), F.max(F.expr("x0 + x1")).alias("high"))
    assert sizes.filter("n > 16 AND low < high").count() == 0
    assert sizes.agg(F.sum("n")).first()[0] == 20_042
    assert index.depth <= 8


def test_crowded_items_are_counted_by_cell(spark):
    """Far more items in reach than are looked at one by one."""
    items = spark.range(20_000).selectExpr("id", "-92 + pmod(id, 141) * 1e-5 AS lon", "39 + pmod(id * 7, 149) * 1e-5 AS lat")
    index = spatial.build_index(items.select("id", G.point("lon", "lat").alias("geom")), "geom")
    probe = frame(spark, [(1, "k", ("line", [(-92.01, 39.0), (-91.99, 39.001)]))])
    near = spatial.count_within(probe, index, "id", "geom", 30000.0, "n")
    assert near.first().n == 20_000
    assert "c_shape" in plan_of(near)


def test_a_slanting_line_looks_at_few_shapes(spark):
    """A long slanting line past, and through, a dense cluster under its box."""
    cluster = spark.range(20_000).selectExpr("-92 + pmod(id, 141) * 1e-4 AS lon", "39 + pmod(id * 7, 149) * 1e-4 AS lat")
    index = spatial.build_index(cluster.select(G.point("lon", "lat").alias("geom")), "geom")
    # Long lines, and the short parts of them that come close.
    past, past_short = ("line", [(-97.0, 35.0), (-87.0, 44.9)]), ("line", [(-92.5, 39.455), (-92.4, 39.554)])
    through, through_short = ("line", [(-97.0, 34.0), (-87.0, 44.0)]), ("line", [(-92.02, 38.98), (-91.96, 39.04)])
    for long, short in ((past, past_short), (through, through_short)):
        seen = []
        for probe in (long, short):
            left = frame(spark, [(1, "k", probe)])
            near = spatial._candidates(spatial._probes(left, "id", "geom", None), index, "30D", True)
            seen.append((near.count(), spatial.meeting_candidates(left, index, "id", "geom").count()))
        assert seen[0][0] <= 1.1 * seen[1][0] + 100 and seen[0][1] <= 1.1 * seen[1][1] + 100 and seen[0][0] < 4_000
    spots = [(r.lon, r.lat) for r in cluster.collect()]
    gaps = [apart(past, ("point", [p])) for p in spots]
    got = spatial.nearest_and_count(frame(spark, [(1, "k", past)]), index, "id", "geom", 90_000.0, "m", "n").first()
    assert got.m == pytest.approx(min(gaps), rel=1e-9) and got.n == sum(g < 90_000 for g in gaps)


def test_one_search_gives_both_answers(spark, join_mode):
    probes, items = shapes(21, 60, ("line", "polygon", "point")), shapes(22, 400, ("line", "point", "polygon"))
    left, index = frame(spark, probes), spatial.build_index(frame(spark, items), "geom")
    got = {r.id: (r.m, r.n) for r in spatial.nearest_and_count(left, index, "id", "geom", 50_000.0, "m", "n").collect()}
    for i, _, s in probes:
        gaps = [apart(s, t) for _, _, t in items]
        assert got[i][0] == pytest.approx(min(gaps), rel=1e-9, abs=1e-5) and got[i][1] == sum(g < 50_000 for g in gaps)


def test_several_indexes_from_one_numbering(spark):
    first, second = shapes(31, 40, ("point",)), shapes(32, 3_000, ("point",))
    found = spatial.build_indexes({"a": (frame(spark, first), "geom", "k"), "b": (frame(spark, second), "geom", None), "c": (frame(spark, first).limit(0), "geom", None)})
    assert found["c"] is None and found["a"].depth == 1 and found["b"].depth == 2
    for name, items, key in (("a", first, "k"), ("b", second, None)):
        left = frame(spark, first)
        near = {r.id: r.n for r in spatial.count_within(left, found[name], "id", "geom", 80_000.0, "n", key=key).collect()}
        assert near == {i: sum(apart(s, t) < 80_000 for _, kk, t in items if key is None or kk == k) for i, k, s in first}


def test_points_in_reach_meet_lines_in_one_shuffle(spark):
    """Lines leave the descent at tiles, so that their rows are not shuffled for every leaf; levels are planned by their own bytes."""
    items = spark.range(20_000).selectExpr("id", "-92 + pmod(id, 141) * 1e-3 AS lon", "39 + pmod(id * 7, 149) * 1e-3 AS lat")
    index = spatial.build_index(items.select("id", G.point("lon", "lat").alias("geom")), "geom")
    sizes = [planned_bytes(cells) for cells in index.levels]
    assert sizes[0] < sizes[-1] < planned_bytes(index.leaves)
    held = index.tiles.selectExpr("tile", "size(leaves) AS n", "aggregate(leaves, 0L, (a, l) -> a + l.weight) AS weight").collect()
    assert sum(r.weight for r in held) == 20_000 and max(r.n for r in held) <= 64 and len(held) == -(-20_000 // 1024)
    rows = [(i, "k", ("line", [(-92.0 + i * 0.01, 39.0), (-91.9 + i * 0.005, 39.1 - i * 0.01)])) for i in range(8)]
    left = frame(spark, rows)
    rim = spatial._descend(spatial._probes(left, "id", "geom", None), index.levels[:-1], "2000D", False)
    assert rim.filter("counting").groupBy("id").count().agg(F.max("count")).first()[0] <= len(held)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spots = [(r.lon, r.lat) for r in items.collect()]
    try:
        spark.conf.set(conf, str(max(sizes)))  # the levels fit, the leaves do not
        near = spatial.count_within(left, index, "id", "geom", 2000.0, "n")
        assert "ShuffledHashJoin" in plan_of(near)
        got = {r.id: r.n for r in near.collect()}
    finally:
        spark.conf.set(conf, before)
    assert got == {i: sum(apart(s, ("point", [p])) < 2000 for p in spots) for i, _, s in rows}


def test_mixed_probes_and_repeated_ids_over_points(spark, join_mode):
    """Points, lines and polygons as probes, one line without length, some ids twice: their rows add up."""
    probes = shapes(41, 40, ("line", "point", "polygon")) + [(100, "k0", ("line", [(-92.0, 39.0), (-92.0, 39.0)]))]
    probes += [(0, k, s) for _, k, s in shapes(42, 3, ("line",))]
    items = shapes(43, 1_500, ("point",))
    left, index = frame(spark, probes), spatial.build_index(frame(spark, items), "geom")
    assert index.tiles is not None
    got = {r.id: (r.m, r.n) for r in spatial.nearest_and_count(left, index, "id", "geom", 40_000.0, "m", "n").collect()}
    gaps = {}
    for i, _, s in probes:
        gaps.setdefault(i, []).extend(apart(s, t) for _, _, t in items)
    assert got == {i: (pytest.approx(min(g), rel=1e-9, abs=1e-5), sum(x < 40_000 for x in g)) for i, g in gaps.items()}


def test_deeper_indexes_need_no_more_sorts(spark):
    """Probes come in the order of their ids, which is kept from level to level."""
    left, seen = frame(spark, shapes(51, 30, ("line",))), []
    for n in (100, 1_500):
        index = spatial.build_index(frame(spark, shapes(52, n, ("point",))), "geom")
        text = plan_of(spatial.nearest(left, index, "id", "geom", "m"))
        seen.append((index.depth, text.count("Window ["), text.count("Sort [")))
    assert seen[0][0] < seen[1][0] and seen[0][1] < seen[1][1] and seen[0][2] == seen[1][2]
