import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from viaduct.functions.projection import STATE_PLANE_2263, LambertConformal
from viaduct.operators.geometry import centroids, ring_edges
from viaduct.operators.spatial import fitting_cell, locate, polygon_cells

SCHEMA = "id_zona int, anillo int, hoyo boolean, orden int, x double, y double"


def ring(zone, number, points, hole=False):
    return [(zone, number, hole, i, float(x), float(y)) for i, (x, y) in enumerate(points)]


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6)]
SHAPES = (
    ring(1, 0, SQUARE) + ring(2, 0, SQUARE[::-1]) + ring(2, 1, HOLE, True) + ring(3, 0, [(20, 0), (30, 0), (30, 10), (25, 3), (20, 10)])
    + ring(4, 0, [(0, 0), (5, 5), (9, 9)]) + ring(5, 0, [(1, 1)]) + ring(6, 0, [(0, 0), (3, 3)]) + ring(7, 0, HOLE) + ring(7, 1, HOLE, True)
    + ring(8, 0, [(-50.125, -50), (-40, -50), (-40, -40)]) + ring(8, 5, [(-30, -50), (-20, -50), (-20, -30), (-30, -30)]) + ring(9, 0, [*SQUARE, SQUARE[0]])
)


def zones(spark, rows=SHAPES):
    return ring_edges(spark.createDataFrame(rows, SCHEMA).repartition(4))


def by_shoelace(rows):
    rings = {}
    for z, a, hole, _, x, y in rows:
        rings.setdefault((z, a, hole), []).append((x, y))
    out = {}
    for (z, _, hole), p in rings.items():
        c = [(x1 * y2 - x2 * y1, x1 + x2, y1 + y2) for (x1, y1), (x2, y2) in zip(p, p[1:] + p[:1], strict=True)]
        area, mx, my = sum(k for k, _, _ in c) / 2, sum(k * s for k, s, _ in c) / 6, sum(k * s for k, _, s in c) / 6
        sign = math.copysign(1, area) * (-1 if hole else 1)
        t = out.setdefault(z, [0, 0, 0])
        out[z] = [t[0] + sign * area, t[1] + sign * mx, t[2] + sign * my]
    return {z: (a, mx / a if a > 1e-9 else None, my / a if a > 1e-9 else None) for z, (a, mx, my) in out.items()}


def test_centroids(spark):
    got = {r.id_zona: (r.area, r.x, r.y) for r in centroids(zones(spark)).collect()}
    want = by_shoelace(SHAPES)
    assert set(got) == set(want)
    for z, w in want.items():
        assert got[z] == pytest.approx(w, abs=1e-9) if w[1] is not None else got[z] == (0.0, None, None)
    assert got[2][:1] == (96.0,) and got[4] == (0.0, None, None) and got[7] == (0.0, None, None)


def test_vertices_without_place_are_left_out(spark):
    odd = [(None, 0, False, 0, 1.0, 1.0), (11, 0, False, 0, None, 1.0)]
    assert {r.id_zona for r in centroids(zones(spark, SHAPES[:4] + odd)).collect()} == {1}
    assert centroids(zones(spark, [])).collect() == []


def inside(x, y, rows):
    """Even-odd rule by plain loops; edges are inside."""
    rings, odd = {}, False
    for _, a, _, _, px, py in rows:
        rings.setdefault(a, []).append((px, py))
    for p in rings.values():
        for (x1, y1), (x2, y2) in zip(p, p[1:] + p[:1], strict=True):
            d = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if d == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (d > 0) == (y2 > y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.75, 4.0, 1000.0])
def test_points_to_zones(spark, cell):
    points = [(i, x / 2, y / 2) for i, (x, y) in enumerate((x, y) for x in range(-104, 64, 3) for y in range(-102, 24, 3))]
    points += [(10_001, 4.0, 5.0), (10_002, 5.0, 5.0), (10_003, 0.0, 0.0), (10_004, 10.0, 10.0), (10_005, None, 1.0), (10_006, float("nan"), 1.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame([(i, x, y, "z") for i, x, y in points], "id long, x double, y double, id_zona_ string").repartition(5)
    got = {r.id: r.id_zona for r in locate(df, zones(spark), cell).collect()}
    by_zone = {}
    for r in SHAPES:
        by_zone.setdefault(r[0], []).append(r)
    for i, x, y in points:
        known = x is not None and not math.isnan(x)
        assert got[i] == (next((z for z in sorted(by_zone) if inside(x, y, by_zone[z])), None) if known else None), (x, y)
    assert len(got) == len(points)


def test_no_polygon_meets_all_points(spark):
    """One equi-join on the cell: no cross join, no nested loop, no grouping of points."""
    points = spark.range(1000).select((F.col("id") % 40 - 5).cast("double").alias("x"), (F.col("id") % 13).cast("double").alias("y"))
    plan = locate(points, zones(spark), 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert polygon_cells(zones(spark), 2.0).groupBy("_cx", "_cy").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("cone", [STATE_PLANE_2263, LambertConformal(49, 44, 46.5, 3, 700_000, 6_600_000, 1.0, 6378137, 298.257222101),
                                  LambertConformal(-18, -36, 0, 134, 0, 0, 1.0, 6378137, 298.257223563), LambertConformal(40, 40, 40, 0, 0, 0, 1.0, 6378137, 298.25)])
def test_projection_round_trip(spark, cone):
    random = np.random.default_rng(2)
    rows = [(float(cone.lon_0 + a), float(cone.lat_1 + b)) for a, b in random.uniform(-8, 8, (500, 2))] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    x, y = cone.forward(F.col("lon"), F.col("lat"))
    lon, lat = cone.inverse(F.col("x"), F.col("y"))
    for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", lon.alias("lon_"), lat.alias("lat_")).collect():
        if r.lon is None:
            assert r.lon_ is None
        else:
            assert abs(r.lon - r.lon_) < 1e-9 and abs(r.lat - r.lat_) < 1e-9


def test_projection_origin_and_scale(spark):
    """The origin keeps its false coordinates; on the standard parallels a degree of longitude has its true length."""
    p = STATE_PLANE_2263
    df = spark.createDataFrame([(p.lon_0, p.lat_0), (p.lon_0 - 0.0005, p.lat_1), (p.lon_0 + 0.0005, p.lat_1)], "lon double, lat double")
    x, y = p.forward(F.col("lon"), F.col("lat"))
    a, b, c = df.select(x.alias("x"), y.alias("y")).collect()
    assert a.x == pytest.approx(p.x_0 / p.unit, abs=1e-6) and a.y == pytest.approx(0, abs=1e-6)
    lat, e = math.radians(p.lat_1), p.eccentricity
    length = math.radians(0.001) * p.semi_major * math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)
    assert math.hypot(c.x - b.x, c.y - b.y) * p.unit == pytest.approx(length, rel=1e-7)


def by_edges(x, y, edges):
    """Smallest zone by the even-odd rule over its edges as they are, closed or not."""
    odd, touched = {}, set()
    for z, x1, y1, x2, y2 in edges:
        d = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if d == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            touched.add(z)
        if (y1 > y) != (y2 > y) and (d > 0) == (y2 > y1):
            odd[z] = odd.get(z, 0) + 1
    return min(touched | {z for z, n in odd.items() if n % 2}, default=None)


@pytest.mark.parametrize(("seed", "cell"), [(1, 0.7), (2, 1.3), (3, 2.0), (4, 9.0), (5, None)])
def test_points_to_odd_polygons(spark, seed, cell):
    """Crossing rings, level and long edges, corners on cell sides, holes outside, missing and repeated vertices, rings of one another's zone."""
    random = np.random.default_rng(seed)
    rows = []
    for z in range(12):
        scale = (1.0, 0.5, 0.3)[z % 3]
        for a in range(1 + z % 3):
            corners = random.integers(-12, 13, (int(random.integers(1, 14)), 2)) * scale + (z % 4) * 3
            rows += ring(z, a, corners.tolist(), hole=a > 0)
    rows += ring(20, 0, [(-3, -3), (12, -3), (12, 9), (5, 9), (5, -1), (-3, 8)])
    rows += [r for r in ring(21, 0, [(0, 0), (9, 1), (11, 6), (4, 10), (-2, 5)]) if r[3] != 2] + ring(22, 0, [(0, 0), (7, 0), (7, 7), (0, 7)]) + [(22, 0, False, 2, 3.0, 9.0)]
    edges = ring_edges(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()
    own = [(r.id_zona, r.x1, r.y1, r.x2, r.y2) for r in edges.collect()]
    places = np.concatenate([random.integers(-40, 60, (1500, 2)) / 2, random.uniform(-15, 25, (1500, 2)), [e[1:3] for e in own]]).tolist()
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "id long, x double, y double")
    got = {r.id: r.id_zona for r in locate(points, edges, cell or fitting_cell(edges, 50.0)).collect()}
    # Of an open ring the places beside its box aren't defined.
    boxes = {z: [f(e[i] for e in own if e[0] == z) for f, i in ((min, 1), (min, 2), (max, 1), (max, 2))] for z in {e[0] for e in own}}
    boxes = {z: (min(b[0], *[e[3] for e in own if e[0] == z]), b[1], max(b[2], *[e[3] for e in own if e[0] == z]), b[3]) for z, b in boxes.items()}
    for i, (x, y) in enumerate(places):
        near = {e[0] for e in own if e[0] not in (21, 22) or boxes[e[0]][0] <= x <= boxes[e[0]][2]}
        beside = {e[0] for e in own} - near
        if got[i] not in beside:
            assert got[i] == by_edges(x, y, [e for e in own if e[0] in near]), (x, y)


def test_tests_per_point_do_not_grow_with_the_edges(spark):
    """A point meets few edges however many its zone has; cells and pairs grow in proportion to the edges."""
    for n in (1000, 8000):
        turn = np.arange(n) * 2 * np.pi / n
        far = 900 - np.arange(n) * 37 % 300
        edges = ring_edges(spark.createDataFrame(ring(1, 0, np.stack([far * np.cos(turn), far * np.sin(turn)], 1).tolist()), SCHEMA)).cache()
        cells = polygon_cells(edges, fitting_cell(edges, 100.0)).select(F.size(F.col("zonas")[0].lados).alias("n"))
        c = cells.agg(F.max("n").alias("most"), F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("cells")).first()
        assert c.most <= n / 20 and c.pairs <= 20 * n and c.cells <= 20 * n
