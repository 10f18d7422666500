"""Kernels: measures, predicates at boundaries, areas, projections, grids."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsight.functions import crs, grid
from gridsight.functions import geometry as G


def box(cx: float, cy: float, length: float, width: float, angle: float) -> list[float]:
    u = (math.cos(math.radians(angle)), math.sin(math.radians(angle)))
    out = []
    for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1)):
        out += [cx + a * length / 2 * u[0] - b * width / 2 * u[1], cy + a * length / 2 * u[1] + b * width / 2 * u[0]]
    return out


def boxes(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, " + ", ".join(f"{c} double" for c in G.CORNERS))


def test_measures(spark):
    got = boxes(spark, [box(25496000, 6673000, 16, 2.5, 0), box(0, 0, 2.5, 16, 0), box(0, 0, 10, 3, 30)]).select(G.length_m(), G.width_m(), G.heading_deg()).collect()
    for row, want in zip(got, [(16, 2.5, 90), (16, 2.5, 0), (10, 3, 60)], strict=True):
        assert tuple(row) == pytest.approx(want, abs=1e-6)


SQUARE_WITH_HOLE = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]
CONCAVE = [[(0, 0), (10, 0), (10, 10), (5, 5), (0, 10)]]


def edges(rings):
    flat = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    return F.array(*[F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(e, ("ax", "ay", "bx", "by"), strict=True)]) for e in flat])


@pytest.mark.parametrize(("rings", "inside", "border", "outside"), [
    (SQUARE_WITH_HOLE, [(1, 1), (5, 3)], [(0, 5), (10, 10), (4, 5), (6, 6)], [(5, 5), (-1, 5), (11, 11)]),
    (CONCAVE, [(1, 5), (5, 4), (9, 8)], [(5, 5), (0, 0), (7, 7)], [(5, 8), (5, 10), (-1, 0)]),
])
def test_points_and_polygons(spark, rings, inside, border, outside):
    shape = edges(rings)
    points = spark.createDataFrame([(float(x), float(y), k) for k, group in enumerate((inside, border, outside)) for x, y in group], "x double, y double, kind int")
    x, y = F.col("x"), F.col("y")
    for r in points.select("kind", G.inside_strict(x, y, shape).alias("strict"), G.inside_touch(x, y, shape).alias("touch"), G.distance(x, y, shape).alias("d")).collect():
        assert (r["strict"], r["touch"]) == ((True, True), (False, True), (False, False))[r["kind"]]
        assert (r["d"] > 0) == (r["kind"] == 2)


def test_touching_polygons(spark):
    one = edges([[(0, 0), (4, 0), (4, 4), (0, 4)]])
    cases = {"apart": [[(5, 0), (6, 0), (6, 1)]], "corner": [[(4, 4), (6, 4), (6, 6)]], "edge": [[(4, 1), (6, 1), (6, 2), (4, 2)]], "within": [[(1, 1), (2, 1), (2, 2)]], "around": [[(-9, -9), (9, -9), (9, 9), (-9, 9)]], "cross": [[(-1, 1), (9, 1), (9, 2), (-1, 2)]]}
    got = spark.range(1).select(*[G.intersects_touch(one, edges(c)).alias(n) for n, c in cases.items()]).first().asDict()
    assert got == {n: n != "apart" for n in cases}
    assert spark.range(1).select(G.intersects_touch(edges(SQUARE_WITH_HOLE), edges([[(4.5, 4.5), (5.5, 4.5), (5.5, 5.5)]]))).first()[0] is False


def _sampled(a: np.ndarray, b: np.ndarray, n: int = 400) -> float:
    low, high = np.minimum(a.min(0), b.min(0)), np.maximum(a.max(0), b.max(0))
    xs, ys = np.meshgrid(*[np.linspace(low[k], high[k], n) for k in (0, 1)])

    def holds(p):
        q = np.roll(p, -1, 0)
        signs = [(q[k, 0] - p[k, 0]) * (ys - p[k, 1]) - (q[k, 1] - p[k, 1]) * (xs - p[k, 0]) >= 0 for k in range(len(p))]
        return np.all(signs, 0) | ~np.any(signs, 0)

    return float((holds(a) & holds(b)).mean() * np.prod(high - low))


def test_overlap_areas():
    draw = random.Random(5)
    for _ in range(40):
        a, b = (np.array(box(draw.uniform(0, 4), draw.uniform(0, 4), draw.uniform(1, 8), draw.uniform(1, 3), draw.uniform(0, 180))).reshape(4, 2) for _ in range(2))
        if draw.random() < 0.5:
            b = b[::-1]
        assert G.convex_overlap(a[None], b[None])[0] == pytest.approx(_sampled(a, b), abs=0.15)
    same = np.array(box(25496000, 6673000, 16, 2.5, 33)).reshape(1, 4, 2)
    assert G.convex_overlap(same, same)[0] == pytest.approx(40, rel=1e-6)
    beside = np.array([[[0, 0], [2, 0], [2, 2], [0, 2]], [[2, 0], [4, 0], [4, 2], [2, 2]], [[1, 0], [3, 0], [3, 2], [1, 2]]], float)
    assert G.convex_overlap(beside[:1], beside[1:2])[0] == 0 and G.convex_overlap(beside[:1], beside[2:])[0] == pytest.approx(2)


ANCHORS = [(24.9384, 60.1699, 25496580.4, 6673003.6), (25.1960, 60.2090, 25510867.7, 6677374.5)]


def test_projection(spark):
    frame = spark.createDataFrame([(lon, lat) for lon, lat, _, _ in ANCHORS], "lon double, lat double")
    e, n = crs.from_wgs84(F.col("lon"), F.col("lat"), 3879)
    back = crs.to_wgs84(e, n, 3879)
    over = crs.reproject(F.col("lon"), F.col("lat"), 4326, 3067)
    for row, (lon, lat, east, north) in zip(frame.select(e, n, *back, *over).collect(), ANCHORS, strict=True):
        assert row[0] == pytest.approx(east, abs=0.1) and row[1] == pytest.approx(north, abs=0.1)
        assert row[2] == pytest.approx(lon, abs=1e-8) and row[3] == pytest.approx(lat, abs=1e-8)
    assert tuple(frame.select(*over).collect()[1]) == pytest.approx((400020.8, 6676053.5), abs=0.1)
    with pytest.raises(ValueError):
        crs.grid_of(1)


def test_tiles_and_windows(spark):
    assert grid.resolution(16) == 0.125 and grid.tile_span(16) == 32 and grid.matrix_size(3) == 8
    with pytest.raises(ValueError):
        grid.resolution(18)
    area = spark.createDataFrame([(grid.ORIGIN_E + 32.0, grid.ORIGIN_N - 64.0, grid.ORIGIN_E + 64.0, grid.ORIGIN_N - 32.0)], "min_e double, min_n double, max_e double, max_n double")
    assert [(r["tile_col"], r["tile_row"]) for r in grid.tiles(area, 16).collect()] == [(1, 1)]
    wide = spark.createDataFrame([(grid.ORIGIN_E, grid.ORIGIN_N - 300.0, grid.ORIGIN_E + 300.0, grid.ORIGIN_N)], "min_e double, min_n double, max_e double, max_n double")
    xs = sorted({r["x"] for r in grid.windows(wide, 16).collect()})
    assert xs == [0, 784, 2400 - 1024]
    with pytest.raises(ValueError):
        grid.windows(wide, 16, size=100)
