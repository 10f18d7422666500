"""Polygons of any shape against sampling and clipping in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsight.operators import polygons, spatial

SCHEMA = f"id long, edges string, shape {polygons.MULTIPOLYGON}"


def star(draw, x, y, radius, corners=9):
    turns = sorted(draw.random() * 2 * math.pi for _ in range(corners))
    return [(x + radius * draw.uniform(0.3, 1) * math.cos(a), y + radius * draw.uniform(0.3, 1) * math.sin(a)) for a in turns]


def inside(p, ring):
    x, y = p
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1


def clip(ring, box):
    """Area of a ring within a box, by cutting at one side after another."""
    for axis, bound, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        out = []
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            da, db = sign * (a[axis] - bound), sign * (b[axis] - bound)
            if da >= 0:
                out.append(a)
            if da * db < 0:
                out.append(tuple(a[k] + (b[k] - a[k]) * da / (da - db) for k in (0, 1)))
        ring = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2 if ring else 0.0


@pytest.fixture(scope="module")
def shapes():
    draw = random.Random(3)
    rows = []
    for k in range(12):
        outer = star(draw, draw.uniform(0, 500), draw.uniform(0, 500), 200)
        middle = (sum(p[0] for p in outer) / len(outer), sum(p[1] for p in outer) / len(outer))
        hole = [(middle[0] + 5 * math.cos(a), middle[1] + 5 * math.sin(a)) for a in (0, 2, 4)]
        hole = hole if all(inside(p, outer) for p in hole) else []
        rows.append((k, [[r for r in (outer[:: 1 if k % 2 else -1], hole) if r], [star(draw, draw.uniform(0, 500), draw.uniform(0, 500), 50)]]))
    return rows


def test_areas_in_cells(spark, shapes):
    frame = spark.createDataFrame([(k, "clash", s) for k, s in shapes] + [(98, None, None), (99, None, []), (100, None, [[[(0.0, 0.0), (1.0, 1.0)]]])], SCHEMA).drop("edges")
    parts = polygons.explode_parts(frame)
    got = {(r["id"], r["part"], r["cell_col"], r["cell_row"]): r["shared_m2"] for r in polygons.by_cell(parts, 100.0).collect()}
    want = {}
    for k, shape in shapes:
        for j, (outer, *holes) in enumerate(shape):
            for c in range(-4, 9):
                for r in range(-4, 9):
                    box = (c * 100, r * 100, c * 100 + 100, r * 100 + 100)
                    area = clip(outer, box) - sum(clip(h, box) for h in holes)
                    if area > 1e-6:
                        want[(k, j, c, r)] = area
    assert {k for k, v in got.items() if v > 1e-6} == set(want)
    assert all(abs(got[k] - v) < 1e-6 * max(1, v) for k, v in want.items())
    areas = {(r["id"], r["part"]): r["area_m2"] for r in parts.collect()}
    for key, area in areas.items():
        assert abs(area - sum(v for k, v in want.items() if k[:2] == key)) < 1e-6 * area


def test_unions_by_sampling(spark, shapes):
    parts = polygons.explode_parts(spark.createDataFrame([(k, "x", s) for k, s in shapes], SCHEMA).drop("edges"))
    got = {(r["cell_col"], r["cell_row"]): r["coverage"] for r in polygons.coverage(parts, 200.0).collect()}
    steps = (np.arange(60) + 0.5) / 60
    for (c, r), share in got.items():
        hits = sum(any(inside(p, o) and not any(inside(p, h) for h in hs) for _, s in shapes for o, *hs in s) for u in steps for v in steps for p in [((c + u) * 200, (r + v) * 200)])
        assert abs(hits / 3600 - share) < 0.02, (c, r)
    total = polygons.union_area(parts, size=200.0).first()["area_m2"]
    assert abs(total - sum(got.values()) * 40_000) < 1e-3
    assert polygons.union_area(parts.limit(0)).first()["area_m2"] == 0


def test_overlaps_are_largest_first(spark):
    rows = [(1, 0.0, 0.0, 10.0, 10.0), (2, 5.0, 5.0, 2500.0, 8.0), (3, 9.0, 9.0, 20.0, 20.0), (4, 10.0, 0.0, 20.0, 9.0), (5, None, 0.0, 1.0, 1.0)]
    got = polygons.overlaps(spark.createDataFrame(rows, "id long, min_e double, min_n double, max_e double, max_n double"), "id").collect()
    assert [tuple(r) for r in got] == [(2, 4, 30.0), (1, 2, 15.0), (1, 3, 1.0)]


def test_edges_of_a_part_hold_its_points(spark, shapes):
    from gridsight.functions import geometry as G

    parts = polygons.explode_parts(spark.createDataFrame([(k, "x", s) for k, s in shapes], SCHEMA).drop("edges"))
    draw = random.Random(1)
    points = [(draw.uniform(0, 500), draw.uniform(0, 500)) for _ in range(100)]
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], "p long, cx double, cy double")
    got = {(r["p"], r["id"], r["part"]) for r in spatial.point_candidates(frame, parts, size=100.0).filter(G.inside_strict(F.col("cx"), F.col("cy"), F.col("edges"))).collect()}
    want = {(n, k, j) for n, p in enumerate(points) for k, s in shapes for j, (o, *hs) in enumerate(s) if inside(p, o) and not any(inside(p, h) for h in hs)}
    assert got == want
