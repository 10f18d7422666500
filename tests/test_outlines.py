"""Outlines traced from masks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import outlines
from tests.test_geometry import box


def _area(ring):
    after = np.roll(ring, -1, 0)
    return (ring[:, 0] * after[:, 1] - after[:, 0] * ring[:, 1]).sum() / 2


def test_borders_hold_their_patch():
    draw = np.random.default_rng(2)
    for _ in range(40):
        mask = draw.random((12, 15)) < 0.55
        ring = outlines.traced(mask)
        if ring is None:
            assert not mask.any()
            continue
        filled = outlines.ring_mask(ring, mask.shape)
        assert filled.sum() == _area(ring), "area of the border"
        assert np.abs(np.diff(np.concatenate([ring, ring[:1]]), axis=0)).sum(1).max() == 1
        rim = np.zeros_like(mask)
        rim[1:], rim[:-1] = rim[1:] | ~filled[:-1], rim[:-1] | ~filled[1:]
        rim[:, 1:], rim[:, :-1] = rim[:, 1:] | ~filled[:, :-1], rim[:, :-1] | ~filled[:, 1:]
        rim[[0, -1]] = rim[:, [0, -1]] = True
        assert mask[filled & rim].all(), "pixels along the border are the mask's"
    assert outlines.traced(np.zeros((3, 3), bool)) is None


def test_simplified_rings_stay_near():
    turns = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    ring = np.stack([50 + 40 * np.cos(turns), 50 + 20 * np.sin(turns)], 1)
    few = outlines.simplified(ring, 0.5)
    assert 4 <= len(few) < 60 and abs(_area(few) / _area(ring) - 1) < 0.05
    assert len(outlines.simplified(np.array([[0, 0], [5, 0], [10, 0], [10, 10], [5, 10.0], [0, 10]]), 0.1)) == 4


class Disc:
    def segment(self, image, rings):
        y, x = np.mgrid[0:1024, 0:1024] + 0.5
        return [np.hypot(x - r[:, 0].mean(), y - r[:, 1].mean()) < float(image) for r in rings]


def test_outlines_of_boxes(spark):
    x, y = 1024 * 1020, 1024 * 1670
    e, n = grid.ORIGIN_E + (x + 500) * 0.125, grid.ORIGIN_N - (y + 400) * 0.125
    boxes = spark.createDataFrame([(k, *box(e + 20 * k, n, 8, 4, 0)) for k in range(2)], "id long, " + ", ".join(f"{c} double" for c in G.CORNERS))
    windows = spark.createDataFrame([(x, y, bytearray(b"12"))], "x long, y long, image binary")
    got = {r["id"]: r["ring"] for r in outlines.outlines(windows, boxes, Disc, 16).collect()}
    for k, ring in got.items():
        points = np.array([(p["x"], p["y"]) for p in ring])
        assert np.hypot(points[:, 0] - e - 20 * k, points[:, 1] - n).max() < 1.7 and abs(abs(_area(points - points[0])) - np.pi * 1.5**2) < 0.5
    none = outlines.outlines(windows.withColumn("image", F.lit(b"1")), boxes, Disc, 16).collect()
    assert len(none) == 2 and all(r["ring"] is None for r in none)
    assert outlines.outlines(windows.withColumn("image", F.lit(None).cast("binary")), boxes, Disc, 16).count() == 0
