"""Planar geometry as column expressions.

A ring is ``array<struct<x, y>>`` without its closing point; a polygon's edges are
``array<struct<ax, ay, bx, by>>`` over all of its rings, so holes and concave
outlines need no special case. Names say how a boundary counts: ``strict`` leaves
it out, ``touch`` takes it in, ``closed`` is for envelopes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

CORNERS = ("x0", "y0", "x1", "y1", "x2", "y2", "x3", "y3")


def scaled(value: Column, by: int = 1000) -> Column:
    """Nearest whole number of 1/``by``, halves up: comparable across engines."""
    return F.floor(value * by + F.lit(0.5)).cast("long")


def ring(*points: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points])


def box_ring(prefix: str = "") -> Column:
    """The ring of a detection's corner columns."""
    c = [F.col(prefix + n) for n in CORNERS]
    return ring(*zip(c[0::2], c[1::2], strict=True))


def edges_of(points: Column) -> Column:
    n = F.size(points)
    return F.transform(points, lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), F.get(points, (i + 1) % n)["x"].alias("bx"), F.get(points, (i + 1) % n)["y"].alias("by")))


def centre(prefix: str = "") -> tuple[Column, Column]:
    """Mean of a detection's four corners."""
    c = [F.col(prefix + n) for n in CORNERS]
    return (c[0] + c[2] + c[4] + c[6]) / 4, (c[1] + c[3] + c[5] + c[7]) / 4


def _sides(prefix: str) -> tuple[Column, Column, Column, Column]:
    x0, y0, x1, y1, x2, y2, _, _ = (F.col(prefix + n) for n in CORNERS)
    return x1 - x0, y1 - y0, x2 - x1, y2 - y1


def length_m(prefix: str = "") -> Column:
    dx, dy, ex, ey = _sides(prefix)
    return F.greatest(F.sqrt(dx * dx + dy * dy), F.sqrt(ex * ex + ey * ey))


def width_m(prefix: str = "") -> Column:
    dx, dy, ex, ey = _sides(prefix)
    return F.least(F.sqrt(dx * dx + dy * dy), F.sqrt(ex * ex + ey * ey))


def heading_deg(prefix: str = "") -> Column:
    """Compass direction of the longer side, 0 to 180; the first side wins a tie."""
    dx, dy, ex, ey = _sides(prefix)
    first = F.sqrt(dx * dx + dy * dy) >= F.sqrt(ex * ex + ey * ey)
    return F.pmod(F.degrees(F.when(first, F.atan2(dx, dy)).otherwise(F.atan2(ex, ey))), F.lit(180.0))


def envelope(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    c = [F.col(prefix + n) for n in CORNERS]
    return F.least(*c[0::2]), F.least(*c[1::2]), F.greatest(*c[0::2]), F.greatest(*c[1::2])


def _even_odd(x: Column, y: Column, edges: Column) -> Column:
    def crosses(e: Column) -> Column:
        return ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])

    return F.size(F.filter(edges, lambda e: F.when(e["ay"] == e["by"], F.lit(False)).otherwise(crosses(e)))) % 2 == 1


def _on_edge(x: Column, y: Column, edges: Column) -> Column:
    def on(e: Column) -> Column:
        straight = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"]) == 0
        return straight & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    return F.exists(edges, on)


def inside_strict(x: Column, y: Column, edges: Column) -> Column:
    return ~_on_edge(x, y, edges) & _even_odd(x, y, edges)


def inside_touch(x: Column, y: Column, edges: Column) -> Column:
    return _on_edge(x, y, edges) | _even_odd(x, y, edges)


def inside_closed(x: Column, y: Column, min_e: Column, min_n: Column, max_e: Column, max_n: Column) -> Column:
    return x.between(min_e, max_e) & y.between(min_n, max_n)


def distance(x: Column, y: Column, edges: Column) -> Column:
    """Distance of a point to a polygon; zero inside and on its boundary."""

    def to_edge(e: Column) -> Column:
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        size = dx * dx + dy * dy
        t = F.when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["ax"]) * dx + (y - e["ay"]) * dy) / size)))
        px, py = x - e["ax"] - t * dx, y - e["ay"] - t * dy
        return F.sqrt(px * px + py * py)

    return F.when(inside_touch(x, y, edges), F.lit(0.0)).otherwise(F.array_min(F.transform(edges, to_edge)))


def _segments_touch(a: Column, b: Column) -> Column:
    def side(px: Column, py: Column, e: Column) -> Column:
        return F.signum((e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"]))

    d1, d2, d3, d4 = side(a["ax"], a["ay"], b), side(a["bx"], a["by"], b), side(b["ax"], b["ay"], a), side(b["bx"], b["by"], a)
    near = (F.greatest(F.least(a["ax"], a["bx"]), F.least(b["ax"], b["bx"])) <= F.least(F.greatest(a["ax"], a["bx"]), F.greatest(b["ax"], b["bx"]))) & (
        F.greatest(F.least(a["ay"], a["by"]), F.least(b["ay"], b["by"])) <= F.least(F.greatest(a["ay"], a["by"]), F.greatest(b["ay"], b["by"]))
    )
    return near & (d1 * d2 <= 0) & (d3 * d4 <= 0)


def intersects_touch(a: Column, b: Column) -> Column:
    """Whether two polygons share a point, given their edges."""
    first_a, first_b = F.get(a, F.lit(0)), F.get(b, F.lit(0))
    crossing = F.exists(a, lambda e: F.exists(b, lambda f: _segments_touch(e, f)))
    return crossing | inside_touch(first_a["ax"], first_a["ay"], b) | inside_touch(first_b["ax"], first_b["ay"], a)


def crosses_line(line: Column, edges: Column) -> Column:
    """Whether a polyline, given as edges, shares a point with a polygon."""
    first = F.get(line, F.lit(0))
    return F.exists(line, lambda e: F.exists(edges, lambda f: _segments_touch(e, f))) | inside_touch(first["ax"], first["ay"], edges)


def envelope_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Area shared by two envelopes (min_e, min_n, max_e, max_n); zero unless both extents are positive."""
    w, h = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def envelope_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    dx = F.greatest(F.lit(0.0), a[0] - b[2], b[0] - a[2])
    dy = F.greatest(F.lit(0.0), a[1] - b[3], b[1] - a[3])
    return F.sqrt(dx * dx + dy * dy)


def _counter_clockwise(p: np.ndarray) -> np.ndarray:
    q = np.roll(p, -1, 1)
    turned = (p[..., 0] * q[..., 1] - p[..., 1] * q[..., 0]).sum(1) < 0
    return np.where(turned[:, None, None], p[:, ::-1], p)


def _inside_part(p: np.ndarray, q: np.ndarray, shared: bool) -> np.ndarray:
    """Shoelace share of the edges of ``p`` that run inside convex ``q``; ``shared`` counts common edges."""
    d, e = np.roll(p, -1, 1) - p, np.roll(q, -1, 1) - q
    low, high = np.zeros(p.shape[:2]), np.ones(p.shape[:2])
    for k in range(q.shape[1]):
        ex, ey = e[:, k, 0][:, None], e[:, k, 1][:, None]
        at = ex * (p[..., 1] - q[:, k, 1][:, None]) - ey * (p[..., 0] - q[:, k, 0][:, None])
        slope = ex * d[..., 1] - ey * d[..., 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = -at / slope
        low = np.where(slope > 0, np.maximum(low, t), low)
        high = np.where(slope < 0, np.minimum(high, t), high)
        along = shared & (ex * d[..., 0] + ey * d[..., 1] > 0)
        high = np.where((slope == 0) & ((at < 0) | ((at == 0) & ~along)), -1.0, high)
    return (np.maximum(0, high - low) * (p[..., 0] * d[..., 1] - p[..., 1] * d[..., 0])).sum(1) / 2


def convex_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Areas of the intersections of convex polygons, arrays (rows, corners, 2): Green's theorem over clipped edges."""
    origin = a[:, :1]
    a, b = _counter_clockwise(a - origin), _counter_clockwise(b - origin)
    return np.maximum(0, _inside_part(a, b, True) + _inside_part(b, a, False))


def _areas(p: np.ndarray) -> np.ndarray:
    p = p - p[:, :1]
    q = np.roll(p, -1, 1)
    return np.abs((p[..., 0] * q[..., 1] - p[..., 1] * q[..., 0]).sum(1)) / 2


@F.arrow_udf(DoubleType())
def _iou(*corners: pa.Array) -> pa.Array:
    flat = np.stack([c.to_numpy(zero_copy_only=False) for c in corners], 1).reshape(-1, 2, 4, 2)
    a, b = flat[:, 0], flat[:, 1]
    shared = convex_overlap(a, b)
    union = _areas(a) + _areas(b) - shared
    return pa.array(np.where(union > 0, shared / np.where(union > 0, union, 1), 0.0))


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes whose corner columns have the prefixes ``a`` and ``b``."""
    return _iou(*[F.col(a + n) for n in CORNERS], *[F.col(b + n) for n in CORNERS])


def all_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)
