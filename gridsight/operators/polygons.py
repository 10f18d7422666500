"""Polygons of any shape: parts of multipolygons, areas within cells, unions and overlaps.

A multipolygon is ``array<polygon>``, a polygon ``array<ring>`` with its outline
first and holes after it, a ring ``array<struct<x, y>>`` without its closing point.
``edges`` of a part run along its outline to the left of the inside and along holes
to the right, so that sums over edges are exact areas with holes taken off.

Defined results: null and empty multipolygons have no parts; rings of under three
points are no outline; a part that only touches a cell shares no area with it;
repeated parts count each, except in a union; empty tables give empty results; other
columns are kept where rows are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import spatial

RINGS = "array<array<struct<x: double, y: double>>>"
MULTIPOLYGON = f"array<{RINGS}>"
EDGE = "struct<ax: double, ay: double, bx: double, by: double>"


def signed_area(ring: Column) -> Column:
    """Area of a ring, negative if it runs clockwise; taken about its first point, so that large coordinates cost no digits."""
    x0, y0, n = F.get(ring, F.lit(0))["x"], F.get(ring, F.lit(0))["y"], F.size(ring)

    def cross(p: Column, i: Column) -> Column:
        q = F.get(ring, (i + 1) % n)
        return (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0)

    return F.aggregate(F.transform(ring, cross), F.lit(0.0), lambda a, c: a + c) / 2


def _turned(ring: Column, left: Column) -> Column:
    """A ring that runs counter-clockwise (``left``) or clockwise."""
    return F.when((signed_area(ring) > 0) == left, ring).otherwise(F.reverse(ring))


def oriented_edges(rings: Column) -> Column:
    """Edges of a polygon's rings, outline and holes in opposite directions."""
    solid = F.filter(rings, lambda r: F.size(r) >= 3)
    return F.flatten(F.transform(solid, lambda r, i: G.edges_of(_turned(r, i == 0))))


def area(edges: Column) -> Column:
    """Area of a part by its ``oriented_edges``."""
    x0, y0 = F.get(edges, F.lit(0))["ax"], F.get(edges, F.lit(0))["ay"]
    crosses = F.transform(edges, lambda e: (e["ax"] - x0) * (e["by"] - y0) - (e["bx"] - x0) * (e["ay"] - y0))
    return F.coalesce(F.aggregate(crosses, F.lit(0.0), lambda a, c: a + c) / 2, F.lit(0.0))


def area_within(edges: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Area that a part shares with a box, whatever the part's shape.

    Every edge adds the area between it and the box's lower side, over the columns and
    up to the rows of the box, with the sign of its direction.
    """
    x0, y0, x1, y1 = box

    def below(y: Column) -> Column:
        """Integral of the height above ``y0``, cut at ``y1``, up to a height."""
        h, top = F.greatest(y - y0, F.lit(0.0)), y1 - y0
        return F.when(h <= top, h * h / 2).otherwise(top * top / 2 + top * (h - top))

    def part(e: Column) -> Column:
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        left, right = F.greatest(F.least(e["ax"], e["bx"]), x0), F.least(F.greatest(e["ax"], e["bx"]), x1)
        run = F.nullif(dx, F.lit(0.0))
        ya, yb = e["ay"] + dy * (left - e["ax"]) / run, e["ay"] + dy * (right - e["ax"]) / run
        height = F.when(ya == yb, F.least(F.greatest(ya - y0, F.lit(0.0)), y1 - y0)).otherwise((below(yb) - below(ya)) / (yb - ya))
        return F.when((dx == 0) | (left >= right), F.lit(0.0)).otherwise(F.signum(-dx) * (right - left) * height)

    return F.greatest(F.aggregate(F.transform(edges, part), F.lit(0.0), lambda a, p: a + p), F.lit(0.0))


def explode_parts(regions: DataFrame, *, shape: str = "shape") -> DataFrame:
    """One row per polygon of the multipolygons in ``shape``: ``part`` numbers them, with ``edges``, envelope and ``area_m2``."""
    parts = regions.select(*[c for c in regions.columns if c != shape], F.posexplode(shape).alias("part", "_rings")).filter(F.size(F.get(F.col("_rings"), F.lit(0))) >= 3)
    return spatial.with_polygon(parts, oriented_edges(F.col("_rings"))).withColumn("area_m2", area(F.col("edges"))).drop("_rings")


def _cell_box(size: float) -> tuple[Column, Column, Column, Column]:
    return grid.cell_bounds(F.col("cell_col"), F.col("cell_row"), size)


def by_cell(parts: DataFrame, size: float) -> DataFrame:
    """Parts by the cells they share positive area with: adds ``cell_col``, ``cell_row`` and ``shared_m2``."""
    if size <= 0:
        raise ValueError(f"cells of {size} m")
    named = parts.withColumns(dict(zip(("min_e", "min_n", "max_e", "max_n"), spatial.area_envelope(), strict=True)))
    return grid.cells(named, size).drop("min_e", "min_n", "max_e", "max_n").withColumn("shared_m2", area_within(F.col("edges"), _cell_box(size))).filter(F.col("shared_m2") > 0)


def cells_over(parts: DataFrame, size: float) -> DataFrame:
    """Cells of which some part holds positive area: ``cell_col, cell_row, name``; order by the first two for a map's order."""
    return by_cell(parts, size).select("cell_col", "cell_row").distinct().withColumn("name", grid.cell_name(F.col("cell_col"), F.col("cell_row")))


def _union_area(owners: np.ndarray, e: np.ndarray, box: tuple[float, float, float, float]) -> float:
    """Area of the union of polygons within a box; ``e`` has their edges (ax, ay, bx, by), ``owners`` whose they are.

    Between neighbouring corners and crossings no two edges change places, so a slab there
    is a row of trapezoids, told apart on its middle line.
    """
    x0, y0, x1, y1 = box
    e = e - np.array([x0, y0, x0, y0])
    width, height = x1 - x0, y1 - y0
    live = e[:, 0] != e[:, 2]
    e, owners = e[live], owners[live]
    if not len(e):
        return 0.0
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    shift = e[:, 1] - slope * e[:, 0]
    low, high = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    with np.errstate(divide="ignore", invalid="ignore"):
        meet = (shift[None, :] - shift[:, None]) / (slope[:, None] - slope[None, :])
        edge = np.concatenate([-shift / slope, (height - shift) / slope])
    cuts = np.concatenate([low, high, meet[np.isfinite(meet)], edge[np.isfinite(edge)], [0.0, width]])
    cuts = np.unique(cuts[(cuts >= 0) & (cuts <= width)])
    total = 0.0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        middle = (a + b) / 2
        on = np.flatnonzero((low < middle) & (high > middle))
        y = slope[on] * middle + shift[on]
        order = np.argsort(y, kind="stable")
        inside: set[int] = set()
        since = 0.0
        for k in order:
            before = bool(inside)
            inside ^= {int(owners[on[k]])}
            if inside and not before:
                since = y[k]
            elif before and not inside:
                total += (b - a) * (min(max(y[k], 0.0), height) - min(max(since, 0.0), height))
    return float(total)


@F.arrow_udf(DoubleType())
def _union(edges: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    found = []
    for parts, *box in zip(edges.to_pylist(), *(c.to_pylist() for c in (x0, y0, x1, y1)), strict=True):
        rows = [(k, e["ax"], e["ay"], e["bx"], e["by"]) for k, part in enumerate(parts) for e in part]
        flat = np.array(rows, float).reshape(-1, 5)
        found.append(_union_area(flat[:, 0].astype(int), flat[:, 1:], tuple(box)))
    return pa.array(found, pa.float64())


def coverage(parts: DataFrame, size: float) -> DataFrame:
    """``cell_col, cell_row, coverage``: the share of each cell that the union of parts covers, overlaps counted once.

    Where one part alone lies in a cell its area is enough; only cells that several share are
    dissolved, each from the parts that meet it.
    """
    dealt = by_cell(parts, size).groupBy("cell_col", "cell_row").agg(F.collect_list("edges").alias("held"), F.sum("shared_m2").alias("shared"))
    whole = F.lit(size * size)
    several = F.when(F.size("held") > 1, F.col("held")).otherwise(F.array().cast(f"array<array<{EDGE}>>"))  # nothing to send to Python
    joint = _union(several, *[c.cast("double") for c in _cell_box(size)])
    return dealt.select("cell_col", "cell_row", (F.when(F.size("held") > 1, joint).otherwise(F.col("shared")) / whole).alias("coverage"))


def union_area(parts: DataFrame, *, size: float = 1000.0) -> DataFrame:
    """One row ``area_m2``: the area of the union of all parts, summed over the cells it is dissolved in; zero for none."""
    return coverage(parts, size).agg(F.coalesce(F.sum("coverage") * (size * size), F.lit(0.0)).alias("area_m2"))


def overlaps(areas: DataFrame, key: str, *, margin: float = 0.0, size: float = 1000.0) -> DataFrame:
    """``a_id, b_id, area_m2`` of areas (``min_e`` ... ``max_n``) whose envelopes, the later one widened by ``margin``, share area; largest first.

    Rows with a null bound overlap nothing.
    """
    names = ("min_e", "min_n", "max_e", "max_n")
    own, wide = tuple(F.col(f"p_{c}") for c in names), tuple(F.col(f"q_{c}") for c in names)
    a = spatial.by_bucket(areas.select(F.col(key).alias("a_id"), *[F.col(c).alias(f"p_{c}") for c in names]).dropna(), own, size)
    b = spatial.by_bucket(areas.select(F.col(key).alias("b_id"), *[(F.col(c) + (margin if c.startswith("max") else -margin)).alias(f"q_{c}") for c in names]).dropna(), wide, size)
    west, south = F.greatest(own[0], wide[0]), F.greatest(own[1], wide[1])
    home = (F.floor(west / size).cast("long") == F.col("bx")) & (F.floor(south / size).cast("long") == F.col("by"))
    met = a.join(b, ["bx", "by"]).filter((F.col("a_id") < F.col("b_id")) & home)
    return met.select("a_id", "b_id", G.envelope_overlap(own, wide).alias("area_m2")).filter("area_m2 > 0").orderBy(F.desc("area_m2"), "a_id", "b_id")


def with_roads(parts: DataFrame, roads: DataFrame, key: str, *, min_roads: int = 1, min_area_m2: float = 0.0, size: float = 500.0) -> DataFrame:
    """Parts (``explode_parts``) large enough that ``min_roads`` of ``roads (road_id, line)`` meet, with ``roads``; ``line`` is edges.

    With ``min_roads`` 0 parts without any road stay, too.
    """
    large = parts.filter(F.col("area_m2") >= min_area_m2)
    ends = [F.array_min(F.transform("line", lambda e: F.least(e[f"a{c}"], e[f"b{c}"]))) for c in "xy"] + [F.array_max(F.transform("line", lambda e: F.greatest(e[f"a{c}"], e[f"b{c}"]))) for c in "xy"]
    dealt = spatial.by_bucket(roads.select("road_id", "line"), tuple(ends), size)
    near = dealt.join(spatial.by_bucket(large.select(key, "edges", *spatial.ENVELOPE), spatial.area_envelope(), size), ["bx", "by"])
    counts = near.filter(G.crosses_line(F.col("line"), F.col("edges"))).groupBy(key).agg(F.count_distinct("road_id").alias("roads"))
    return large.join(counts, key, "left").fillna(0, ["roads"]).filter(F.col("roads") >= min_roads)


def kept_share(kept: DataFrame, whole: DataFrame) -> DataFrame:
    """One row ``kept, dropped, kept_m2, whole_m2, permille`` of parts that stay; no area at all is 0 of a thousand."""
    both = whole.select("area_m2", F.lit(0).alias("_k")).unionByName(kept.select("area_m2", F.lit(1).alias("_k")))
    n, m2 = {k: F.count_if(F.col("_k") == k) for k in (0, 1)}, {k: F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("area_m2"))), F.lit(0.0)) for k in (0, 1)}
    share = F.when(m2[0] > 0, F.floor(m2[1] * 1000 / m2[0])).otherwise(0).cast("long")
    return both.agg(n[1].alias("kept"), (n[0] - n[1]).alias("dropped"), m2[1].alias("kept_m2"), m2[0].alias("whole_m2"), share.alias("permille"))
