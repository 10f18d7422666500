"""Attributes of detections from area layers, told cell by cell.

Every layer's areas carry their kind, lie in one table and are dealt to small square
cells. An area that holds a whole cell answers for every centre in it, so only the
first of these by position stays, with the areas that could still come before it;
where a cell is parking throughout, no parking area is left to compare. What stays is
one row a cell, with outlines cut to the edges that matter there. A box meets the row
of its centre's cell and is told all of its attributes at once: nothing is written or
exchanged by pair of a box and an area, however many areas lie over each other. Boxes
that reach farther than ``REACH_M`` from their centres meet parking areas by bucket.

Defined results: a box without any area has null attributes and context ``other``;
null types and names are of no parking and no bay; of several areas the first
position wins, of equally near streets too; repeated rows are told alike; empty
layers and an empty table of boxes are no special case; other columns are kept. Boxes
are convex, as detections are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.operators import spatial

#: Farthest a street may be from a detection's centre, in metres.
STREET_DISTANCE = 2.0
#: The street type of whole parking areas, and what bays' part names begin with.
PARKING_TYPE, BAY_PREFIX = "Pysäköintialue", "Pysäköintialue"
#: Side of a cell; how far boxes may reach from their centres to be told by cell alone; room for rounding. All in metres.
CELL_M, REACH_M, ROOM_M = 25.0, 10.0, 0.001
#: Kinds of which the first counts, with the column that orders them.
POSITIONS = {"street": "street_street_id", "part": "part_part_id", "district": "district_part_id"}


def _layered(layers: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Layers in one table: ``kind``, a running ``area`` id, the named columns with the kind before them, outline and envelope."""
    rows = [frame.select(F.lit(kind).alias("kind"), *[F.col(c).alias(f"{kind}_{c}") for c in columns], "edges", *spatial.ENVELOPE) for kind, (frame, columns) in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).withColumn("area", F.monotonically_increasing_id())


def _holds(edges: Column, low_x: Column, low_y: Column, side: float) -> Column:
    """Whether a polygon holds a square and keeps its boundary away from it."""
    high_x, high_y = low_x + side, low_y + side

    def meets(e: Column) -> Column:
        near = (F.least(e["ax"], e["bx"]) <= high_x) & (F.greatest(e["ax"], e["bx"]) >= low_x) & (F.least(e["ay"], e["by"]) <= high_y) & (F.greatest(e["ay"], e["by"]) >= low_y)
        sides = [(e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"]) for x in (low_x, high_x) for y in (low_y, high_y)]
        return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return ~F.exists(edges, meets) & G.inside_strict(low_x + side / 2, low_y + side / 2, edges)


def _candidates(areas: DataFrame, within: float) -> DataFrame:
    """``bx, by, area, whole, parks, parked``: areas by cell that may decide something for a centre there."""
    low_e, low_n, high_e, high_n = spatial.area_envelope()
    kind = F.col("kind")
    lot = (kind == "street") & (F.col("street_kayttotarkoitus") == PARKING_TYPE)
    bay = (kind == "part") & F.col("part_part_name").startswith(BAY_PREFIX)
    parks = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in (kind == "parking", lot, bay)])
    reach = F.when(kind == "parking", F.lit(REACH_M)).otherwise(F.lit(within)) + ROOM_M
    x, y = F.col("bx") * CELL_M - ROOM_M, F.col("by") * CELL_M - ROOM_M
    side = CELL_M + 2 * ROOM_M
    spans = (low_e < x) & (low_n < y) & (high_e > x + side) & (high_n > y + side)
    dealt = spatial.by_bucket(areas.withColumn("parks", parks), spatial.area_envelope(), CELL_M, reach=reach)
    positions = {k: c for k, c in POSITIONS.items() if c in areas.columns}
    rows = dealt.select("bx", "by", "area", "kind", "parks", *positions.values(), F.when(spans, _holds(F.col("edges"), x, y, side)).otherwise(F.lit(False)).alias("whole"))
    cell = Window.partitionBy("bx", "by")

    def first_whole(of: Column, value: str) -> Column:
        return F.min(F.when(of & F.col("whole"), F.col(value))).over(cell)

    told = rows.withColumns({f"_{k}": first_whole(kind == k, c) for k, c in positions.items()} | {"_parking": first_whole(F.col("parks"), "area")})
    parked = F.col("_parking").isNotNull()

    def may_be_first(of: str, value: str) -> Column:
        position, first = F.col(value), F.col(f"_{of}")
        return (kind == of) & F.coalesce((position < first) | (F.col("whole") & (position == first)), F.lit(True))

    of_use = [may_be_first(k, c) for k, c in positions.items()] + [F.col("parks") & ~parked, F.coalesce(F.col("area") == F.col("_parking"), F.lit(False))]
    return told.filter(reduce(lambda a, b: a | b, of_use)).select("bx", "by", "area", "whole", "parks", parked.alias("parked"))


def _cells(areas: DataFrame, within: float) -> DataFrame:
    """One row ``_bx, _by, _cell`` for every cell with candidates: whether it is parking throughout, and a list by kind; a whole area has no outline."""
    reach = max(REACH_M, within) + ROOM_M
    x, y = F.col("bx") * CELL_M, F.col("by") * CELL_M
    # A ray to the east from a point near the cell, and what is near it, meets no other edges.
    near = F.filter("edges", lambda e: (F.greatest(e["ay"], e["by"]) >= y - reach) & (F.least(e["ay"], e["by"]) <= y + CELL_M + reach) & (F.greatest(e["ax"], e["bx"]) >= x - reach))
    held = _candidates(areas, within).join(areas, "area").withColumn("cut", F.when(~F.col("whole"), near))
    common = [F.col("cut").alias("edges"), *spatial.ENVELOPE, "whole", "parks"]

    def listed(kind: str, *columns: Column) -> Column:
        return F.collect_list(F.when(F.col("kind") == kind, F.struct(*common, *columns)))

    def named(kind: str) -> list[Column]:
        return [F.col(c).alias(c.removeprefix(f"{kind}_")) for c in areas.columns if c.startswith(f"{kind}_")]

    lists = [listed(k, *named(k)).alias(k) for k in ("parking", *POSITIONS)]
    return held.groupBy(F.col("bx").alias("_bx"), F.col("by").alias("_by")).agg(F.struct(F.bool_or("parked").alias("parked"), *lists).alias("_cell"))


def _attributes(boxes: DataFrame, key: str, streets: DataFrame, parking: DataFrame, parts: DataFrame, districts: DataFrame | None, within: float) -> DataFrame:
    """``boxes`` with ``_street``, ``_parked``, ``_road``, ``street_part`` and, given districts, ``district``."""
    layers = {"street": (streets, ["street_id", "kadun_nimi", "kayttotarkoitus"]), "parking": (parking, []), "part": (parts, ["part_id", "part_name"])}
    if districts is not None:
        layers["district"] = (districts, ["part_id", "district"])
    cx, cy = F.col("cx"), F.col("cy")
    b0, b1, b2, b3 = G.envelope()
    far = F.greatest(cx - b0, b2 - cx, cy - b1, b3 - cy)
    cells = _cells(spatial.stored(_layered(layers), "layers"), within)
    dealt = boxes.withColumns({"_bx": F.floor(cx / CELL_M).cast("long"), "_by": F.floor(cy / CELL_M).cast("long")}).join(cells, ["_bx", "_by"], "left")
    of = {k: F.col(f"_cell.{k}") for k in ("parked", "parking", *POSITIONS)}

    def close(a: Column, reach: float) -> Column:
        return cx.between(a["a_min_e"] - reach, a["a_max_e"] + reach) & cy.between(a["a_min_n"] - reach, a["a_max_n"] + reach)

    def inside(a: Column) -> Column:
        return a["whole"] | (close(a, 0.0) & G.inside_strict(cx, cy, a["edges"]))

    def away(s: Column) -> Column:
        return F.when(s["whole"], F.lit(0.0)).when(close(s, within), G.distance(cx, cy, s["edges"]))

    def touches(a: Column) -> Column:
        meets = (b0 <= a["a_max_e"]) & (a["a_min_e"] <= b2) & (b1 <= a["a_max_n"]) & (a["a_min_n"] <= b3)
        return F.coalesce(meets & G.intersects_touch(G.edges_of(G.box_ring()), a["edges"]), F.lit(False))

    def any_of(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    def first_inside(kind: str, value: str) -> Column:
        held = F.filter(of[kind], lambda p: p["part_id"].isNotNull() & inside(p))
        return F.array_min(F.transform(held, lambda p: F.struct(p["part_id"].alias("part_id"), p[value].alias(value))))[value]

    names = {c: f"street_{c}" for c in ("kadun_nimi", "kayttotarkoitus")}
    ways = F.transform(of["street"], lambda s: F.struct(away(s).alias("away"), s["street_id"].alias("street_id"), *[s[c].alias(n) for c, n in names.items()]))
    parks = any_of(F.exists(of["street"], lambda a: a["parks"] & inside(a))) | any_of(F.exists(of["part"], lambda a: a["parks"] & inside(a)))
    touched = F.when(far <= REACH_M, any_of(F.exists(of["parking"], touches))).otherwise(F.lit(False))
    told = {"_street": F.array_min(F.filter(ways, lambda s: s["away"] <= within)), "_parked": any_of(of["parked"]) | touched | parks, "_road": any_of(F.exists(of["street"], inside)), "street_part": first_inside("part", "part_name")}
    if districts is not None:
        told["district"] = first_inside("district", "district")
    told = dealt.select(*boxes.columns, *[c.alias(n) for n, c in told.items()])
    most = boxes.agg(F.max(far)).first()[0]
    if most is None or most <= REACH_M:
        return told
    met = spatial.touched_by_any(boxes.filter(far > REACH_M), parking, key).withColumn("_met", F.lit(True))
    return told.join(met, key, "left").withColumn("_parked", F.col("_parked") | F.col("_met").isNotNull()).select(*told.columns)


def _context() -> Column:
    return F.when(F.col("_parked"), "parking").when(F.col("_road"), "street").otherwise("other")


def attach_context(boxes: DataFrame, parking: DataFrame, streets: DataFrame, parts: DataFrame, *, key: str = "det_id") -> DataFrame:
    """Adds ``context`` (parking, street or other) and ``street_part``.

    Parking: the box touches a regulated parking area, or its centre lies in a bay or in a
    street of the parking type. Parts have ``part_id`` and ``part_name``; the part is told whatever the context.
    """
    return _attributes(boxes, key, streets, parking, parts, None, 0.0).withColumn("context", _context()).drop("_street", "_parked", "_road")


def enrich(boxes: DataFrame, districts: DataFrame, streets: DataFrame, parking: DataFrame, parts: DataFrame, *, key: str = "det_id") -> DataFrame:
    """Detections with district, nearest street within two metres (``kadun_nimi``, ``kayttotarkoitus``), context and street part."""
    found = _attributes(boxes, key, streets, parking, parts, districts, STREET_DISTANCE)
    street = {c: F.col(f"_street.street_{c}") for c in ("kadun_nimi", "kayttotarkoitus")}
    return found.withColumns(street | {"context": _context()}).drop("_street", "_parked", "_road")
