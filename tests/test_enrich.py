"""Enrichment by cell against every pair of a box and an area."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.operators import enrich, spatial
from tests.test_geometry import box

BOXES = "det_id long, cx double, cy double, " + ", ".join(f"{c} double" for c in G.CORNERS)


def boxes_of(spark, rows):
    return spark.createDataFrame([(k, x, y, *box(x, y, length, 2.0, turn)) for k, (x, y, length, turn) in enumerate(rows)], BOXES)


def layer(spark, rows, names):
    """Areas ``(*values, ring)``."""
    made = spark.createDataFrame([(*values, [tuple(map(float, p)) for p in ring]) for *values, ring in rows], f"{names}, ring array<struct<x double, y double>>")
    return spatial.with_polygon(made, G.edges_of(F.col("ring"))).drop("ring")


def angle(x, y, w, h):
    """A concave outline: a rectangle without its upper right quarter."""
    return [(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h), (x, y + h)]


def scene(spark, seed=3):
    draw = random.Random(seed)

    def place():
        return draw.uniform(0, 300), draw.uniform(0, 200)

    boxes = boxes_of(spark, [(*place(), draw.choice([4.0, 9.0, 18.0, 60.0]), draw.uniform(0, 180)) for _ in range(150)])
    streets = layer(spark, [(k, f"s{k}", draw.choice(["Tori", enrich.PARKING_TYPE, None]), angle(*place(), draw.choice([12, 150]), draw.choice([6, 120]))) for k in range(25)], "street_id long, kadun_nimi string, kayttotarkoitus string")
    parking = layer(spark, [(k, angle(*place(), *draw.choice([(3, 2), (40, 40), (90, 70)]))) for k in range(9)], "parking_id long")
    parts = layer(spark, [(k, draw.choice([f"{enrich.BAY_PREFIX} {k}", f"part {k}", None]), f"d{k}", angle(*place(), 160, 100)) for k in range(8)], "part_id long, part_name string, district string")
    return boxes, streets, parking, parts


def by_pairs(boxes, streets, parking, parts):
    """``det_id`` to (district, street, type, context, part) by comparing everything."""
    inside, found = G.inside_strict(F.col("cx"), F.col("cy"), F.col("edges")), {}
    ways = boxes.crossJoin(streets).select("det_id", "street_id", "kadun_nimi", "kayttotarkoitus", inside.alias("i"), G.distance(F.col("cx"), F.col("cy"), F.col("edges")).alias("d")).collect()
    lots = {r[0] for r in boxes.crossJoin(parking).filter(G.intersects_touch(G.edges_of(G.box_ring()), F.col("edges"))).select("det_id").collect()}
    held = boxes.crossJoin(parts).filter(inside).select("det_id", "part_id", "part_name", "district").collect()
    for (k,) in boxes.select("det_id").collect():
        near = min(((r.d, r.street_id, r.kadun_nimi, r.kayttotarkoitus) for r in ways if r.det_id == k and r.d <= enrich.STREET_DISTANCE), key=lambda r: r[:2], default=(None,) * 4)
        on = [r for r in ways if r.det_id == k and r.i]
        own = sorted((r for r in held if r.det_id == k), key=lambda r: r.part_id)
        parked = k in lots or any(r.kayttotarkoitus == enrich.PARKING_TYPE for r in on) or any((r.part_name or "").startswith(enrich.BAY_PREFIX) for r in own)
        found[k] = (own[0].district if own else None, *near[2:], "parking" if parked else "street" if on else "other", own[0].part_name if own else None)
    return found


def test_attributes_of_every_box(spark):
    """Concave outlines, areas over whole cells, small ones, and boxes too long for their cell."""
    boxes, streets, parking, parts = scene(spark)
    want = by_pairs(boxes, streets, parking, parts)
    got = enrich.enrich(boxes, parts, streets, parking, parts).collect()
    assert {r.det_id: (r.district, r.kadun_nimi, r.kayttotarkoitus, r.context, r.street_part) for r in got} == want and len(got) == len(want)
    assert {r[3] for r in want.values()} == {"parking", "street", "other"} and any(r[1] for r in want.values())
    short = enrich.attach_context(boxes, parking, streets, parts).collect()
    assert {r.det_id: (r.context, r.street_part) for r in short} == {k: r[3:] for k, r in want.items()}


def test_work_does_not_grow_with_areas_over_each_other(spark):
    """Of forty streets and forty parking areas over one cell, one of each answers for it; no pairs are made."""
    square = [(-100, -100), (200, -100), (200, 200), (-100, 200)]
    streets = layer(spark, [(k, f"s{k}", "Tori", square) for k in range(40)], "street_id long, kadun_nimi string, kayttotarkoitus string")
    parking = layer(spark, [(k, square) for k in range(40)], "parking_id long")
    parts = layer(spark, [], "part_id long, part_name string, district string")
    areas = spatial.stored(enrich._layered({"street": (streets, ["street_id", "kadun_nimi", "kayttotarkoitus"]), "parking": (parking, []), "part": (parts, ["part_id", "part_name"])}), "layers")
    assert enrich._candidates(areas, 0.0).filter("bx = 0 AND by = 0").count() == 2
    got = enrich.enrich(boxes_of(spark, [(5.0, 5.0, 4.0, 30.0)] * 3), parts, streets, parking, parts).collect()
    assert [(r.kadun_nimi, r.context, r.district) for r in got] == [("s0", "parking", None)] * 3
    short = enrich.attach_context(boxes_of(spark, [(5.0, 5.0, 4.0, 30.0)]), parking.limit(0), streets, parts)
    assert [r.context for r in short.collect()] == ["street"]
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [det_id" not in plan


def test_empty_layers_and_boxes(spark):
    boxes, streets, parking, parts = scene(spark)
    got = enrich.enrich(boxes, parts.limit(0), streets.limit(0), parking.limit(0), parts.limit(0)).collect()
    assert {(r.district, r.kadun_nimi, r.context) for r in got} == {(None, None, "other")} and len(got) == 150
    assert enrich.enrich(boxes.limit(0), parts, streets, parking, parts).count() == 0
