"""Suppression, spatial joins, labels, gates, mining and packaging."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.operators import detect, evaluate, labels, manifest, mining, nms, package, spatial
from gridsight.plans.fixtures import Tables
from tests.test_geometry import box, edges

BOXES = "id long, label string, confidence double, " + ", ".join(f"{c} double" for c in G.CORNERS)


def frame(spark, rows):
    return spark.createDataFrame([(k, name, float(c), *b) for k, (name, c, b) in enumerate(rows)], BOXES)


def greedy(rows, threshold=0.4):
    import numpy as np

    kept: list[int] = []
    shape = [np.array(b).reshape(1, 4, 2) for _, _, b in rows]
    for k in sorted(range(len(rows)), key=lambda k: (-rows[k][1], k)):
        def iou(j):
            shared = G.convex_overlap(shape[k], shape[j])[0]
            return shared / (G._areas(shape[k])[0] + G._areas(shape[j])[0] - shared)

        if all(iou(j) <= threshold for j in kept):
            kept.append(k)
    return set(kept)


def test_suppression_pairs(spark):
    rows = [("car", 0.9, box(0, 0, 16, 2.5, 0)), ("car", 0.7, box(0.4, 0, 16, 2.5, 0)), ("car", 0.7, box(0, 17, 16, 2.5, 0)), ("van", 0.9, box(100, 0, 5, 2, 0)), ("car", 0.8, box(100, 0, 5, 2, 0))]
    assert {r["id"] for r in nms.merge(frame(spark, rows)).collect()} == {0, 2, 3}
    assert nms.merge(frame(spark, rows[:1])).count() == 1 and nms.merge(frame(spark, [])).count() == 0


@pytest.mark.parametrize("step", [2.0, 3.0])
def test_suppression_chains(spark, step):
    """Long chains, where a box goes only if the one before it stays."""
    rows = [("car", 0.9 - k * 0.01, box(k * step, 0, 6, 2, 0)) for k in range(25)]
    draw = random.Random(step)
    rows += [("car", draw.choice([0.3, 0.5, 0.7]), box(500 + draw.uniform(0, 20), draw.uniform(0, 6), 6, 2, draw.uniform(0, 30))) for _ in range(40)]
    assert {r["id"] for r in nms.merge(frame(spark, rows)).collect()} == greedy(rows)


def test_suppression_on_the_fixture(spark):
    """Counts known from an independent run."""
    boxes = Tables(spark, "/root/testdata/sf0.001").boxes().withColumnRenamed("det_id", "id")
    pairs = nms.overlaps(boxes)
    assert pairs.count() == 399 and nms.merge(boxes).count() == 789


def test_first_match_and_distance(spark):
    points = spark.createDataFrame([(1, 50.0, 50.0), (2, 0.0, 50.0), (3, 101.5, 50.0), (4, 103.0, 50.0), (5, 95.0, 95.0)], "det_id long, cx double, cy double")
    square = edges([[(0, 0), (100, 0), (100, 100), (0, 100)]])
    shifted = edges([[(90, 90), (200, 90), (200, 200), (90, 200)]])
    one = spark.createDataFrame([(1, "first")], "pos int, name string").withColumn("edges", square)
    two = spark.createDataFrame([(0, "second")], "pos int, name string").withColumn("edges", shifted)
    areas = spatial.with_polygon(one.unionByName(two), F.col("edges"))
    got = {r["det_id"]: r["name"] for r in spatial.attach_area(points, areas, "det_id", "pos", "name", size=30.0).collect()}
    assert got == {1: "first", 2: None, 3: None, 4: None, 5: "second"}
    near = {r["det_id"]: r["name"] for r in spatial.attach_nearest(points, areas, "det_id", "pos", "name", within=2.0, size=30.0).collect()}
    assert near == {1: "first", 2: "first", 3: "first", 4: None, 5: "second"}


def test_label_nulls_have_three_meanings(spark):
    rows = spark.createDataFrame([(1, None, "car"), (2, "candidate", ""), (3, "rejected", "car"), (4, "confirmed", None)], "id long, status string, class string")
    assert tuple(labels.reviewed(rows).first()) == (4, 3)
    assert labels.recount(rows).first().asDict() == {"total": 4, "reviewed": 2, "rejected": 1, "added": 0, "n_truck": 0, "n_bus": 0, "n_van": 0, "n_car": 1}
    assert {(r["kind"], r["name"], r["n"]) for r in labels.summary(rows).collect()} == {("status", "candidate", 2), ("status", "rejected", 1), ("status", "confirmed", 1), ("class", "car", 2)}
    assert [tuple(r) for r in labels.truth_counts(rows).collect()] == [("", 1)]


def test_count_gate(spark):
    rows = spark.createDataFrame([(100, 100), (109, 100), (111, 100), (88, 100), (5, 59)], "found long, truth long")
    assert [r[0] for r in rows.select(evaluate.count_gate(F.col("found"), F.col("truth"))).collect()] == [True, True, False, False, None]


def test_operating_points(spark):
    def pick(points):
        curve = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)], "i int, px double, p double, r double")
        return [r["i"] for r in evaluate.operating_point(curve).collect()]

    assert pick([(0.3, 0.8, 0.95), (0.5, 0.9, 0.92), (0.7, 0.99, 0.5)]) == [1]
    assert pick([(0.3, 0.5, 0.8), (0.5, 0.8, 0.85), (0.7, 0.9, 0.6)]) == [1]
    assert pick([(0.02, 0.9, 0.92)]) == []
    assert pick([(0.5, 0.9, 0.92), (0.6, 0.9, 0.92)]) == [0]


def test_unexplained(spark):
    found = frame(spark, [("car", 0.5, box(0, 0, 10, 3, 0)), ("truck", 0.5, box(100, 0, 10, 3, 0)), ("car", 0.5, box(200, 0, 10, 3, 0))])
    truth = frame(spark, [("van", 1, box(0.5, 0, 10, 3, 0)), ("truck", 1, box(100, 0, 10, 3, 0))]).withColumn("status", F.when(F.col("id") == 0, "confirmed").otherwise("rejected"))
    assert {r["id"] for r in evaluate.unexplained(found, truth).collect()} == {1, 2}
    assert evaluate.unexplained(found, truth.limit(0)).count() == 3


def test_quotas():
    assert list(mining.quotas(12).values()) == [5, 3, 2, 2] and sum(mining.quotas(7).values()) == 7


def test_proposals_keep_their_distance(spark):
    rows = [("near", 1, 0, 3), ("near_dup", 2, 0, 3), ("size", 5, 0, 0), ("dense", 9, 0, 0), ("quiet", 13, 0, 0)]
    cells = spark.createDataFrame([(n, c, r, k) for n, c, r, k in rows], "name string, col long, row long, n_near long")
    n = F.when(F.col("name") == "quiet", 0).otherwise(6).cast("long")
    cells = cells.withColumns({"n": n, "n_size": (F.col("name") == "size").cast("long"), "mean_confidence": F.lit(0.5), "coverage": F.lit(0.4), "e": F.col("col") * 300 + 150.0, "n_": F.col("row") * 300 + 150.0})
    got = [(r["name"], r["stratum"]) for r in mining.proposals(mining.graded(cells), 4).orderBy("pick").collect()]
    assert got == [("near_dup", "near_threshold"), ("size", "size_boundary"), ("dense", "dense"), ("quiet", "quiet")]


def _greedy(rows, count):
    """Proposals by a plain pass over one list of turns."""
    order = sorted(rows, key=lambda r: (r["signal"], r["mean_confidence"], r["name"]), reverse=True)
    taken, total = [], 0
    for name, slots in [*mining.quotas(count).items(), (None, 0)]:
        total += slots
        for r in order:
            free = all((r["e"] - t["e"]) ** 2 + (r["n_"] - t["n_"]) ** 2 >= 600**2 and r["name"] != t["name"] for t in taken)
            if len(taken) < (total if name else count) and name in (None, r["stratum"]) and free:
                taken.append(r)
    return [(k + 1, r["name"], r["stratum"]) for k, r in enumerate(taken)]


def test_proposals_against_a_plain_pass(spark):
    draw = random.Random(8)
    for size, count in ((400, 12), (40, 20), (3, 5)):
        rows = [(f"c{k}", draw.randrange(20), draw.randrange(20), draw.choice([0, 0, 3, 9]), draw.choice([0, 0, 2]), draw.choice([0, 0, 1]), draw.randrange(5) / 5) for k in range(size)]
        cells = spark.createDataFrame(rows, "name string, col long, row long, n long, n_near long, n_size long, mean_confidence double")
        graded = mining.graded(cells.withColumns({"coverage": F.col("mean_confidence"), "e": F.col("col") * 300 + 150.0, "n_": F.col("row") * 300 + 150.0}))
        got = sorted(tuple(r) for r in mining.proposals(graded, count).collect())
        assert got == _greedy(graded.collect(), count)


def test_proposals_of_nothing(spark):
    cells = spark.createDataFrame([], "name string, col long, row long, n long, n_near long, n_size long, mean_confidence double, coverage double, e double, n_ double")
    assert mining.proposals(mining.graded(cells), 4).collect() == []


def test_dispersed_pool(spark):
    cells = spark.createDataFrame([(f"c{c}-{r}", c, r, c * 300.0, r * 300.0, (c + r) / 20) for c in range(10) for r in range(10)], "name string, col long, row long, e double, n_ double, coverage double")
    first = [r["name"] for r in mining.dispersed(cells, 3).orderBy("pick").collect()]
    assert first[:2] == ["c0-0", "c9-9"] and len(set(first)) == 3
    assert mining.dispersed(cells, 2, seed=1).orderBy("pick").first()["name"] == "c0-1"
    assert mining.dispersed(cells.limit(0), 3).count() == 0


def test_undo_runs(spark):
    rows = [(1, 7, 0), (2, 7, 600), (3, 7, 1299), (4, 8, 1400), (5, 7, 1500), (6, 7, 2200)]
    got = labels.coalesced_edits(spark.createDataFrame([(*r, 0) for r in rows], "seq long, box long, at_ms long, session int"))
    assert sorted((r["seq"], r["edits"]) for r in got.collect()) == [(1, 3), (4, 1), (5, 1), (6, 1)]


def test_work_left(spark):
    log = spark.createDataFrame([(1, "a", "running"), (2, "a", "done"), (3, "b", "failed"), (4, "c", "done"), (5, "c", "running")], "seq long, cell string, status string")
    cells = spark.createDataFrame([(x,) for x in "abcd"], "cell string")
    state = manifest.latest(log)
    assert {r["cell"] for r in manifest.to_do(cells, state).collect()} == {"c", "d"}
    assert {r["cell"] for r in manifest.to_do(cells, state, retry_failed=True).collect()} == {"b", "c", "d"}


class Stub:
    """Two overlapping boxes per image, the shorter one more confident."""

    def detect(self, image: bytes):
        return [("car", 0.9, 0, 0, 24, 0, 24, 16, 0, 16), ("van", 0.5, 0, 0, 40, 0, 40, 16, 0, 16), ("truck", 0.4, 200, 0, 260, 0, 260, 20, 200, 20)]


def test_sweep_merges_before_the_length_gate(spark):
    windows = spark.createDataFrame([(1, 0, 0, bytearray(b"x")), (1, 1000, 0, None)], "area long, x long, y long, image binary")
    got = detect.sweep(windows, Stub, 16).collect()
    assert [r["label"] for r in got] == ["truck"]
    assert detect.sweep(windows, Stub, 16, keep=["van"]).count() == 1


def test_packaging(spark, tmp_path):
    good = spark.range(3).select("id", *[F.lit("x").alias(c) for c in package.ENRICHED])
    assert package.pack({2021: good, 2023: good.limit(1)}, str(tmp_path / "p")) == {2021: 3, 2023: 1}
    with pytest.raises(Exception, match="exists"):
        package.pack({2021: good}, str(tmp_path / "p"))
    with pytest.raises(ValueError, match="district"):
        package.check(good.drop("district"), "x")
    with pytest.raises(ValueError, match="no rows"):
        package.check(good.limit(0), "x")
