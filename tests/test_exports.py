"""Editing, land use and the files for people and trainers."""

from __future__ import annotations

import json

import pytest
import yaml
from pyspark.sql import functions as F

from gridsight.functions import editing
from gridsight.operators import labels
from gridsight.sources import exports, landuse
from tests.test_geometry import box
from tests.test_operators import frame


def test_box_and_centreline(spark):
    nose, tail = editing.point(F.lit(10.0), F.lit(0.0)), editing.point(F.lit(0.0), F.lit(0.0))
    ring = editing.box_of(nose, tail, F.lit(2.0))
    row = spark.range(1).select(editing.centreline_of(ring).alias("c"), editing.turned(nose, tail, F.lit(90.0)).alias("t"), editing.lengthened(nose, tail, F.lit(100.0), F.lit(3.0)).alias("l"), editing.box_of(tail, tail, F.lit(2.0)).alias("p"), editing.lengthened(tail, tail, F.lit(1.0), F.lit(3.0)).alias("s")).first()
    assert (row["c"]["nose"]["x"], row["c"]["tail"]["x"]) == (10, 0)
    assert (round(row["t"]["nose"]["x"], 9), round(row["t"]["nose"]["y"], 9)) == (5, -5)
    assert abs(row["l"]["nose"]["x"] - row["l"]["tail"]["x"]) == 30
    assert row["p"][0]["x"] == -1 and row["s"]["nose"]["x"] == 0
    assert tuple(spark.range(1).select(editing.clamp_width(F.lit(9.0)), editing.clamp_length(F.lit(0.1))).first()) == (6.0, 2.0)


def test_land_use(spark, tmp_path):
    text = landuse.query_text("Helsinki", "camping")
    assert text.count("way[") == 3 and '"091"' in text and len(landuse.query_key(text)) == 16
    for bad in (("Espoo", "industrial"), ("Turku", "industrial"), ("Helsinki", "x")):
        with pytest.raises(ValueError):
            landuse.query_text(*bad)
    node = [{"lat": 60.0, "lon": 25.0}, {"lat": 60.0, "lon": 25.1}, {"lat": 60.1, "lon": 25.1}, {"lat": 60.1, "lon": 25.0}]
    elements = [{"type": "way", "id": 1, "tags": {"landuse": "industrial"}, "geometry": node}, {"type": "way", "id": 2, "geometry": node[:3]}, {"type": "relation", "id": 3, "members": [{"role": "outer", "geometry": [*node, node[0]]}, {"role": "inner", "geometry": node}, {"role": "", "geometry": node}]}, {"type": "node", "id": 4}]
    (tmp_path / "o.json").write_text(json.dumps({"elements": elements}))
    rows = landuse.polygons(spark, str(tmp_path / "o.json")).collect()
    assert sorted(r["element_id"] for r in rows) == [1, 3, 3] and all(len(r["ring"]) == 5 for r in rows)


def test_descriptions(spark):
    assert yaml.safe_load(exports.dataset_yaml("/d"))["names"] == {0: "truck", 1: "bus", 2: "van", 3: "car"}
    proposals = spark.createDataFrame([(2, "b", [1.0, 2.0, 3.0, 4.00049], "n"), (1, "a", [0.0, 0.0, 1.0, 1.0], "m")], "pick int, name string, bbox array<double>, notes string")
    assert [a["name"] for a in yaml.safe_load(exports.proposal_yaml(proposals))["aois"]] == ["a", "b"]


def test_yolo_export(spark, tmp_path):
    windows = spark.createDataFrame([("train", "w0", "here", 0, 0), ("train", "w1", "here", 5000, 0)], "split string, stem string, aoi string, x long, y long")
    boxes = frame(spark, [("car", 1.0, box(50, -50, 5, 2, 0)), ("car", 1.0, box(0, -50, 5, 2, 0))]).withColumnsRenamed({"id": "det_id", "label": "class"}).withColumn("aoi", F.lit("here"))
    held = labels.yolo_boxes(windows.select("aoi", "x", "y"), boxes, size_px=1024, metres_px=0.125, origin_e=0.0, origin_n=0.0)
    assert exports.write_yolo(held, windows, str(tmp_path / "y")) == 2
    text = {p.stem: p.read_text() for p in (tmp_path / "y" / "train").iterdir()}
    assert text["w1"] == "" and text["w0"].startswith("3 0.") and len(text["w0"].split()) == 9


def test_staging_leaves_staged_areas_alone(spark, tmp_path):
    folder = str(tmp_path / "s")
    first = frame(spark, [("car", 0.5, box(0, 0, 5, 2, 0))]).withColumn("aoi", F.lit(None).cast("string"))
    exports.stage(first, folder)
    both = first.withColumn("aoi", F.lit("unknown")).unionByName(first.withColumn("aoi", F.lit("b")).unionByName(first.withColumn("aoi", F.lit("unknown"))))
    exports.stage(both, folder)
    counts = {r["aoi"]: r["count"] for r in spark.read.parquet(folder).groupBy("aoi").count().collect()}
    assert counts == {"unknown": 1, "b": 1}
    exports.stage(both, folder, force=True)
    assert spark.read.parquet(folder).count() == 3 and set(spark.read.parquet(folder).columns) >= {"status", "class"}


def test_runs_are_logged(spark, tmp_path):
    exports.log_run(spark, str(tmp_path / "m"), "r1", {"zoom": 16}, {"recall": 0.9})
    assert {(r["kind"], r["key"], r["value"]) for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {("param", "zoom", "16"), ("metric", "recall", "0.9")}
