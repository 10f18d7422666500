"""Readers, writers and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gridsight.sources import aoi, geojson, imagery, manifest
from gridsight.streaming import manifest as streaming
from tests.test_geometry import box
from tests.test_operators import frame

GOOD = "crs: EPSG:3879\naois:\n- {name: a, bbox: [25496000, 6673000, 25496500, 6673500]}\n- {name: b, bbox: [25497000, 6673000, 25497500, 6673500], role: hard-negative, split: validation, notes: n}\n"


def test_area_collections(spark, tmp_path):
    path = tmp_path / "a.yaml"
    path.write_text(GOOD)
    rows = aoi.load(spark, str(path)).orderBy("pos").collect()
    assert [(r["name"], r["role"], r["split"]) for r in rows] == [("a", "positive", "train"), ("b", "hard-negative", "validation")]
    assert rows[0]["max_e"] == 25496500 and aoi.load(spark, str(path), name="b").count() == 1
    with pytest.raises(ValueError, match="a, b"):
        aoi.load(spark, str(path), name="c")
    for body in ("- 1", "aois: []", "crs: EPSG:1\naois: [{name: a, bbox: [0, 0, 1, 1]}]", GOOD.replace("name: b", "name: a"), GOOD.replace("hard-negative", "odd"), GOOD.replace("validation", "odd"), GOOD.replace("6673500]}", "6673500, 1]}"), GOOD.replace("[25496000", "[x"), GOOD.replace("[25496000", "[25496900")):
        path.write_text(body)
        with pytest.raises(ValueError):
            aoi.load(spark, str(path))


def test_areas_from_bounds_and_files(spark, tmp_path):
    got = aoi.load(spark, "24.9384,60.1699,25.1960,60.2090").first()
    assert got["min_e"] < 25496581 and got["max_e"] > 25510800
    with pytest.raises(ValueError):
        aoi.load(spark, "1,2,3")
    with pytest.raises(ValueError):
        aoi.load(spark, "1,2,3,4", name="x")
    file = tmp_path / "r.geojson"
    file.write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": None}, {"geometry": {"type": "MultiPolygon", "coordinates": [[[[1, 2], [5, 2], [5, 7], [1, 2]]], [[[0, 3], [1, 9], [0, 4], [0, 3]]]]}}]}))
    row = aoi.load(spark, str(file), srid=3879).first()
    assert (row["min_e"], row["min_n"], row["max_e"], row["max_n"]) == (0, 2, 5, 9)


def test_geojson_round_trip(spark, tmp_path):
    boxes = frame(spark, [("car", 0.91239, box(25496000, 6673000, 16, 2.5, 0)), ("van", 0.5, box(25496100, 6673000, 5, 2, 30))]).withColumn("aoi", F.lit("here"))
    path = str(tmp_path / "out.geojson")
    assert geojson.write_collection(boxes, path, source_layer="L", zoom=16) == 2
    back = geojson.to_detections(geojson.read(spark, path)).orderBy("position").collect()
    assert [r["label"] for r in back] == ["car", "van"] and back[0]["confidence"] == 0.9124 and back[0]["aoi"] == "here"
    assert geojson.read(spark, path).filter("zoom = 16 and source_layer = 'L'").count() == 2
    document = json.loads((tmp_path / "out.geojson").read_text())
    ring = document["features"][0]["geometry"]["coordinates"][0]
    assert len(ring) == 5 and ring[0] == ring[4]
    document["crs"]["properties"]["name"] = "urn:ogc:def:crs:EPSG::4326"
    (tmp_path / "bad.geojson").write_text(json.dumps(document))
    with pytest.raises(Exception, match="CRS"):
        geojson.read(spark, str(tmp_path / "bad.geojson")).collect()
    geojson.write_lines(boxes, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 2


def test_work_log(spark, tmp_path):
    lines = ['{"type": "run", "seq": 1, "params": {"zoom": "15"}}', "", '{"type": "run", "seq": 2, "params": {"zoom": "16"}}', '{"seq": 3, "cell": "a", "status": "running"}', '{"seq": 4, "cell": "a", "status": "done"}', '{"seq": 5, "cell": "b", "sta']
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    log = manifest.read(spark, str(tmp_path / "log.jsonl"))
    assert log.count() == 4 and manifest.header(log).first()["params"] == {"zoom": "16"}
    assert manifest.run_key({"b": 1, "a": "x"}) == {"a": "x", "b": "1"}
    manifest.append(spark.createDataFrame([(9, "c", "done")], "seq long, cell string, status string"), str(tmp_path / "more"))
    assert manifest.read(spark, str(tmp_path / "more")).first()["cell"] == "c"


def test_tiles_are_tried_again():
    answers = [(500, b"", None), (200, b"<xml", "7"), (200, b"\xff\xd8ok", None)]
    waits: list[float] = []
    assert imagery.get_tile(lambda _: answers.pop(0), {}, sleep=waits.append) == b"\xff\xd8ok" and waits == [1.0, 7.0]
    calls = []
    with pytest.raises(LookupError):
        imagery.get_tile(lambda r: calls.append(r) or (404, b"", None), {}, sleep=waits.append)
    assert len(calls) == 1
    with pytest.raises(OSError):
        imagery.get_tile(lambda _: (429, b"", "soon"), {}, sleep=waits.append)
    assert imagery.pause(1, "900") == 30 and imagery.pause(2, "bad") == 4
    assert imagery.layer_of(2025).startswith("Ortoilmakuva")
    with pytest.raises(ValueError):
        imagery.layer_of(2022)


def test_tiles_are_cached(spark, tmp_path):
    tiles = spark.createDataFrame([(16, 1, 2), (16, 1, 3), (16, 9, 9)], "zoom int, col long, row long")

    def fetch(request):
        return (404, b"", None) if request["col"] == 9 else (200, b"\xff\xd8", None)

    first = {(r["col"], r["row"]): (r["cached"], r["error"]) for r in imagery.fetch_tiles(tiles, str(tmp_path), "L", fetch).collect()}
    assert first[(1, 2)] == (False, None) and first[(9, 9)][1] == "status 404"
    assert all(r["cached"] for r in imagery.fetch_tiles(tiles.filter("col = 1"), str(tmp_path), "L", fetch).collect())


def test_log_as_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k, rows in enumerate([[(1, "a", "running"), (2, "b", "done")], [(3, "a", "done")]]):
        (source / f"{k}.json").write_text("\n".join(json.dumps({"seq": s, "cell": c, "status": t, "ts": "2025-01-01T00:00:00Z"}) for s, c, t in rows))
    query = streaming.latest(streaming.log_stream(spark, str(source), files=1)).writeStream.outputMode("complete").format("memory").queryName("latest").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r["cell"], r["status"]) for r in spark.sql("SELECT * FROM latest").collect()} == {("a", "done"), ("b", "done")}
    cells = streaming.log_stream(spark, str(source))
    for _ in range(2):
        streaming.work(cells, lambda f: f.select("cell", "seq"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stream_windows(spark):
    rows = spark.createDataFrame([(1, "2025-01-01 00:00:00", "done"), (1, "2025-01-01 00:00:00.5", "done"), (1, "2025-01-01 00:00:02", "done")], "box long, ts string, status string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r["edits"] for r in streaming.edit_sessions(rows).collect()) == [1, 2]
    assert streaming.activity(rows).first()["n"] == 3
