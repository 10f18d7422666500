"""Regions, layers, stored labels, windows put together from tiles, and sweeps that go on."""

from __future__ import annotations

import json
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridsight.functions import crs
from gridsight.functions import geometry as G
from gridsight.operators import chunks, detect, polygons
from gridsight.sources import imagery, labelstore, layers, regions
from gridsight.sources.geojson import GRID_NAME

E0, N0 = 25496000.0, 6672000.0


def square(x, y, size):
    return [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "geometry": kind and {"type": kind, "coordinates": coordinates}, "properties": properties}


COLLECTION = {
    "type": "FeatureCollection",
    "features": [
        feature("Polygon", [square(E0, N0, 100), square(E0 + 40, N0 + 40, 20)], tyyppi="1", name="holed"),
        feature("MultiPolygon", [[square(E0 + 200, N0, 10)], [square(E0 + 300, N0, 20)]], name="islands"),
        feature(None, None, name="null"),
        feature("Point", [E0, N0], name="point"),
        feature("Polygon", [[[E0, N0], [E0 + 1, N0]]], name="short"),
        feature("Polygon", [], name="empty"),
        feature("Polygon", [[[E0, N0], [E0 + 10, N0 + 10], [E0 + 10, N0], [E0, N0 + 10], [E0, N0]]], name="bow"),
    ],
}


def wkb(rings):
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)


def gpkg(path, rows, srid):
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_id INTEGER, organization_coordsys_id INTEGER)")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, srs_id INTEGER)")
    con.execute("CREATE TABLE parts (fid INTEGER PRIMARY KEY, name TEXT, geom BLOB)")
    con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (7, ?)", (srid,))
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('parts', 'geom', 7)")
    con.executemany("INSERT INTO parts (name, geom) VALUES (?, ?)", rows)
    con.commit()
    con.close()


def test_geojson_regions(spark, tmp_path):
    path = f"{tmp_path}/r.geojson"
    open(path, "w").write(json.dumps(COLLECTION))
    rows = {r["properties"]["name"]: r["shape"] for r in regions.read_geojson(spark, path, srid=3879).collect()}
    assert set(rows) == {"holed", "islands", "bow"}
    parts = polygons.explode_parts(regions.load(spark, path, srid=3879).withColumn("name", F.col("properties")["name"]).drop("properties"))
    assert {(r["name"], r["part"]): round(r["area_m2"], 6) for r in parts.filter("name <> 'bow'").collect()} == {("holed", 0): 9600.0, ("islands", 0): 100.0, ("islands", 1): 400.0}
    open(f"{tmp_path}/none.geojson", "w").write(json.dumps({"type": "FeatureCollection", "features": COLLECTION["features"][2:4]}))
    with pytest.raises(ValueError):
        regions.load(spark, f"{tmp_path}/none.geojson")
    open(f"{tmp_path}/bare.json", "w").write(json.dumps({"type": "Polygon", "coordinates": [[[24.9, 60.1], [25.0, 60.1], [25.0, 60.2], [24.9, 60.1]]]}))
    (bare,) = regions.load(spark, f"{tmp_path}/bare.json").collect()
    lon, lat = crs.to_wgs84(F.lit(bare["shape"][0][0][0]["x"]), F.lit(bare["shape"][0][0][0]["y"]), 3879)
    assert spark.range(1).select(F.abs(lon - 24.9) < 1e-6, F.abs(lat - 60.1) < 1e-6).first() == (True, True)
    assert regions.write_geojson(regions.load(spark, path, srid=3879), f"{tmp_path}/out.geojson") == 3
    again = {r["properties"]["name"]: r["shape"] for r in regions.load(spark, f"{tmp_path}/out.geojson", srid=3879).collect()}
    assert again == rows and json.load(open(f"{tmp_path}/out.geojson"))["crs"]["properties"]["name"] == GRID_NAME


def test_geopackages(spark, tmp_path):
    header = b"GP\x00\x03" + struct.pack("<i", 7) + struct.pack("<dddd", 0, 1, 0, 1)
    multi = struct.pack("<BII", 1, 6, 2) + wkb([square(E0, N0, 10)]) + wkb([square(E0 + 50, N0, 20)])
    rows = [(f"p{k}", header + wkb([square(E0 + 100 * k, N0, 50), square(E0 + 100 * k + 10, N0 + 10, 10)])) for k in range(30)] + [("multi", b"GP\x00\x01" + struct.pack("<i", 7) + multi), ("none", None), ("point", header + struct.pack("<BIdd", 1, 1, 0, 0))]
    gpkg(f"{tmp_path}/r.gpkg", rows, 3879)
    spark.dataSource.register(regions.GpkgSource)
    raw = spark.read.format("gridsight_gpkg").option("path", f"{tmp_path}/r.gpkg").option("rows", 7).load()
    assert raw.count() == 31 and raw.rdd.getNumPartitions() == 5
    parts = polygons.explode_parts(regions.load(spark, f"{tmp_path}/r.gpkg").withColumn("name", F.col("properties")["name"]).drop("properties"))
    areas = {(r["name"], r["part"]): round(r["area_m2"], 6) for r in parts.collect()}
    assert len(areas) == 32 and areas[("p3", 0)] == 2400.0 and areas[("multi", 1)] == 400.0
    with pytest.raises(Exception, match="no_layer"):
        regions.read_gpkg(spark, f"{tmp_path}/r.gpkg", "no_layer").count()


def test_layers_are_fetched_once(spark, tmp_path):
    asked = []

    def send(params):
        asked.append(params)
        return 200, json.dumps(COLLECTION).encode(), None

    path = layers.fetch_layer(spark, "ns:streets", str(tmp_path), send, keep=("name",))
    assert path == layers.fetch_layer(spark, "ns:streets", str(tmp_path), send) and len(asked) == 1 and asked[0]["typeName"] == "ns:streets"
    assert all(set(f["properties"]) <= {"name"} for f in json.load(open(path))["features"])
    layers.fetch_layer(spark, "ns:streets", str(tmp_path), send, refresh=True)
    assert len(asked) == 2
    parts = {(r["part_name"], r["part"]): r["valid"] for r in layers.read_layer(spark, path, "part_id", part_name="name").collect()}
    assert parts == {("holed", 0): True, ("islands", 0): True, ("islands", 1): True, ("bow", 0): False}
    with pytest.raises(OSError):
        layers.fetch_layer(spark, "ns:other", str(tmp_path), lambda _: (500, b"", None))


def test_land_use_is_asked_again(spark, tmp_path):
    answers = [(429, b"", "1"), (200, b"[]", None), (200, json.dumps({"elements": [{"type": "node", "id": 1}]}).encode(), None)]
    waits, asked = [], []

    def send(params):
        asked.append(params)
        return answers[len(asked) - 1]

    path = layers.land_use(spark, "Helsinki", str(tmp_path), send, sleep=waits.append)
    assert len(asked) == 3 and len(waits) == 2 and layers.land_use(spark, "Helsinki", str(tmp_path), send) == path and len(asked) == 3
    kept = json.load(open(path))
    assert kept["attribution"] and kept["ref"] == "091" and kept["elements"]
    with pytest.raises(LookupError):
        layers.land_use(spark, "Helsinki", str(tmp_path), lambda _: (400, b"", None), profile="commercial", sleep=waits.append)
    with pytest.raises(OSError):
        imagery.ask(lambda: (503, b"", None), lambda _: True, sleep=waits.append)


def test_label_store(spark, tmp_path):
    folder = f"{tmp_path}/labels"
    rows = [(k, "confirmed", None if k else "car", 0.5, float(k)) for k in range(3)]
    frame = spark.createDataFrame(rows, "det_id long, status string, class string, confidence double, x0 double").withColumn("position", F.col("det_id"))
    assert labelstore.read(spark, folder, "a").count() == 0
    assert labelstore.save(frame, folder, "a", crs=GRID_NAME) == 3 and labelstore.save(frame.limit(1), folder, "b", crs=GRID_NAME) == 1
    assert labelstore.save(frame.limit(2), folder, "a", crs=GRID_NAME) == 2
    assert labelstore.read(spark, folder, "a").count() == 2 and labelstore.read(spark, folder, "b").count() == 1
    assert labelstore.save(frame.limit(0), folder, "a", crs=GRID_NAME) == 0 and labelstore.read(spark, folder, "a").count() == 0
    for crs_name, aoi in ((None, "a"), ("EPSG:4326", "a"), (GRID_NAME, "../a"), (GRID_NAME, "")):
        with pytest.raises(ValueError):
            labelstore.save(frame, folder, aoi, crs=crs_name)
    text = spark.range(1).select(labelstore.whole_numbers(F.lit('{"a":[1.0,-25.000,1.05],"b":"x:2.0,","c":3.0}'))).first()[0]
    assert text == '{"a":[1,-25,1.05],"b":"x:2.0,","c":3}' or text.startswith('{"a":[1,-25,1.05]') and text.endswith('"c":3}')


def _code(pixels):
    return struct.pack("<III", *pixels.shape) + pixels.tobytes()


def _pixels(data):
    return np.frombuffer(data[12:], np.uint8).reshape(struct.unpack("<III", data[:12]))


def test_windows_from_tiles(spark):
    whole = np.arange(1024 * 1024 * 3, dtype=np.uint64).astype(np.uint8).reshape(1024, 1024, 3)
    tiles = spark.createDataFrame([(c + 10, r + 20, bytearray(_code(whole[r * 256 : r * 256 + 256, c * 256 : c * 256 + 256]))) for c in range(4) for r in range(4) if (c, r) != (3, 3)], "tile_col long, tile_row long, body binary")
    windows = spark.createDataFrame([("a", 10 * 256 + 100, 20 * 256 + 30), ("a", 10 * 256, 20 * 256), ("b", 10 * 256 + 500, 20 * 256 + 500)], "area string, x long, y long")
    got = {(r["x"] - 2560, r["y"] - 5120): r["image"] for r in detect.stitch(windows, tiles, _pixels, _code, size=512).collect()}
    for (x, y), image in got.items():
        assert (image is None) if x == 500 else (_pixels(bytes(image)) == whole[y : y + 512, x : x + 512]).all()
    assert detect.window_tiles(windows.limit(1), size=512).count() in (4, 9)
    seen = Observation()
    detect.observed(detect.stitch(windows, tiles, _pixels, _code, size=512), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"windows": 3, "skipped": 1}
    assert [k for k in range(1, 251) if spark.range(1).select(detect.told(F.lit(k), F.lit(250))).first()[0]] == [1, 100, 200, 250]


class Two:
    """Finds one box of 10 m in every image, where two windows meet."""

    def detect(self, image):
        x = float(image.decode())
        return [("truck", 0.9, x, 0.0, x + 80, 0.0, x + 80, 20.0, x, 20.0)]


def test_areas_are_swept_by_themselves(spark):
    windows = spark.createDataFrame([("a", 0, 0, bytearray(b"900")), ("a", 784, 0, bytearray(b"116")), ("b", 0, 0, bytearray(b"900")), ("c", 5000, 0, None)], "area string, x long, y long, image binary")
    assert sorted(r["area"] for r in detect.sweep(windows, Two, 16).collect()) == ["a", "b"]
    assert [r["area"] for r in detect.sweep(windows, Two, 16, across=True).collect()] == ["a"]
    assert detect.sweep(windows, Two, 16, keep=["bus"]).count() == 0
    frame = spark.createDataFrame([(["Small Vehicle", "ship"],), (["truck"],), (None,), ([],)], "n array<string>")
    assert [r[0] for r in frame.select(detect.finds_vehicles(F.col("n"))).collect()] == [True, False, False, False]


def test_a_run_goes_on(spark, tmp_path):
    root = f"{tmp_path}/run"
    cells = spark.createDataFrame([(f"c{k}", E0 + 100 * k, N0, E0 + 100 * k + 100, N0 + 100) for k in range(4)], "cell string, min_e double, min_n double, max_e double, max_n double")
    parts = polygons.explode_parts(spark.createDataFrame([([[[(E0, N0), (E0 + 400, N0), (E0 + 400, N0 + 50), (E0, N0 + 50)]]],)], f"shape {polygons.MULTIPOLYGON}"))
    corners = {f"{a}{k}": v for k, (x, y) in enumerate([(-5, -2), (5, -2), (5, 2), (-5, 2)]) for a, v in (("x", x), ("y", y))}
    broken = ["c2"]

    def work(todo):
        spots = todo.select("cell", F.explode(F.array(*[F.struct(F.lit(k).alias("id"), F.lit(x).alias("x"), F.lit(y).alias("y")) for k, (x, y) in enumerate([(99.9, 20.0), (0.05, 20.0), (50.0, 20.0), (50.0, 80.0), (300.0, 20.0)])])).alias("s"), "min_e", "min_n")
        boxes = spots.select("cell", F.col("s.id").cast("long").alias("id"), F.lit("truck").alias("label"), (0.5 + F.col("s.id") / 10).alias("confidence"), *[(F.col("min_e") + F.col("s.x") + v if c[0] == "x" else F.col("min_n") + F.col("s.y") + v).alias(c) for c, v in corners.items()])
        return boxes, todo.filter(F.col("cell").isin(broken)).select("cell", F.lit("lost").alias("error"))

    assert chunks.run(cells, work, root, {"conf": 0.25}, parts=parts) == 4
    told = chunks.account(cells, root).first().asDict()
    assert (told["cells"], told["done"], told["failed"], told["pending"]) == (4, 3, 1, 1) and told["found"] == 9 and told["duplicates"] == 1
    with pytest.raises(ValueError, match="conf"):
        chunks.run(cells, work, root, {"conf": 0.5})
    assert chunks.run(cells, work, root, {"conf": 0.25}) == 0
    broken.clear()
    assert chunks.run(cells, work, root, {"conf": 0.25}, parts=parts, retry_failed=True) == 1
    told = chunks.account(cells, root).first().asDict()
    assert told["done"] == 4 and told["found"] == 12 and told["duplicates"] == 3 and chunks.merged(spark, root).count() == 9
    assert G.CORNERS[0] in chunks.finished(spark, root).columns
