"""Commands end to end on small tables."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from gridsight import cli
from gridsight.functions import geometry as G
from gridsight.operators import labels
from tests.test_geometry import box
from tests.test_regions import E0, N0, feature, square

CORNERS = ", ".join(f"{c} double" for c in G.CORNERS)


class codec:
    """Images as they are in memory, behind the two bytes that mark a JPEG."""

    @staticmethod
    def decode(data):
        return np.frombuffer(data[14:], np.uint8).reshape(struct.unpack("<III", data[2:14]))

    @staticmethod
    def encode(pixels):
        return b"\xff\xd8" + struct.pack("<III", *pixels.shape) + pixels.tobytes()


class Bright:
    """A truck of 10 m at every brightest pixel."""

    classes = ["large vehicle", "ship"]

    def detect(self, image):
        pixels = codec.decode(image)
        return [("large vehicle", 0.9, x - 40.0, y - 10.0, x + 40.0, y - 10.0, x + 40.0, y + 10.0, x - 40.0, y + 10.0) for y, x in np.argwhere(pixels[:, :, 0] == 255)]


def send(request):
    """A tile with a bright pixel in the middle of every fourth column and row."""
    pixels = np.zeros((256, 256, 1), np.uint8)
    if request["col"] % 4 == 0 and request["row"] % 4 == 0:
        pixels[128, 128] = 255
    return 200, codec.encode(pixels), None


def missing(request):
    return 404, b"", None


@pytest.fixture
def place(tmp_path):
    (tmp_path / "areas.yaml").write_text(yaml.safe_dump({"crs": "EPSG:3879", "aois": [{"name": "one", "bbox": [E0, N0, E0 + 300, N0 + 200]}, {"name": "two", "bbox": [E0 + 200, N0, E0 + 500, N0 + 100], "role": "background", "split": "validation"}]}))
    return tmp_path


def run(spark, *arguments):
    return cli.main([str(a) for a in arguments], spark)


def test_areas(spark, place, capsys):
    assert run(spark, "aois", place / "areas.yaml") == 0
    text = capsys.readouterr().out
    assert "a_id one  b_id two  area_m2 10000.0" in text and "no validation area has the role positive" in text
    with pytest.raises(ValueError):
        run(spark, "aois", place / "areas.yaml", "--role", "odd")
    with pytest.raises(ValueError):
        run(spark, "aois", place / "areas.yaml", "--role", "hard-negative")


def test_tiles_to_detections(spark, place, capsys):
    tiles = ["--cache", place / "cache", "--year", 2025]
    assert run(spark, "fetch", place / "areas.yaml", *tiles, "--send", "tests.test_cli:missing") == 1
    span = f"{E0 - 200},{N0 - 200},{E0 + 700},{N0 + 400}"
    assert run(spark, "fetch", span, "--srid", 3879, *tiles, "--send", "tests.test_cli:send") == 0
    assert run(spark, "fetch", span, "--srid", 3879, *tiles, "--send", "tests.test_cli:missing") == 0, "all are cached"
    model = ["--detector", "tests.test_cli:Bright", "--codec", "tests.test_cli:codec"]
    assert run(spark, "bootstrap", place / "areas.yaml", *tiles, *model, "--out", place / "first") == 0
    assert run(spark, "detect", place / "areas.yaml", "--srid", 3879, *tiles, *model, "--out", place / "plain") == 0
    plain = spark.read.parquet(str(place / "plain"))
    assert plain.count() == spark.read.parquet(str(place / "first")).count() > 0 and {r[0] for r in plain.select("aoi").distinct().collect()} == {"one", "two"}
    region = {"type": "FeatureCollection", "features": [feature("Polygon", [square(E0 + 20, N0 + 20, 150)])]}
    (place / "region.geojson").write_text(json.dumps(region))
    swept = ["detect", "--region", place / "region.geojson", "--srid", 3879, "--checkpoint", place / "run", "--cell-size", 100, *tiles, *model]
    assert run(spark, *swept, "--out", place / "cells") == 0
    capsys.readouterr()
    assert run(spark, *swept, "--merge-only", "--out", place / "again") == 0
    assert "pending 0" in capsys.readouterr().out
    cx, cy = G.centre()
    inside = {(r[0], r[1]) for r in spark.read.parquet(str(place / "cells")).select(F.round(cx, 2), F.round(cy, 2)).collect()}
    wide = {(r[0], r[1]) for r in plain.select(F.round(cx, 2), F.round(cy, 2)).collect()}
    assert inside == {p for p in wide if E0 + 20 < p[0] < E0 + 170 and N0 + 20 < p[1] < N0 + 170} and inside
    with pytest.raises(ValueError):
        run(spark, *swept, "--confidence", 0.5, "--out", place / "other")
    with pytest.raises(ValueError):
        run(spark, "detect", *tiles, *model, "--out", place / "none")


def _detections(spark, path, rows):
    made = [(k, "truck" if k % 2 else "car", 0.5 + k % 5 / 10, *box(E0 + x, N0 + y, 10, 3, 0), aoi) for k, (x, y, aoi) in enumerate(rows)]
    spark.createDataFrame(made, f"id long, label string, confidence double, {CORNERS}, aoi string").write.parquet(str(path))


def test_enrich_package_and_analyse(spark, place):
    for name, features in {
        "districts": [feature("Polygon", [square(E0, N0, 200)], nimi_fi="North"), feature(None, None, nimi_fi="none")], "streets": [feature("Polygon", [square(E0, N0, 50)], kadun_nimi="Katu", kayttotarkoitus="Asuntokatu")],
        "parking": [feature("Polygon", [square(E0 + 100, N0 + 100, 30)])], "parts": [feature("Polygon", [square(E0, N0, 40)], alatyyppi="Pysäköintialue 1")],
    }.items():
        (place / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    _detections(spark, place / "d", [(20, 20, "one"), (45, 45, "one"), (110, 110, "one"), (150, 20, "one"), (900, 900, "one"), (51, 10, "one")])
    layers = [x for n in ("districts", "streets", "parking", "parts") for x in (f"--{n}", place / f"{n}.geojson")]
    assert run(spark, "enrich", "--input", place / "d", "--out", place / "e", *layers) == 0
    got = {r["id"]: (r["district"], r["kadun_nimi"], r["context"]) for r in spark.read.parquet(str(place / "e")).collect()}
    assert got == {0: ("North", "Katu", "parking"), 1: ("North", "Katu", "street"), 2: ("North", None, "parking"), 3: ("North", None, "other"), 4: (None, None, "other"), 5: ("North", "Katu", "other")}
    columns = {c: F.lit("x") for c in ("district", "postal_code", "street", "street_type", "context", "street_part")}
    spark.read.parquet(str(place / "d")).withColumns(columns).write.parquet(str(place / "y"))
    assert run(spark, "package", "--out", place / "all", f"2024={place / 'y'}", f"2025={place / 'y'}") == 0
    assert run(spark, "analyse", "--input", place / "all", "--out", place / "grids", "--cell-size", 250, "--confidence", 0.6) == 0
    points = {(r["year"], r["n"]) for r in spark.read.parquet(str(place / "grids/points")).groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert points == {(2024, 2), (2025, 2)} and spark.read.parquet(str(place / "grids/grid")).agg(F.sum("n")).first()[0] == 4


def test_stage_progress_export_and_eval(spark, place, capsys):
    _detections(spark, place / "d", [(50 + 20 * (k % 10), 20 + 20 * (k // 10), "one") for k in range(80)])
    assert run(spark, "stage", "--input", place / "d", "--out", place / "staged") == 0
    staged = spark.read.parquet(str(place / "staged"))
    assert staged.count() == 80 and {r[0] for r in staged.select("status").distinct().collect()} == {"candidate"}
    reviewed = staged.withColumn("det_id", F.col("id")).withColumns({"status": F.lit("confirmed"), "class": F.when(F.col("id") < 70, "truck").otherwise("car")})
    reviewed.write.parquet(str(place / "labels"))
    assert run(spark, "progress", "--labels", place / "labels") == 0 and "rate 0" in capsys.readouterr().out
    assert run(spark, "export", place / "areas.yaml", "--labels", place / "labels", "--out", place / "y") == 0
    files = list((place / "y/labels").glob("*/one_*.txt"))
    assert files and any(f.read_text() for f in files) and "split train" in capsys.readouterr().out
    reviewed.withColumn("class", F.lit("tram")).write.parquet(str(place / "bad"))
    assert run(spark, "export", place / "areas.yaml", "--labels", place / "bad", "--out", place / "z") == 1 and "and 60 more" in capsys.readouterr().out
    spark.createDataFrame([(0, 0.3, 0.9, 0.95), (1, 0.6, 0.95, 0.5)], "i int, px double, p double, r double").write.parquet(str(place / "curve"))
    spark.read.parquet(str(place / "d")).withColumn("label", F.when(F.col("id") < 72, "truck").otherwise("car")).write.parquet(str(place / "good"))
    rest = ["--labels", place / "labels", "--curve", place / "curve"]
    assert run(spark, "eval", place / "areas.yaml", "--input", place / "good", *rest) == 0 and "PASS" in capsys.readouterr().out
    assert run(spark, "eval", place / "areas.yaml", "--input", place / "d", *rest) == 1 and "FAIL" in capsys.readouterr().out
    assert labels.CLASSES[0] == "truck"


def test_region_and_mine(spark, place, capsys):
    districts = [feature("MultiPolygon", [[square(E0, N0, 1000)], [square(E0 + 2000, N0, 100)]], tyyppi="1"), feature("Polygon", [square(E0, N0 + 2000, 100)], tyyppi="2")]
    (place / "districts.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": districts}))
    (place / "roads.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("LineString", [[E0 - 10, N0 + 50], [E0 + 10, N0 + 50]]), feature("Point", [1, 2])]}))
    assert run(spark, "region", "--districts", place / "districts.geojson", "--roads", place / "roads.geojson", "--land-type", "1", "--out", place / "region") == 0
    assert "kept 1  dropped 1" in capsys.readouterr().out and spark.read.parquet(str(place / "region")).count() == 1
    lon, lat = 25.0, 60.2
    nodes = [{"lon": lon + dx, "lat": lat + dy} for dx, dy in ((0, 0), (0.05, 0), (0.05, 0.02), (0, 0.02), (0, 0))]
    (place / "use.json").write_text(json.dumps({"elements": [{"type": "way", "id": 1, "geometry": nodes}]}))
    _detections(spark, place / "d", [(4000.0, 4000.0, "one")])
    assert run(spark, "mine", place / "areas.yaml", "--input", place / "d", "--out", place / "next", "--land-use", place / "use.json", "--operating", 0.6, "--count", 4, "--pool", 30) == 0
    picks = yaml.safe_load((place / "next.yaml").read_text())["aois"]
    made = json.loads((place / "next.geojson").read_text())["features"]
    assert len(picks) == len(made) == 4 and [p["name"] for p in picks] == [f["properties"]["name"] for f in made] and all(p["notes"] for p in picks)
    spots = [p["bbox"][:2] for p in picks]
    assert all((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 >= 600**2 for i, a in enumerate(spots) for b in spots[:i])
    with pytest.raises(ValueError):
        run(spark, "mine", place / "areas.yaml", "--input", place / "d", "--out", place / "n", "--land-use", place / "use.json", "--operating", 0.6, "--count", 0)
