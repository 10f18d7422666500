"""Detections and labels as GeoJSON: readers with a fixed schema, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import geometry as G

#: Fixed value: how a file names the grid it is in.
GRID_NAME = "urn:ogc:def:crs:EPSG::3879"
FILE = (
    "type string, crs struct<type: string, properties: struct<name: string>>, features array<struct<type: string, geometry: struct<type: string, coordinates: array<array<array<double>>>>, "
    "properties: struct<label: string, class: string, status: string, confidence: double, aoi: string, length_m: double, width_m: double, heading_deg: double, source_layer: string, zoom: int>>>"
)


def read(spark: SparkSession, path: str, *, require_grid: bool = True) -> DataFrame:
    """One row per feature: its properties, ``ring`` (closed, null if there is none), file and position in it.

    A file in another CRS, or without one, is an error when its rows are read.
    """
    files = spark.read.schema(FILE).json(path, multiLine=True)
    named = F.col("crs.properties.name")
    features = F.col("features")
    if require_grid:
        features = F.when(named == GRID_NAME, features).otherwise(F.raise_error(F.concat(F.lit("not in the grid's CRS: "), F.coalesce(named, F.lit("none")))))
    rows = files.select(F.col("_metadata.file_name").alias("file"), F.posexplode(features).alias("position", "f"))
    outline = F.get(F.col("f.geometry.coordinates"), F.lit(0))
    ring = F.when(F.col("f.geometry.type") == "Polygon", F.transform(outline, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.select("file", "position", "f.properties.*", ring.alias("ring"))


def to_detections(features: DataFrame) -> DataFrame:
    """Four-cornered features as detections with corner columns; others are left out."""
    boxes = features.filter(F.size("ring") == 5)
    corners = {f"{a}{k}": F.get(F.col("ring"), F.lit(k))[a] for k in range(4) for a in ("x", "y")}
    return boxes.select("file", "position", F.coalesce("label", F.lit("")).alias("label"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("aoi", F.lit("")).alias("aoi"), *[c.alias(n) for n, c in corners.items()])


def _rounded(value: Column, digits: int) -> Column:
    return F.floor(value * 10**digits + F.lit(0.5)) / 10**digits


def features_of(detections: DataFrame, **constants: object) -> DataFrame:
    """``(aoi, feature)`` with a feature as JSON text: closed ring in millimetres, rounded measures, constants last."""
    points = [F.array(_rounded(F.col(f"x{k}"), 3), _rounded(F.col(f"y{k}"), 3)) for k in (0, 1, 2, 3, 0)]
    measures = [_rounded(F.col("confidence"), 4).alias("confidence"), _rounded(G.length_m(), 2).alias("length_m"), _rounded(G.width_m(), 2).alias("width_m"), _rounded(G.heading_deg(), 1).alias("heading_deg")]
    rest = [F.col(c) for c in ("label", "class", "status") if c in detections.columns]
    properties = F.struct(*rest, *measures, F.col("aoi"), *[F.lit(v).alias(k) for k, v in constants.items()])
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*points)).alias("coordinates"))
    return detections.select("aoi", F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("feature"))


def write_lines(detections: DataFrame, folder: str, **constants: object) -> None:
    """Features as newline-delimited GeoJSON, a folder for each area: written in parallel, in any number of files."""
    features_of(detections, **constants).select("aoi", F.col("feature").alias("value")).write.partitionBy("aoi").mode("errorifexists").text(folder)


def write_collection(detections: DataFrame, path: str, **constants: object) -> int:
    """One FeatureCollection for an editor, streamed through the driver a partition at a time; returns its rows."""
    count = 0
    with open(path, "w", encoding="utf-8") as file:
        file.write('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "' + GRID_NAME + '"}}, "features": [')
        for row in features_of(detections, **constants).toLocalIterator():
            file.write(("," if count else "") + "\n" + row["feature"])
            count += 1
        file.write("\n]}\n")
    return count


def write_proposals(proposals: DataFrame, path: str, *, operating_confidence: float) -> int:
    """Proposed cells (a few) with what speaks for each, as one collection; returns how many."""
    b = [F.col("bbox")[k] for k in range(4)]
    corners = F.array(*[F.array(F.round(b[i], 3), F.round(b[j], 3)) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3), (0, 1))])
    signals = [F.col(c) for c in ("n", "n_near", "n_size")] + [F.round(c, 4).alias(c) for c in ("mean_confidence", "top_confidence")] + [F.round("coverage", 3).alias("coverage")]
    about = F.struct("name", "stratum", "notes", *signals, F.lit(operating_confidence).alias("operating_confidence"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates"))
    rows = proposals.orderBy("pick").select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), about.alias("properties"))).alias("f")).collect()
    with open(path, "w", encoding="utf-8") as file:
        file.write('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "' + GRID_NAME + '"}}, "features": [\n' + ",\n".join(r["f"] for r in rows) + "\n]}\n")
    return len(rows)
