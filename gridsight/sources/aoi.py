"""Areas of interest from YAML collections, GeoJSON files or ``a,b,c,d`` bounds."""

from __future__ import annotations

import json
import math
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import crs

#: What an area may be for and which split it may be in.
ROLES, SPLITS = ("positive", "hard-negative", "background"), ("train", "validation")
WGS84, GRID = 4326, 3879
SCHEMA = "pos int, name string, role string, split string, notes string, srid int, source_bbox array<double>, corners array<struct<x: double, y: double>>"


def _bounds(values: object, where: str) -> list[float]:
    try:
        found = [float(v) for v in values]
    except (TypeError, ValueError):
        raise ValueError(f"{where}: bounds must be four numbers") from None
    if len(found) != 4 or not all(map(math.isfinite, found)) or found[0] > found[2] or found[1] > found[3]:
        raise ValueError(f"{where}: bounds must be four finite numbers, least before greatest")
    return found


def _srid(value: object, where: str) -> int:
    try:
        found = int(str(value).upper().removeprefix("EPSG:"))
    except ValueError:
        raise ValueError(f"{where}: unknown CRS {value!r}") from None
    if found != WGS84:
        crs.grid_of(found)
    return found


def _row(pos: int, name: str, bbox: list[float] | None, srid: int, points: list[tuple[float, float]], entry: dict) -> tuple:
    role, split = entry.get("role", ROLES[0]), entry.get("split", SPLITS[0])
    for kind, value, legal in (("role", role, ROLES), ("split", split, SPLITS)):
        if value not in legal:
            raise ValueError(f"{name}: {kind} {value!r} is not one of {', '.join(legal)}")
    return (pos, name, role, split, entry.get("notes"), srid, bbox, points)


def _corners(bbox: list[float]) -> list[tuple[float, float]]:
    return [(bbox[i], bbox[j]) for i in (0, 2) for j in (1, 3)]


def _positions(node: object):
    """Every position at any depth of nested coordinates."""
    if isinstance(node, list) and len(node) >= 2 and all(isinstance(v, (int, float)) for v in node[:2]):
        yield float(node[0]), float(node[1])
    elif isinstance(node, list):
        for inner in node:
            yield from _positions(inner)


def geojson_positions(document: dict) -> list[tuple[float, float]]:
    shapes = [f.get("geometry") for f in document["features"]] if document.get("type") == "FeatureCollection" else [document.get("geometry", document)]
    found: list[tuple[float, float]] = []
    for shape in filter(None, shapes):
        parts = shape["geometries"] if shape.get("type") == "GeometryCollection" else [shape]
        for part in parts:
            found += _positions(part.get("coordinates", []))
    return found


def _collection(path: Path) -> list[tuple]:
    body = yaml.safe_load(path.read_text())
    if not isinstance(body, dict) or "crs" not in body:
        raise ValueError(f"{path}: a mapping with a crs is needed")
    entries = body.get("aois")
    if not isinstance(entries, list) or not entries:
        raise ValueError(f"{path}: no areas")
    srid, rows = _srid(body["crs"], str(path)), []
    for pos, entry in enumerate(entries):
        if not isinstance(entry, dict) or not entry.get("name"):
            raise ValueError(f"{path}: area {pos} has no name")
        bbox = _bounds(entry.get("bbox"), str(entry["name"]))
        rows.append(_row(pos, str(entry["name"]), bbox, srid, _corners(bbox), entry))
    names = [r[1] for r in rows]
    if len(set(names)) < len(names):
        raise ValueError(f"{path}: names are not unique")
    return rows


def load(spark: SparkSession, spec: str, *, srid: int = WGS84, name: str | None = None) -> DataFrame:
    """Areas with their envelopes on the grid: ``min_e, min_n, max_e, max_n``.

    A YAML collection brings its own CRS and may be narrowed by ``name``; a GeoJSON file
    gives one area, its extent; anything else is read as bounds. Every corner or position
    is projected before extremes are taken.
    """
    path = Path(spec)
    if path.suffix.lower() in (".yaml", ".yml"):
        rows = _collection(path)
        if name is not None:
            known = ", ".join(r[1] for r in rows)
            rows = [r for r in rows if r[1] == name]
            if not rows:
                raise ValueError(f"no area {name!r}; known: {known}")
    elif name is not None:
        raise ValueError("a name only selects from a YAML collection")
    elif path.is_file():
        points = geojson_positions(json.loads(path.read_text()))
        if not points:
            raise ValueError(f"{spec}: no positions")
        rows = [_row(0, path.stem, None, srid, points, {})]
    else:
        bbox = _bounds(spec.split(","), spec)
        rows = [_row(0, "bbox", bbox, srid, _corners(bbox), {})]
    frame = spark.createDataFrame(rows, SCHEMA)
    source = rows[0][5]

    def on_grid(p):
        e, n = crs.reproject(p["x"], p["y"], source, GRID)
        return F.struct(e.alias("e"), n.alias("n"))

    placed = frame.withColumn("g", F.transform("corners", on_grid))
    return placed.select("pos", "name", "role", "split", "notes", "srid", "source_bbox", F.array_min("g.e").alias("min_e"), F.array_min("g.n").alias("min_n"), F.array_max("g.e").alias("max_e"), F.array_max("g.n").alias("max_n"))
