"""Layers of map services: fetched once, kept in a shared folder, read and cleaned by Spark.

``send`` is what talks to a service (status, body, Retry-After), so tests and other
transports bring their own. A layer is written beside its place and moved there, so a
fetch that is cut off leaves nothing that is trusted.

Defined results: a null, empty or malformed geometry is left out; a ring whose sides
cross is kept with ``valid`` false; a cached layer is used as it is unless it is to be
refreshed; an answer to another query is no cache.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.operators import polygons
from gridsight.sources import imagery, landuse, regions
from gridsight.sources.geojson import GRID_NAME
from gridsight.staging import exists

Send = Callable[[dict[str, str]], tuple[int, bytes, str | None]]
#: Fixed value: who is to be named with the land use.
ATTRIBUTION = "© OpenStreetMap contributors"


def request(layer: str) -> dict[str, str]:
    """Parameters that ask for a whole layer as GeoJSON on the grid."""
    return {"service": "WFS", "version": "2.0.0", "request": "GetFeature", "typeName": layer, "outputFormat": "application/json", "srsName": GRID_NAME}


def place(root: str, layer: str) -> str:
    """Where a layer is kept: by its name without the service's prefix."""
    return f"{root.rstrip('/')}/{layer.rpartition(':')[2]}.geojson"


def _store(spark: SparkSession, path: str, text: str) -> None:
    """Write a file through Hadoop's file systems, under another name first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, part = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.part"))
    fs = target.getFileSystem(conf)
    stream = fs.create(part, True)
    stream.write(text.encode())
    stream.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{path} could not be written")


def _object(body: bytes) -> dict | None:
    try:
        found = json.loads(body)
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def fetch_layer(spark: SparkSession, layer: str, root: str, send: Send, *, keep: tuple[str, ...] | None = None, refresh: bool = False) -> str:
    """The path of a layer, fetched by one request if it is not there; ``keep`` names the properties worth keeping."""
    path = place(root, layer)
    if exists(spark, path) and not refresh:
        return path
    status, body, _ = send(request(layer))
    found = _object(body) if status == 200 else None
    if found is None or not isinstance(found.get("features"), list):
        raise OSError(f"{layer}: status {status}, no features")
    if keep is not None:
        for feature in found["features"]:
            feature["properties"] = {k: v for k, v in (feature.get("properties") or {}).items() if k in keep}
    _store(spark, path, json.dumps(found))
    return path


def read_layer(spark: SparkSession, path: str, position: str, **names: str) -> DataFrame:
    """A layer's parts ready for a join: ``position`` numbers its features, ``names`` maps columns to properties.

    Adds ``valid``: whether the outline of a part crosses itself nowhere.
    """
    shapes = regions.read_geojson(spark, path, srid=3879).withColumn(position, F.monotonically_increasing_id())
    named = shapes.select(position, *[F.col("properties")[source].alias(column) for column, source in names.items()], "shape")
    outline = F.transform("shape", lambda rings: F.get(rings, F.lit(0)))
    marked = named.withColumn("_valid", F.transform(outline, regions.simple))
    return polygons.explode_parts(marked).withColumn("valid", F.get(F.col("_valid"), F.col("part"))).drop("_valid")


def land_use(spark: SparkSession, municipality: str, root: str, send: Send, *, profile: str = "industrial", refresh: bool = False, **waiting) -> str:
    """The path of a municipality's land use, asked for again only if the query has changed; kept with its query, time and source."""
    query = landuse.query_text(municipality, profile)
    path = f"{root.rstrip('/')}/{municipality.lower()}-{profile}.json"
    if exists(spark, path) and not refresh:
        kept = spark.read.schema("query_hash string").json(path, multiLine=True).first()
        if kept and kept["query_hash"] == landuse.query_key(query):
            return path
    found = json.loads(imagery.ask(lambda: send({"data": query}), lambda body: _object(body) is not None, **waiting))
    if not isinstance(found.get("elements", []), list):
        raise ValueError(f"{municipality}: no list of elements")
    about = {"municipality": municipality, "ref": landuse.reference(municipality), "profile": profile, "query": query, "query_hash": landuse.query_key(query), "fetched_at": datetime.now(UTC).isoformat(), "attribution": ATTRIBUTION}
    _store(spark, path, json.dumps(about | {"elements": found.get("elements", [])}))
    return path
