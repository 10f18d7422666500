"""Regions and other polygon layers as rows of multipolygons on the grid.

``shape`` is ``array<polygon>`` as in ``operators.polygons``; nothing is dissolved, so
that every later step works on parts.

Defined results: null and empty geometries are left out; a file or table without any
polygon is an error; GeoJSON is in the CRS the caller names, whatever the file says,
and a GeoPackage in its own; properties are a map of text.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridsight.functions import crs
from gridsight.operators.polygons import MULTIPOLYGON
from gridsight.sources.geojson import GRID_NAME

_GEOMETRY = "struct<type: string, coordinates: string, geometries: array<struct<type: string, coordinates: string>>>"
_FILE = f"type string, coordinates string, features array<struct<geometry: {_GEOMETRY}, properties: map<string, string>>>"
_RING = "array<array<double>>"


def _points(ring: Column) -> Column:
    """A ring of positions without its closing point; null for what is no ring."""
    fine = (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1)) & F.forall(ring, lambda p: (F.size(p) >= 2) & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    return F.when(fine, F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))


def shape_of(kind: Column, coordinates: Column) -> Column:
    """The multipolygon of a GeoJSON geometry; null for other kinds and for malformed rings."""
    one, many = F.from_json(coordinates, f"array<{_RING}>"), F.from_json(coordinates, f"array<array<{_RING}>>")
    polygons = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    shape = F.transform(polygons, lambda rings: F.transform(rings, _points))
    whole = F.forall(shape, lambda rings: rings.isNotNull() & (F.size(rings) > 0) & F.forall(rings, lambda r: r.isNotNull()))
    return F.when(whole & (F.size(shape) > 0), shape)


def simple(ring: Column) -> Column:
    """Whether no two sides of a ring that are not neighbours cross; a ring that fails is to be looked at, not joined."""
    n = F.size(ring)

    def side(a: Column, b: Column, p: Column) -> Column:
        return F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))

    def crosses(i: Column, j: Column) -> Column:
        a, b, c, d = (F.get(ring, k % n) for k in (i, i + 1, j, j + 1))
        return (side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)

    places = F.sequence(F.lit(0), n - 1)
    return ~F.exists(places, lambda i: F.exists(places, lambda j: (j > i + 1) & crosses(i, j)))


def projected(shape: Column, source: int, target: int) -> Column:
    def moved(p: Column) -> Column:
        x, y = crs.reproject(p["x"], p["y"], source, target)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(shape, lambda rings: F.transform(rings, lambda ring: F.transform(ring, moved)))


def read_geojson(spark: SparkSession, path: str, *, srid: int = 4326, target: int = 3879) -> DataFrame:
    """``properties, shape`` of every polygon feature of a collection, or of a bare geometry."""
    files = spark.read.schema(_FILE).json(path, multiLine=True)
    bare = F.array(F.struct(F.struct(F.col("type"), F.col("coordinates"), F.lit(None).cast("array<struct<type: string, coordinates: string>>").alias("geometries")).alias("geometry"), F.lit(None).cast("map<string, string>").alias("properties")))
    rows = files.select(F.explode(F.coalesce("features", bare)).alias("f"))
    own = F.struct(F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("coordinates"))
    each = rows.select("f.properties", F.explode(F.coalesce("f.geometry.geometries", F.array(own))).alias("g"))
    return each.select("properties", projected(shape_of(F.col("g.type"), F.col("g.coordinates")), srid, target).alias("shape")).filter(F.col("shape").isNotNull())


def _wkb_polygons(data: bytes) -> list | None:
    """Polygons of well-known binary; None for other kinds."""
    at = 0

    def take(form: str):
        nonlocal at
        size = struct.calcsize(form)
        found = struct.unpack_from(form, data, at)
        at += size
        return found

    def one() -> list | None:
        order = "<" if take("B")[0] else ">"
        code = take(order + "I")[0]
        kind, extra = code % 1000 & 0xFF, (code // 1000) % 4
        size = 2 + (1 if extra in (1, 2) else 2 if extra == 3 else 0) + bool(code & 0x80000000) + bool(code & 0x40000000)
        if kind == 3:
            rings = []
            for _ in range(take(order + "I")[0]):
                flat = take(f"{order}{take(order + 'I')[0] * size}d")
                rings.append([{"x": flat[i], "y": flat[i + 1]} for i in range(0, len(flat) - size, size)])
            return [rings] if rings else []
        if kind == 6:
            return [p for _ in range(take(order + "I")[0]) for p in one() or []]
        return None

    return one()


def gpkg_polygons(blob: bytes | None) -> list | None:
    """Polygons of a GeoPackage geometry: its header says how long its envelope is."""
    if not blob or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    return _wkb_polygons(blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :])


class _Rows(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))


class GpkgSource(DataSource):
    """``spark.read.format("gridsight_gpkg").option("path", file).option("layer", name)``: partitions are ranges of row ids.

    The file lies where driver and executors read it; ``rows`` is the size of a range.
    """

    @classmethod
    def name(cls) -> str:
        return "gridsight_gpkg"

    def schema(self) -> str:
        return f"fid long, properties map<string, string>, srid int, shape {MULTIPOLYGON}"

    def reader(self, schema) -> DataSourceReader:
        return GpkgReader(self.options)


class GpkgReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.layer, self.rows = options["path"], options.get("layer"), int(options.get("rows", 50_000))

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def _table(self, con: sqlite3.Connection) -> tuple[str, str, int]:
        """Table, geometry column and CRS of the layer: the one asked for, or the only one."""
        found = con.execute("SELECT g.table_name, g.column_name, s.organization_coordsys_id FROM gpkg_geometry_columns g JOIN gpkg_spatial_ref_sys s USING (srs_id)").fetchall()
        named = [r for r in found if self.layer in (None, r[0])]
        if len(named) != 1:
            raise ValueError(f"{self.path}: layer {self.layer!r} of {', '.join(sorted(r[0] for r in found)) or 'none'}")
        return named[0]

    def partitions(self) -> list[InputPartition]:
        with self._open() as con:
            table = self._table(con)[0]
            low, high = con.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
        return [] if low is None else [_Rows(k, min(high + 1, k + self.rows)) for k in range(low, high + 1, self.rows)]

    def read(self, partition) -> Iterator[tuple]:
        if partition is None:
            return
        with self._open() as con:
            table, column, srid = self._table(con)
            rows = con.execute(f'SELECT rowid AS _fid, * FROM "{table}" WHERE rowid >= ? AND rowid < ?', partition.value)
            names = [c[0] for c in rows.description]
            for row in rows:
                values = dict(zip(names, row, strict=True))
                shape = gpkg_polygons(values.pop(column))
                if shape:
                    fid = values.pop("_fid")
                    yield fid, {k: None if v is None else str(v) for k, v in values.items()}, srid, shape


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None, *, target: int = 3879) -> DataFrame:
    """``properties, shape`` of a GeoPackage's polygons, in the grid it says it is in."""
    spark.dataSource.register(GpkgSource)
    options = {"path": path} | ({"layer": layer} if layer else {})
    rows = spark.read.format("gridsight_gpkg").options(**options).load()
    known = [4326, *crs.GRIDS]
    each = reduce(lambda a, b: a.when(F.col("srid") == b, projected(F.col("shape"), b, target)), known, F.when(F.lit(False), F.col("shape")))
    return rows.select("properties", each.otherwise(F.raise_error(F.concat(F.lit("unknown grid EPSG:"), F.col("srid").cast("string")))).alias("shape"))


def load(spark: SparkSession, path: str, *, srid: int = 4326, layer: str | None = None) -> DataFrame:
    """A region's polygons on the grid by the kind of file: GeoPackage, Parquet with ``shape`` on the grid, or GeoJSON in ``srid``."""
    if path.lower().endswith(".gpkg"):
        found = read_gpkg(spark, path, layer)
    elif path.rstrip("/").lower().endswith(".parquet"):
        found = spark.read.parquet(path)
    else:
        found = read_geojson(spark, path, srid=srid)
    if found.isEmpty():
        raise ValueError(f"{path}: no polygons")
    return found


def write_geojson(regions: DataFrame, path: str) -> int:
    """Multipolygons on the grid as one collection that names its CRS, streamed through the driver; returns its features. Layers at scale are written as Parquet."""
    def closed(ring: Column) -> Column:
        return F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda p: F.array(F.round(p["x"], 3), F.round(p["y"], 3)))

    coordinates = F.transform("shape", lambda rings: F.transform(rings, closed))
    properties = F.col("properties") if "properties" in regions.columns else F.struct(*[F.col(c) for c in regions.columns if c != "shape"])
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"), properties.alias("properties")))
    count = 0
    with open(path, "w", encoding="utf-8") as file:
        file.write('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "' + GRID_NAME + '"}}, "features": [')
        for row in regions.select(feature.alias("f")).toLocalIterator():
            file.write(("," if count else "") + "\n" + row["f"])
            count += 1
        file.write("\n]}\n")
    return count
