"""Commands: ``python -m gridsight.cli COMMAND ...``, each a composition of operators over tables and files.

Detections are Parquet with ``id, label, confidence``, corners and ``aoi``; labels are a
folder of ``sources.labelstore``. What is not part of this package (a model, its image
format, a service) is named as ``module:object``.
"""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import chunks, density, detect, enrich, evaluate, labels, mining, nms, package, polygons, spatial
from gridsight.sources import aoi, exports, geojson, imagery, landuse, layers, regions
from gridsight.sources.aoi import ROLES


def _named(path: str) -> object:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _say(frame: DataFrame, most: int = 1000) -> None:
    """Rows of a report, which is small by nature, as text."""
    for row in frame.limit(most).collect():
        print("  ".join(f"{k} {v}" for k, v in row.asDict().items()))


def _areas(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    found = aoi.load(spark, a.areas, srid=a.srid, name=a.name)
    if a.role is None:
        return found
    if a.role not in ROLES:
        raise ValueError(f"role {a.role!r} is not one of {', '.join(ROLES)}")
    found = found.filter(F.col("role") == a.role)
    if found.isEmpty():
        raise ValueError(f"no area has the role {a.role}")
    return found


def _boxes(spark: SparkSession, path: str) -> DataFrame:
    cx, cy = G.centre()
    return spark.read.parquet(path).withColumns({"cx": cx, "cy": cy, "length_m": G.length_m()})


def is_negative(role) -> object:
    """Whether an area of a role is to hold no vehicles."""
    return role != ROLES[0]


def aois(spark: SparkSession, a: argparse.Namespace) -> int:
    """Areas with their splits and roles, and those that overlap, largest first."""
    found = _areas(spark, a)
    _say(found.withColumn("negative", is_negative(F.col("role"))).select("name", "role", "split", "negative", *[F.round(c, 1).alias(c) for c in ("min_e", "min_n", "max_e", "max_n")]))
    _say(found.groupBy("split", "role").agg(F.count(F.lit(1)).alias("areas")).orderBy("split", "role"))
    checked = found.filter(F.col("split") == "validation").select("role").distinct()
    for row in found.select("role").distinct().join(checked, "role", "left_anti").orderBy("role").collect():
        print(f"no validation area has the role {row['role']}")
    _say(polygons.overlaps(found, "name"))
    return 0


def fetch(spark: SparkSession, a: argparse.Namespace) -> int:
    """Tiles over areas into the cache; 1 if any could not be had."""
    wanted = grid.tiles(_areas(spark, a), a.zoom).select(F.lit(a.zoom).alias("zoom"), F.col("tile_col").alias("col"), F.col("tile_row").alias("row")).distinct()
    told = imagery.fetch_tiles(wanted, a.cache, imagery.layer_of(a.year), _named(a.send)).agg(F.count(F.lit(1)).alias("tiles"), F.count_if("cached").alias("cached"), F.count("error").alias("failed")).first()
    print(f"{told['tiles']} tiles, {told['cached']} cached before, {told['failed']} failed")
    return int(told["failed"] > 0)


def _windows(spark: SparkSession, areas: DataFrame, a: argparse.Namespace) -> DataFrame:
    """Windows of ``areas`` (``area``, bounds) with their images from cached tiles."""
    cut = grid.windows(areas, a.zoom).select("area", "x", "y")
    root = f"{a.cache.rstrip('/')}/{imagery.layer_of(a.year)}/{a.zoom}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", "true").load(root)
    spot = F.regexp_extract_all("path", F.lit(r"/([0-9]+)/([0-9]+)[.]jpg$"), 1), F.regexp_extract("path", r"/([0-9]+)[.]jpg$", 1)
    tiles = files.select(F.get(spot[0], F.lit(0)).cast("long").alias("tile_col"), spot[1].cast("long").alias("tile_row"), F.col("content").alias("body"))
    codec = _named(a.codec)
    return detect.stitch(cut, tiles, codec.decode, codec.encode)


def _swept(spark: SparkSession, areas: DataFrame, a: argparse.Namespace, **options) -> DataFrame:
    found = detect.sweep(_windows(spark, areas, a), _named(a.detector), a.zoom, min_length_m=a.min_length, **options)
    return found.filter(F.col("confidence") >= a.confidence)


def bootstrap(spark: SparkSession, a: argparse.Namespace) -> int:
    """First candidates of areas from a model of vehicles at large."""
    names = spark.createDataFrame([(list(_named(a.detector)().classes),)], "n array<string>").select(detect.finds_vehicles(F.col("n"))).first()[0]
    if not names:
        raise ValueError(f"the model finds none of {', '.join(detect.VEHICLES)}")
    found = _swept(spark, _areas(spark, a).withColumnRenamed("name", "area"), a, keep=list(detect.VEHICLES))
    found.withColumn("aoi", F.col("area")).drop("id").write.parquet(a.out)
    _say(spark.read.parquet(a.out).groupBy("aoi", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("aoi", "label"))
    return 0


def detect_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Detections of areas, or of a region cell by cell with a log to go on from."""
    if a.region is None:
        found = _swept(spark, _areas(spark, a).withColumnRenamed("name", "area"), a).withColumn("aoi", F.col("area")).drop("id")
        found.write.parquet(a.out)
    else:
        parts = polygons.explode_parts(regions.load(spark, a.region, srid=a.srid).select("shape"))
        size = float(a.cell_size)
        named = polygons.cells_over(parts, size).select(F.col("name").alias("cell"), *[(F.col(c) * size + add).alias(n) for n, c, add in (("min_e", "cell_col", 0), ("min_n", "cell_row", 0), ("max_e", "cell_col", size), ("max_n", "cell_row", size))])
        cells = spatial.stored(named, "cells")

        def work(todo: DataFrame) -> tuple[DataFrame, DataFrame]:
            found = _swept(spark, todo.withColumnRenamed("cell", "area"), a)
            return found.withColumn("id", F.xxhash64("id")).withColumnRenamed("area", "cell"), todo.select("cell", F.lit(None).cast("string").alias("error")).limit(0)

        params = {"year": a.year, "zoom": a.zoom, "confidence": a.confidence, "cell_size": a.cell_size, "detector": a.detector, "min_length": a.min_length}
        if not a.merge_only:
            chunks.run(cells, work, a.checkpoint, params, parts=parts, retry_failed=a.retry_failed)
        chunks.merged(spark, a.checkpoint).withColumn("aoi", F.col("cell")).write.parquet(a.out)
        _say(chunks.account(cells, a.checkpoint))
    _say(spark.read.parquet(a.out).groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label"))
    return 0


def enrich_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Detections with the attributes of four layers (GeoJSON on the grid), as Parquet."""
    read = layers.read_layer
    districts, parts = read(spark, a.districts, "part_id", district=a.district_name), read(spark, a.parts, "part_id", part_name=a.part_name)
    streets = read(spark, a.streets, "street_id", kadun_nimi=a.street_name, kayttotarkoitus=a.street_type)
    boxes = _boxes(spark, a.input).withColumn("_key", F.monotonically_increasing_id())
    kept = spatial.stored(boxes, "boxes")
    sound = [x.filter("valid") for x in (districts, streets, read(spark, a.parking, "parking_id"), parts)]
    enrich.enrich(kept, *sound, key="_key").drop("_key").write.parquet(a.out)
    _say(spark.read.parquet(a.out).groupBy("context").agg(F.count(F.lit(1)).alias("n")).orderBy("context"))
    return 0


def stage(spark: SparkSession, a: argparse.Namespace) -> int:
    """Candidates as label rows by area; areas staged before stay as they are unless forced."""
    exports.stage(spark.read.parquet(a.input), a.out, force=a.force)
    _say(spark.read.parquet(a.out).groupBy("aoi").agg(F.count(F.lit(1)).alias("n")).orderBy("aoi"))
    return 0


def progress(spark: SparkSession, a: argparse.Namespace) -> int:
    """How far review is by area, all classes, and the first defects."""
    held = spark.read.parquet(a.labels)
    _say(labels.progress(held).orderBy("aoi"))
    _say(labels.summary(held).orderBy("kind", "name"))
    lines, more = _defects(held)
    print(*lines, *([f"and {more} more"] if more else []), sep="\n")
    return int(bool(lines))


def _defects(held: DataFrame) -> tuple[list[str], int]:
    corner = [F.col(c) for c in G.CORNERS]
    ring = F.array(*[F.struct(corner[2 * k].alias("x"), corner[2 * k + 1].alias("y")) for k in (0, 1, 2, 3, 0)])
    return labels.shown_problems(labels.problems(held.withColumn("ring", ring), "det_id"), "det_id")


def export(spark: SparkSession, a: argparse.Namespace) -> int:
    """Label text of the windows over areas, with its description; nothing while labels have defects."""
    held = spark.read.parquet(a.labels)
    lines, more = _defects(held)
    if lines:
        print(*lines, *([f"and {more} more"] if more else []), sep="\n")
        return 1
    cut = grid.windows(_areas(spark, a), a.zoom).select(F.col("name").alias("aoi"), "split", "x", "y")
    windows = spatial.stored(cut.withColumn("stem", F.concat_ws("_", "aoi", F.col("x").cast("string"), F.col("y").cast("string"))), "windows")
    found = labels.yolo_boxes(windows.select("aoi", "x", "y"), labels.verified(held), size_px=grid.WINDOW_PX, metres_px=grid.resolution(a.zoom), origin_e=grid.ORIGIN_E, origin_n=grid.ORIGIN_N)
    exports.write_yolo(found, windows, f"{a.out}/labels")
    print(exports.dataset_yaml(a.out))
    _say(labels.export_totals(windows, found).orderBy("split"))
    return 0


def eval_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Whether a model passes: its curve (Parquet ``i, px, p, r``), its detections and the labels of the areas."""
    point = spatial.stored(evaluate.operating_point(spark.read.parquet(a.curve), min_recall=a.min_recall), "point")
    chosen = point.first()
    held, found = spark.read.parquet(a.labels), _boxes(spark, a.input).filter(F.col("confidence") >= (chosen["px"] if chosen else 1.0))
    truck = F.col("class") == "truck"
    truth = labels.verified(held).filter(truck).groupBy("aoi").agg(F.count(F.lit(1)).alias("n"))
    counts = evaluate.area_counts(_areas(spark, a).select(F.col("name").alias("aoi")), truth, found.filter(F.col("label") == "truck").groupBy("aoi").agg(F.count(F.lit(1)).alias("n")))
    told = spatial.stored(evaluate.gates(point, counts, min_recall=a.min_recall), "gates")
    _say(told.orderBy("gate"))
    print(f"unexplained {evaluate.unexplained(found, held.drop('id').withColumnRenamed('det_id', 'id')).count()}")
    passed = evaluate.verdict(told).first()["passed"]
    print("PASS" if passed else "FAIL")
    return int(not passed)


def mine(spark: SparkSession, a: argparse.Namespace) -> int:
    """Cells to label next, from land use and detections, as a collection to copy from and as GeoJSON."""
    if a.count < 1 or not 0 < a.operating < 1:
        raise ValueError("count must be positive and the operating confidence between 0 and 1")
    used = landuse.polygons(spark, a.land_use).select(F.array(F.array(F.slice("ring", 1, F.size("ring") - 1))).alias("shape"))
    parts = polygons.explode_parts(used.select(regions.projected(F.col("shape"), 4326, 3879).alias("shape")))
    covered = polygons.coverage(parts, mining.CELL_M).filter(F.col("coverage") >= mining.MIN_COVERAGE)
    known = aoi.load(spark, a.areas, srid=a.srid).select(*[F.col(c).alias(f"a_{c}") for c in ("min_e", "min_n", "max_e", "max_n")])
    free = spatial.stored(mining.exclude_near(covered, known), "free")
    size = mining.CELL_M
    name = grid.cell_name(F.col("cell_col"), F.col("cell_row"))
    cells = free.select(name.alias("name"), F.col("cell_col").alias("col"), F.col("cell_row").alias("row"), "coverage", ((F.col("cell_col") + 0.5) * size).alias("e"), ((F.col("cell_row") + 0.5) * size).alias("n_"))
    if a.pool:
        cells = cells.join(F.broadcast(mining.dispersed(cells, a.pool, seed=a.seed).select("name")), "name", "left_semi")
    col, row = grid.cell_of(F.col("cx"), F.col("cy"), size)
    boxes = _boxes(spark, a.input).filter(F.col("confidence") >= max(0.05, a.operating / 2)).withColumn("name", grid.cell_name(col, row))
    graded = spatial.stored(mining.graded(mining.signals(cells, boxes, "name", operating=a.operating)), "graded")
    picks = mining.proposals(graded, a.count).join(graded.withColumn("notes", mining.notes()).drop("stratum"), "name")
    low_e, low_n = F.col("col") * size, F.col("row") * size
    bbox = F.array(*[c.cast("double") for c in (low_e, low_n, low_e + size, low_n + size)])
    chosen = spatial.stored(picks.withColumn("bbox", bbox), "proposals")
    with open(f"{a.out}.yaml", "w", encoding="utf-8") as file:
        file.write(exports.proposal_yaml(chosen, "EPSG:3879"))
    geojson.write_proposals(chosen, f"{a.out}.geojson", operating_confidence=a.operating)
    _say(chosen.select("pick", "name", "stratum", "notes").orderBy("pick"))
    return 0


def package_(spark: SparkSession, a: argparse.Namespace) -> int:
    """Enriched layers of several years as one table."""
    years = {int(y): spark.read.parquet(p) for y, _, p in (x.partition("=") for x in a.years)}
    for year, n in package.pack(years, a.out, force=a.force).items():
        print(f"{package.layer_name(year, a.zoom)}  {n}")
    return 0


def analyse(spark: SparkSession, a: argparse.Namespace) -> int:
    """Grids and points of trucks by year, over a region if there is one."""
    cells = None if a.region is None else polygons.cells_over(polygons.explode_parts(regions.load(spark, a.region, srid=a.srid).select("shape")), a.cell_size)
    _say(density.write_years(_boxes(spark, a.input), a.out, size=a.cell_size, cells=cells, force=a.force, least=a.confidence).orderBy("layer", "year"))
    return 0


def region(spark: SparkSession, a: argparse.Namespace) -> int:
    """Parts of districts that roads meet, as a region."""
    shapes = regions.read_geojson(spark, a.districts, srid=3879)
    if a.land_type is not None:
        shapes = shapes.filter(F.col("properties")["tyyppi"] == a.land_type)
    parts = spatial.stored(polygons.explode_parts(shapes.withColumn("id", F.monotonically_increasing_id()).drop("properties")).withColumn("key", F.struct("id", "part")), "parts")
    lines = spark.read.schema("features array<struct<geometry: struct<type: string, coordinates: array<array<double>>>>>").json(a.roads, multiLine=True).select(F.explode("features.geometry").alias("g")).filter("g.type = 'LineString' AND size(g.coordinates) > 1")
    path = F.transform("g.coordinates", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    edges = F.slice(G.edges_of(path), F.lit(1), F.size(path) - 1)
    kept = polygons.with_roads(parts, lines.select(F.monotonically_increasing_id().alias("road_id"), edges.alias("line")), "key", min_roads=a.min_roads, min_area_m2=a.min_area)
    outline = spatial.stored(kept.select("id", "part", "area_m2", "roads", "edges"), "region")
    outline.write.parquet(a.out)
    _say(polygons.kept_share(outline, parts))
    return 0


COMMANDS: dict[str, Callable[[SparkSession, argparse.Namespace], int]] = {
    "aois": aois, "fetch": fetch, "bootstrap": bootstrap, "detect": detect_, "enrich": enrich_, "stage": stage, "progress": progress, "export": export,
    "eval": eval_, "mine": mine, "package": package_, "analyse": analyse, "region": region,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridsight", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *groups: str) -> argparse.ArgumentParser:
        made = sub.add_parser(name, help=COMMANDS[name].__doc__)
        add = made.add_argument
        if "areas" in groups:
            add("areas", help="YAML collection, GeoJSON file or bounds")
            add("--name")
            add("--role")
        if "srid" in groups or "areas" in groups:
            add("--srid", type=int, default=4326)
        if "input" in groups:
            add("--input", required=True, help="Parquet of detections")
        if "out" in groups:
            add("--out", required=True)
        if "tiles" in groups:
            add("--cache", required=True)
            add("--year", type=int, default=max(imagery.LAYERS))
        if "tiles" in groups or "zoom" in groups:
            add("--zoom", type=int, default=16)
        if "model" in groups:
            add("--detector", required=True, help="module:factory of a detector")
            add("--codec", required=True, help="module:object that decodes tiles and encodes windows")
            add("--confidence", type=float, default=0.25)
            add("--min-length", type=float, default=detect.MIN_LENGTH_M)
        if "labels" in groups:
            add("--labels", required=True)
        if "force" in groups:
            add("--force", action="store_true")
        return made

    command("aois", "areas")
    command("fetch", "areas", "tiles").add_argument("--send", required=True, help="module:function that gets a tile")
    command("bootstrap", "areas", "tiles", "model", "out")
    sweep = command("detect", "tiles", "model", "out", "srid")
    sweep.add_argument("areas", nargs="?")
    for option in ("--name", "--role", "--region", "--checkpoint"):
        sweep.add_argument(option)
    sweep.add_argument("--cell-size", type=float, default=1000.0)
    sweep.add_argument("--retry-failed", action="store_true")
    sweep.add_argument("--merge-only", action="store_true")
    layer = command("enrich", "input", "out")
    for option in ("--districts", "--streets", "--parking", "--parts"):
        layer.add_argument(option, required=True)
    for option, default in (("--district-name", "nimi_fi"), ("--street-name", "kadun_nimi"), ("--street-type", "kayttotarkoitus"), ("--part-name", "alatyyppi")):
        layer.add_argument(option, default=default)
    command("stage", "input", "out", "force")
    command("progress", "labels")
    command("export", "areas", "labels", "out", "zoom")
    judge = command("eval", "areas", "labels", "input")
    judge.add_argument("--curve", required=True)
    judge.add_argument("--min-recall", type=float, default=evaluate.MIN_RECALL)
    dig = command("mine", "areas", "input", "out")
    dig.add_argument("--land-use", required=True)
    dig.add_argument("--count", type=int, default=12)
    dig.add_argument("--operating", type=float, required=True)
    dig.add_argument("--pool", type=int, default=0)
    dig.add_argument("--seed", type=int, default=0)
    command("package", "out", "force", "zoom").add_argument("years", nargs="+", help="YEAR=FOLDER")
    grids = command("analyse", "input", "out", "force", "srid")
    grids.add_argument("--region")
    grids.add_argument("--cell-size", type=float, default=density.CELL_M)
    grids.add_argument("--confidence", type=float, default=density.CENSUS_CONFIDENCE)
    build = command("region", "out")
    for option in ("--districts", "--roads"):
        build.add_argument(option, required=True)
    build.add_argument("--land-type")
    build.add_argument("--min-roads", type=int, default=1)
    build.add_argument("--min-area", type=float, default=0.0)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    if a.command == "detect" and (a.areas is None) == (a.region is None):
        raise ValueError("detect takes areas or a region")
    if a.command == "detect" and a.region is not None and a.checkpoint is None:
        raise ValueError("a region needs a checkpoint folder")
    return COMMANDS[a.command](spark or SparkSession.builder.appName("gridsight").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
