"""Sweeping a region cell by cell, so that a run that ends early goes on where it was.

The work log says which cells are running, done or failed; detections lie in one table
whose rows carry the attempt that made them, and only the attempts that the log calls
done count. A task that is repeated, or a run that is killed while it writes, leaves
rows of attempts that no one reads.

Defined results: cells that fail are logged with their error and end nothing; cells
that were running are done again; a log of other parameters is refused; a run without
cells to do only merges; cells without detections are done with none.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.operators import manifest, nms, spatial
from gridsight.sources import manifest as log
from gridsight.staging import exists

RUNNING, DONE, FAILED = "running", "done", "failed"
DETECTIONS = "cell string, id long, label string, confidence double, " + ", ".join(f"{c} double" for c in G.CORNERS)


def _log(spark: SparkSession, root: str) -> DataFrame:
    return log.read(spark, f"{root}/log") if exists(spark, f"{root}/log") else spark.createDataFrame([], log.SCHEMA).drop("_bad")


def _record(rows: DataFrame, root: str, status: str) -> None:
    stamped = rows.select(F.lit("cell").alias("type"), (F.lit(time.time_ns())).alias("seq"), "cell", F.lit(status).alias("status"), *[c for c in rows.columns if c != "cell"])
    log.append(stamped, f"{root}/log")


def begin(spark: SparkSession, root: str, params: dict[str, object]) -> None:
    """Start a log, or go on with one of the same parameters."""
    key, header = log.run_key(params), log.header(_log(spark, root)).first()
    kept = header["params"] if header else None
    if kept is None:
        log.append(spark.createDataFrame([("run", time.time_ns(), key)], "type string, seq long, params map<string, string>"), f"{root}/log")
    elif kept != key:
        raise ValueError(f"{root} was begun with other settings: {', '.join(sorted(k for k in {*key, *kept} if key.get(k) != kept.get(k)))}")


def clipped(boxes: DataFrame, cells: DataFrame, parts: DataFrame, key: str = "id") -> DataFrame:
    """``boxes`` (with ``cell``) whose centre lies in their cell's envelope and strictly inside some part of the region."""
    cx, cy = G.centre()
    placed = boxes.withColumns({"cx": cx, "cy": cy})
    bounds = cells.select(F.col("cell").alias("_cell"), "min_e", "min_n", "max_e", "max_n")
    own = placed.join(bounds, F.col("cell") == F.col("_cell")).filter(G.inside_closed(F.col("cx"), F.col("cy"), *[F.col(c) for c in ("min_e", "min_n", "max_e", "max_n")]))
    named = own.withColumn("_key", F.struct("cell", key))
    return named.join(spatial.held_by_any(named, parts, "_key"), "_key", "left_semi").select(*boxes.columns)


def run(cells: DataFrame, work: Callable[[DataFrame], tuple[DataFrame, DataFrame]], root: str, params: dict[str, object], *, parts: DataFrame | None = None, retry_failed: bool = False) -> int:
    """Sweep the cells (``cell``, bounds) that the log does not call done (or failed); returns how many were tried.

    ``work`` gives detections (``DETECTIONS``) and ``cell, error`` of cells that failed. All cells go as
    one job, so tasks are bounded by the cluster; each cell's rows are clipped to it and to ``parts``.
    """
    spark = cells.sparkSession
    begin(spark, root, params)
    todo = spatial.stored(manifest.to_do(cells, manifest.latest(_log(spark, root).filter("cell IS NOT NULL")), retry_failed=retry_failed), "todo")
    tried = todo.count()
    if not tried:
        return 0
    _record(todo.select("cell"), root, RUNNING)
    attempt, since = uuid.uuid4().hex, time.time()
    found, failed = work(todo)
    failed = spatial.stored(failed.select("cell", "error"), "failed")
    kept = found.join(failed, "cell", "left_anti")
    kept = kept if parts is None else clipped(kept, todo, parts)
    kept.select(F.lit(attempt).alias("attempt"), *[c.split(" ")[0] for c in DETECTIONS.split(", ")]).write.mode("append").parquet(f"{root}/detections")
    counts = spark.read.parquet(f"{root}/detections").filter(F.col("attempt") == attempt).groupBy("cell").agg(F.count(F.lit(1)).alias("detections"))
    done = todo.select("cell").join(failed, "cell", "left_anti").join(counts, "cell", "left").fillna(0, ["detections"])
    _record(done.select("cell", "detections", F.lit(round(time.time() - since, 1)).alias("seconds"), F.create_map(F.lit("attempt"), F.lit(attempt)).alias("params")), root, DONE)
    _record(failed, root, FAILED)
    return tried


def finished(spark: SparkSession, root: str) -> DataFrame:
    """Detections of cells that are done, each by the attempt that did it."""
    records = _log(spark, root).filter("cell IS NOT NULL")
    last = records.groupBy("cell").agg(F.max_by(F.struct("status", F.col("params")["attempt"].alias("attempt")), "seq").alias("l"))
    done = last.filter(F.col("l.status") == DONE).select("cell", "l.attempt")
    if not exists(spark, f"{root}/detections"):
        return spark.createDataFrame([], DETECTIONS)
    return spark.read.parquet(f"{root}/detections").join(done, ["cell", "attempt"], "left_semi").drop("attempt")


def merged(spark: SparkSession, root: str) -> DataFrame:
    """``finished`` detections without seam duplicates: one suppression over all cells."""
    named = finished(spark, root).withColumn("id", F.struct("cell", "id"))
    return nms.merge(named).withColumn("id", F.col("id.id"))


def account(cells: DataFrame, root: str) -> DataFrame:
    """One row ``cells, done, failed, pending, found, kept, duplicates`` of a run so far."""
    spark = cells.sparkSession
    state = manifest.latest(_log(spark, root).filter("cell IS NOT NULL"))
    told = cells.select("cell").join(state, "cell", "left").agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("status") == DONE).alias("done"), F.count_if(F.col("status") == FAILED).alias("failed"))
    found, kept = finished(spark, root).count(), merged(spark, root).count()
    sizes = {"found": found, "kept": kept, "duplicates": found - kept}
    return told.select("*", (F.col("cells") - F.col("done")).alias("pending"), *[F.lit(n).cast("long").alias(name) for name, n in sizes.items()])
