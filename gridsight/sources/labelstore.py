"""Labels of areas as an editor reads and saves them: one table, a partition for each area.

Defined results: an area without labels is an empty table; a name that cannot be part of
a path, or a collection in another CRS, is refused; saving replaces an area's partition
and no other; null classes are the empty one; an empty collection empties the area.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.sources.geojson import GRID_NAME, features_of
from gridsight.staging import exists, remove

SCHEMA = "aoi string, position long, det_id long, status string, class string, label string, confidence double, " + ", ".join(f"{c} double" for c in G.CORNERS)


def checked(aoi: str) -> str:
    if not re.fullmatch("[A-Za-z0-9_-]+", aoi or ""):
        raise ValueError(f"{aoi!r} is no name of an area")
    return aoi


def read(spark: SparkSession, folder: str, aoi: str) -> DataFrame:
    """Labels of one area: its partition alone is read."""
    checked(aoi)
    if not exists(spark, folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(folder).filter(F.col("aoi") == aoi)


def save(labels: DataFrame, folder: str, aoi: str, *, crs: str | None) -> int:
    """Replace an area's labels; returns how many there are. ``crs`` is what the collection says it is in."""
    if crs != GRID_NAME:
        raise ValueError(f"labels in {crs!r}, not {GRID_NAME}")
    checked(aoi)
    kinds = dict(part.rsplit(" ", 1) for part in SCHEMA.split(", "))
    row = [(F.col(c).cast(k) if c in labels.columns else F.lit(None).cast(k)).alias(c) for c, k in kinds.items() if c != "aoi"]
    spark = labels.sparkSession
    rows = labels.select(F.lit(aoi).alias("aoi"), *row).withColumn("class", F.coalesce("class", F.lit("")))
    count = rows.count()
    if count:
        rows.repartition("aoi").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("aoi").parquet(folder)
    elif exists(spark, folder):
        remove(spark, f"{folder}/aoi={aoi}")
    return count


def whole_numbers(json: Column) -> Column:
    """JSON text with whole numbers written without a fraction."""
    return F.regexp_replace(json, r"(?<=[\[,:])(-?[0-9]+)[.]0+(?=[,\]}])", "$1")


def collection(labels: DataFrame) -> Column:
    """``(aoi, feature)`` rows of labels in the order of their positions, new ones last, as text for an editor's file."""
    ordered = features_of(labels.orderBy(F.col("position").asc_nulls_last(), "det_id"))
    return ordered.withColumn("feature", whole_numbers(F.col("feature")))
