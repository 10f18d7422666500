"""Counts of vehicles by cell, and their layers by year.

Defined results: a null label or confidence is below any floor; a centre on the edge of
a cell lies in no cell; cells without a vehicle are no rows; a year without any has no
partition; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.functions import grid

CENSUS_CONFIDENCE, CELL_M = 0.77, 250.0


def counted(boxes: DataFrame, *, label: str = "truck", least: float = CENSUS_CONFIDENCE) -> DataFrame:
    """Boxes of one class over a confidence, with the floor as ``min_confidence``."""
    return boxes.filter((F.col("label") == label) & (F.col("confidence") >= least)).withColumn("min_confidence", F.lit(least))


def _off_edges(size: float) -> Column:
    return (F.col("cx") / size != F.floor(F.col("cx") / size)) & (F.col("cy") / size != F.floor(F.col("cy") / size))


def by_cell(boxes: DataFrame, *keys: str, size: float = CELL_M, cells: DataFrame | None = None) -> DataFrame:
    """``*keys, cell_col, cell_row, n`` of box centres (``cx``, ``cy``); ``cells`` (``polygons.cells_over``) leaves others out."""
    col, row = grid.cell_of(F.col("cx"), F.col("cy"), size)
    found = boxes.filter(_off_edges(size)).groupBy(*keys, col.alias("cell_col"), row.alias("cell_row")).agg(F.count(F.lit(1)).alias("n"))
    return found if cells is None else found.join(cells.select("cell_col", "cell_row").distinct(), ["cell_col", "cell_row"], "left_semi").select(*keys, "cell_col", "cell_row", "n")


def write_years(boxes: DataFrame, folder: str, *, size: float = CELL_M, cells: DataFrame | None = None, force: bool = False, **floor) -> DataFrame:
    """Grids and points of boxes with a ``year`` as two tables partitioned by it; returns what was written: ``layer, year, n``."""
    mode = "overwrite" if force else "errorifexists"
    points = counted(boxes, **floor)
    by_cell(points, "year", "min_confidence", size=size, cells=cells).write.mode(mode).partitionBy("year").parquet(f"{folder}/grid")
    points.select("year", "cx", "cy", "confidence", "min_confidence").write.mode(mode).partitionBy("year").parquet(f"{folder}/points")
    read = boxes.sparkSession.read.parquet
    grids = read(f"{folder}/grid").groupBy("year").agg(F.sum("n").alias("n")).select(F.lit("grid").alias("layer"), "year", "n")
    return grids.unionByName(read(f"{folder}/points").groupBy("year").agg(F.count(F.lit(1)).alias("n")).select(F.lit("points").alias("layer"), "year", "n"))
