"""Packaging enriched layers by year.

Defined results: a layer without rows or without a column of the enrichment is refused;
columns that only some years have are null in the others; nulls and repeated rows are
kept as they are; a folder that is there is replaced only if that is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns enrichment adds.
ENRICHED = ("district", "postal_code", "street", "street_type", "context", "street_part")


def layer_name(year: int, zoom: int) -> str:
    """What a year's layer is called (fixed format)."""
    return f"helsinki_{year}_z{zoom}"


def read_year(spark: SparkSession, folder: str, year: int) -> DataFrame:
    """One year of a packaged layer: its partition alone is read; a year that is not there is an error."""
    found = spark.read.parquet(folder).filter(F.col("year") == year)
    if found.isEmpty():
        raise ValueError(f"{folder}: no year {year}")
    return found


def check(frame: DataFrame, where: str) -> DataFrame:
    """``frame``, if it has rows and every enriched column."""
    missing = sorted(set(ENRICHED) - set(frame.columns))
    if missing:
        raise ValueError(f"{where}: no columns {', '.join(missing)}")
    if frame.isEmpty():
        raise ValueError(f"{where}: no rows")
    return frame


def pack(years: dict[int, DataFrame], folder: str, *, force: bool = False) -> dict[int, int]:
    """Layers as one table partitioned by year; counts are read back and compared."""
    checked = [check(frame, str(year)).withColumn("year", F.lit(year)) for year, frame in sorted(years.items())]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checked)
    whole.write.mode("overwrite" if force else "errorifexists").partitionBy("year").parquet(folder)

    def counted(frame: DataFrame) -> dict[int, int]:
        return {r["year"]: r["n"] for r in frame.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}

    written = counted(whole.sparkSession.read.parquet(folder))
    if written != counted(whole):
        raise AssertionError(f"{folder} does not hold what was written")
    return written
