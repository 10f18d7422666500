"""The work log as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "type string, seq long, cell string, status string, detections long, windows_skipped long, seconds double, error string, params map<string, string>, _bad string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Whole records; blank and cut-off lines are skipped."""
    lines = spark.read.schema(SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return lines.filter(F.col("_bad").isNull()).drop("_bad").filter(F.col("type").isNotNull() | F.col("cell").isNotNull())


def header(log: DataFrame) -> DataFrame:
    """Parameters of the last run."""
    return log.filter(F.col("type") == "run").groupBy().agg(F.max_by("params", "seq").alias("params"))


def append(records: DataFrame, path: str) -> None:
    records.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def run_key(params: dict[str, object]) -> dict[str, str]:
    """Parameters as sorted text; equal keys may resume one another."""
    return {k: str(params[k]) for k in sorted(params)}
