"""The work log and edits as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "seq long, cell string, status string, ts timestamp"


def log_stream(spark: SparkSession, folder: str, *, files: int = 100) -> DataFrame:
    """Records of the log as files of JSON lines arrive; ``files`` bounds a batch."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).json(folder).filter(F.col("cell").isNotNull())


def latest(log: DataFrame) -> DataFrame:
    """The last status of each cell, kept up to date."""
    return log.groupBy("cell").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def work(cells: DataFrame, done: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str) -> StreamingQuery:
    """Work on cells as they arrive; a batch replaces the partitions of its cells, so a repeated one changes nothing."""

    def batch(frame: DataFrame, _: int) -> None:
        made = done(frame.dropDuplicates(["cell"]))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cell").parquet(folder)

    return cells.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def edit_sessions(edits: DataFrame, *, gap: str = "700 milliseconds", late: str = "10 seconds") -> DataFrame:
    """Runs of edits of a box (``box``, ``ts``) with less than ``gap`` between neighbours."""
    window = F.session_window("ts", gap)
    return edits.withWatermark("ts", late).groupBy("box", window).agg(F.count(F.lit(1)).alias("edits"))


def activity(events: DataFrame, *, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Records by status in tumbling windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "status").agg(F.count(F.lit(1)).alias("n"))
