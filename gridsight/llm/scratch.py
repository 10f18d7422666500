"""Tables written to the folder that driver and executors share.

Intermediate results that are read more than once go here instead of a cache:
a lost executor then costs the tasks it was running and nothing else.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master (tests) and an error on a cluster."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridsight-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/gridsight/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system API, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` as Parquet to the shared folder and return the stored table."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Drop every table this application wrote; call it once results have been consumed."""
    remove(spark, f"{shared_root(spark)}/gridsight/{spark.sparkContext.applicationId}")
