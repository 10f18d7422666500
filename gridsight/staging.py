"""Intermediate tables in the folder that driver and executors share.

What an iteration reads again is written, not cached: a lost executor costs only
the tasks it was running.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
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


def staged(frame: DataFrame, label: str) -> DataFrame:
    """``frame``, written as Parquet under the shared folder and read back."""
    spark = frame.sparkSession
    path = f"{shared_root(spark)}/gridsight/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI for use in tasks, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def put(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    """A whole file or none: written under another name, then moved."""
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as file:
        file.write(data)
    fs.move(part, path)
