"""Files that people and trainers read: dataset and proposal descriptions, label text, staged labels, metrics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.operators import labels
from gridsight.staging import exists, filesystem, put


def dataset_yaml(root: str) -> str:
    """A trainer's dataset description with the fixed order of classes."""
    return yaml.safe_dump({"path": root, "train": "images/train", "val": "images/val", "names": dict(enumerate(labels.CLASSES))}, sort_keys=False)


def proposal_yaml(proposals: DataFrame, crs_name: str = "EPSG:3067") -> str:
    """Proposed areas (``pick, name, bbox, notes``) as a collection to copy from; there are a few at most."""
    rows = proposals.orderBy("pick").collect()
    entries = [{"name": r["name"], "bbox": [round(v, 3) for v in r["bbox"]], "role": "positive", "split": "train", "notes": r["notes"]} for r in rows]
    return yaml.safe_dump({"crs": crs_name, "aois": entries}, sort_keys=False, allow_unicode=True)


def write_yolo(held: DataFrame, windows: DataFrame, folder: str) -> int:
    """A label file ``split/stem.txt`` for every window, also those without boxes, written by the tasks; returns how many.

    ``windows`` has ``split, stem, aoi, x, y``; ``held`` is the result of ``labels.yolo_boxes``. A
    repeated task writes the same files again.
    """
    lines = held.select("aoi", "x", "y", "det_id", labels.yolo_line().alias("line")).groupBy("aoi", "x", "y").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("det_id", "line"))), lambda r: r["line"]), "\n").alias("value"))
    texts = windows.join(lines, ["aoi", "x", "y"], "left").select("split", "stem", F.coalesce("value", F.lit("")).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for split, stem, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                put(fs, f"{base}/{split}/{stem}.txt", (value + "\n" * bool(value)).encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    return texts.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def stage(candidates: DataFrame, folder: str, *, force: bool = False) -> None:
    """Candidates as label rows, a partition for each area; areas staged before are left alone unless forced."""
    rows, spark = labels.stage(candidates), candidates.sparkSession
    if not force and exists(spark, folder):
        rows = rows.join(spark.read.parquet(folder).select(F.col("aoi").cast("string")).distinct(), "aoi", "left_anti")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("aoi").parquet(folder)


def log_run(spark: SparkSession, folder: str, run: str, params: dict[str, object], metrics: dict[str, float]) -> None:
    """Parameters and measures of a run as rows ``run, kind, key, value``."""
    rows = [(run, "param", k, str(v)) for k, v in params.items()] + [(run, "metric", k, repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run string, kind string, key string, value string").write.mode("append").parquet(folder)
