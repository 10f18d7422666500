"""The append-only work log and what is left to do.

Defined results: of records with one number any may be the last, so numbers are to be
unique within a cell; a cell whose last status is null is to be done; repeated
records change nothing; an empty log leaves every cell to do; other columns are not kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame) -> DataFrame:
    """The last status of each cell by log order."""
    return log.groupBy("cell").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def to_do(cells: DataFrame, state: DataFrame, *, retry_failed: bool = False) -> DataFrame:
    """Cells that are neither done nor, unless they are retried, failed; running ones are done again."""
    over = ["done"] if retry_failed else ["done", "failed"]
    return cells.join(state.filter(F.col("status").isin(*over)).select("cell"), "cell", "left_anti")
