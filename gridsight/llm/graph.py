"""Connected components of an undirected edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def _relabel(frame: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    to = parents.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
    return frame.join(to, F.col(column) == F.col("_v"), "left").withColumn(column, F.coalesce("_p", column)).drop("_v", "_p")


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges (a, b)``; a root is its component's least vertex.

    Each round, every vertex hooks to its least neighbour, hooks are shortened
    twice, and edges between hooked groups form the next, smaller graph. Rounds
    are logarithmic in the number of vertices; each is written to the shared
    folder, which also cuts the lineage. An edge table without rows gives none.
    """
    left = scratch.table(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("p"))
        hooks = scratch.table(hooks, "hooks")
        for _ in range(2):
            hooks = _relabel(hooks, "p", hooks)
        hooks = scratch.table(hooks, "hooks")
        rounds.append(hooks)
        moved = _relabel(_relabel(left, "a", hooks), "b", hooks)
        kept = _relabel(hooks.select(F.col("p").alias("a"), F.col("p").alias("b")), "b", hooks)
        moved = moved.unionByName(kept).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = scratch.table(moved, "edges")
    if not rounds:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    labels = rounds[0]
    for hooks in rounds[1:]:
        labels = _relabel(labels, "p", hooks)
    return scratch.table(labels.select("v", F.col("p").alias("root")), "components")
