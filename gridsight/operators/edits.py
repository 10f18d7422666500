"""What an editor did, as a table of events, and the boxes that come of it.

``events``: ``session, seq, at_ms, kind, box`` and what the kind brings: ``draw`` a ring
and a class, ``move`` a ring, ``classify`` a class, ``reject`` and ``delete`` nothing,
``undo`` no box either. A drawn box is added and stays so when it is classified; any
other is confirmed by a class; rejecting takes the class away, and a class given after
that confirms.

Defined results: events of one session count in the order of ``seq``, ties by box and
kind; unknown kinds change nothing; a null box has no state; undo without anything left
does nothing; an empty table gives empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Edits of a box this close are one step, so many steps can be undone, and a save waits for so long a rest.
STEP_MS, DEPTH, REST_MS = 700, 100, 800
EDITS = ("move", "classify", "reject")


def undone(events: DataFrame, *, depth: int = DEPTH, step_ms: int = STEP_MS) -> DataFrame:
    """``session, seq`` of events that an undo took back.

    A step is what one undo takes: a drawn or deleted box, or edits of one box within
    ``step_ms`` of each other. Only the last ``depth`` steps are kept, so that is all a
    task holds of a session, however long; a session is read in order by one task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session, steps = None, []
        for frame in frames:
            out: list[tuple] = []
            for r in frame.itertuples(index=False):
                if r.session != session:
                    session, steps = r.session, []
                if r.kind == "undo":
                    out += [(session, seq) for seq in steps.pop()["seqs"]] if steps else []
                elif r.kind in EDITS and steps and steps[-1]["edit"] and steps[-1]["box"] == r.box and r.at_ms - steps[-1]["at"] < step_ms:
                    steps[-1]["seqs"].append(r.seq)
                    steps[-1]["at"] = r.at_ms
                elif r.kind in (*EDITS, "draw", "delete"):
                    steps = [*steps[-depth + 1 :], {"box": r.box, "at": r.at_ms, "edit": r.kind in EDITS, "seqs": [r.seq]}] if depth > 1 else [{"box": r.box, "at": r.at_ms, "edit": r.kind in EDITS, "seqs": [r.seq]}]
            yield pd.DataFrame(out, columns=["session", "seq"])

    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    rows = events.select("session", "seq", "at_ms", "kind", F.col("box").cast("string").alias("box")).filter(F.col("session").isNotNull() & F.col("seq").isNotNull())
    ordered = rows.repartition("session").sortWithinPartitions("session", "seq", "box", "kind")
    return ordered.mapInPandas(run, f"session {kinds['session']}, seq {kinds['seq']}")


def effective(events: DataFrame, **options) -> DataFrame:
    """Events that still hold: neither undone nor an undo."""
    gone = undone(events, **options)
    return events.filter(F.col("kind") != "undo").join(gone, ["session", "seq"], "left_anti")


def boxes(events: DataFrame) -> DataFrame:
    """``session, box, status, class, ring`` after ``events`` (``effective``); deleted boxes are left out.

    One grouping without a sort: each field is that of the last event that sets it.
    """
    kind, seq = F.col("kind"), F.col("seq")

    def last(value: Column | str, *kinds: str) -> Column:
        return F.max_by(value, F.when(kind.isin(*kinds), seq))

    def when(*kinds: str) -> Column:
        return F.max(F.when(kind.isin(*kinds), seq))

    told = events.filter(F.col("box").isNotNull()).groupBy("session", "box").agg(
        last("kind", "draw", "classify", "reject").alias("_by"), last("class", "draw", "classify").alias("_class"), last("ring", "draw", "move").alias("ring"), when("delete").alias("_gone"), when("draw").alias("_drawn"), when("reject").alias("_rejected")
    )
    still_added = F.col("_drawn").isNotNull() & (F.col("_rejected").isNull() | (F.col("_rejected") < F.col("_drawn")))
    status = F.when(F.col("_by") == "reject", "rejected").when(still_added, "added").when(F.col("_by") == "classify", "confirmed").otherwise("candidate")
    name = F.when(F.col("_by") == "reject", "").otherwise(F.coalesce("_class", F.lit("")))
    return told.filter(F.col("_gone").isNull() | (F.col("_gone") < F.col("_drawn"))).select("session", "box", status.alias("status"), name.alias("class"), "ring")


def saves(edits: DataFrame, *, rest_ms: int = REST_MS) -> DataFrame:
    """``session, saved_ms, edits``: an editor saves once no edit has come for ``rest_ms``; edits since the last save go together."""
    order = Window.partitionBy("session").orderBy("at_ms", "seq")
    rested = F.coalesce(F.lead("at_ms").over(order) - F.col("at_ms") >= rest_ms, F.lit(True))
    marked = edits.withColumn("_rested", rested).withColumn("_run", F.coalesce(F.sum(F.col("_rested").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return marked.groupBy("session", "_run").agg((F.max("at_ms") + rest_ms).alias("saved_ms"), F.count(F.lit(1)).alias("edits")).drop("_run")


def file_order(labels: DataFrame, position: str = "position", key: str = "det_id") -> DataFrame:
    """Labels in the order a file keeps: as they were read, new ones (null position) after them by key."""
    return labels.orderBy(F.col(position).asc_nulls_last(), key)
