"""Human-reviewed labels: summaries, validation and measures of review.

Defined results: what a null status or class counts as is said at each function; null
coordinates lie in no window and outside no area; rows in one place are ordered by
their ids; repeated rows are counted each; empty tables give empty results; other
columns are kept where rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsight.functions import geometry as G

#: Classes in the order of their indices, statuses, and those that count as truth.
CLASSES = ("truck", "bus", "van", "car")
STATUSES = ("candidate", "confirmed", "rejected", "added")
VERIFIED = ("confirmed", "added")
#: Metres that opposite sides and diagonals of a rectangle may differ by, exclusive.
RECTANGLE_TOLERANCE = 0.5


def verified(labels: DataFrame) -> DataFrame:
    """Confirmed or added labels of a known class."""
    return labels.filter(F.col("status").isin(*VERIFIED) & F.col("class").isin(*CLASSES))


def class_index(label: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CLASSES)), label).cast("long") - 1


def truth_counts(labels: DataFrame, *keys: str) -> DataFrame:
    """Verified labels by class; a missing class counts as the empty one."""
    kept = labels.filter(F.col("status").isin(*VERIFIED)).withColumn("class", F.coalesce("class", F.lit("")))
    return kept.groupBy(*keys, "class").agg(F.count(F.lit(1)).alias("n"))


def summary(labels: DataFrame) -> DataFrame:
    """Counts by status (default candidate) and by class, whatever the status."""
    both = labels.select(F.explode(F.array(F.struct(F.lit("status").alias("kind"), F.coalesce("status", F.lit("candidate")).alias("name")), F.struct(F.lit("class").alias("kind"), F.col("class").alias("name")))).alias("k"))
    return both.select("k.kind", "k.name").filter(F.coalesce(F.col("name"), F.lit("")) != "").groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


def reviewed(labels: DataFrame, *keys: str) -> DataFrame:
    """Labels whose status is not candidate; a missing status counts as reviewed."""
    return labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("status").eqNullSafe("candidate")).alias("reviewed"))


def recount(labels: DataFrame, *keys: str) -> DataFrame:
    """The editor's tally: a missing status is candidate, classes leave rejected rows out."""
    status = F.coalesce("status", F.lit("candidate"))
    per_class = [F.count_if((F.col("class") == c) & (status != "rejected")).alias(f"n_{c}") for c in CLASSES]
    return labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(status != "candidate").alias("reviewed"), F.count_if(status == "rejected").alias("rejected"), F.count_if(status == "added").alias("added"), *per_class)


def progress(labels: DataFrame) -> DataFrame:
    """Per area: counts by status and rejections per thousand decided, -1 where none is decided."""
    counts = labels.groupBy("aoi").agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    decided = F.col("confirmed") + F.col("rejected")
    return counts.withColumn("rate", F.when(decided == 0, F.lit(-1)).otherwise(F.floor(F.col("rejected") * 1000 / decided)).cast("long"))


def is_rectangle(points: Column, tolerance: float = RECTANGLE_TOLERANCE) -> Column:
    def gap(i: int, j: int) -> Column:
        a, b = F.get(points, F.lit(i)), F.get(points, F.lit(j))
        return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))

    return G.all_of([F.abs(gap(0, 1) - gap(2, 3)) < tolerance, F.abs(gap(1, 2) - gap(3, 0)) < tolerance, F.abs(gap(0, 2) - gap(1, 3)) < tolerance])


def problems(labels: DataFrame, key: str) -> DataFrame:
    """``(key, problem)`` for every defect. ``ring`` is closed: five positions for a box."""
    status, name, ring = F.col("status"), F.coalesce("class", F.lit("")), F.col("ring")
    shape = F.when(ring.isNull(), "no ring").when(F.size(ring) != 5, F.concat(F.lit("positions "), F.size(ring).cast("string"))).when(~is_rectangle(ring), "not a rectangle")
    found = F.array_compact(
        F.array(
            F.when(~F.coalesce(status.isin(*STATUSES), F.lit(False)), F.concat(F.lit("status "), F.coalesce(status, F.lit("none")))),
            F.when((name != "") & ~name.isin(*CLASSES), F.concat(F.lit("class "), name)),
            F.when(F.coalesce(status.isin(*VERIFIED), F.lit(False)) & (name == ""), F.concat(status, F.lit(" without class"))),
            shape,
        )
    )
    return labels.select(key, F.explode(found).alias("problem"))


def displaced(labels: DataFrame) -> DataFrame:
    """Labels (``cx``, ``cy``) outside the closed bounds of their area, with the farthest axis distance in whole metres."""
    outside = ~G.inside_closed(F.col("cx"), F.col("cy"), F.col("min_e"), F.col("min_n"), F.col("max_e"), F.col("max_n"))
    far = F.greatest(F.col("min_e") - F.col("cx"), F.col("cx") - F.col("max_e"), F.col("min_n") - F.col("cy"), F.col("cy") - F.col("max_n"))
    return labels.filter(outside).withColumn("distance_m", G.scaled(far, 1))


def stage(candidates: DataFrame) -> DataFrame:
    """Candidates as label rows: area (default unknown), status and class; ``label`` goes."""
    area = F.when(F.coalesce("aoi", F.lit("")) == "", "unknown").otherwise(F.col("aoi"))
    return candidates.withColumns({"aoi": area, "status": F.lit("candidate"), "class": F.lit("")}).drop("label")


def review_order(labels: DataFrame) -> DataFrame:
    """``place`` of ``total`` in the banded sweep of an area: bands of 100 m from the north, west to east within."""
    band = F.floor(F.col("cy") / 100 + F.lit(0.5))
    area = Window.partitionBy("aoi")
    return labels.withColumns({"place": F.row_number().over(area.orderBy(F.desc(band), "cx", "det_id")).cast("long"), "total": F.count(F.lit(1)).over(area)})


def next_candidate(labels: DataFrame) -> DataFrame:
    """For each candidate of an area, the next and the previous one in sweep order, round the ends."""
    waiting = review_order(labels).filter(F.coalesce("status", F.lit("candidate")) == "candidate")
    sweep = Window.partitionBy("aoi").orderBy("place")
    whole = sweep.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return waiting.withColumns({"next_id": F.coalesce(F.lead("det_id").over(sweep), F.first("det_id").over(whole)), "previous_id": F.coalesce(F.lag("det_id").over(sweep), F.last("det_id").over(whole))})


def listing(areas: DataFrame, labels: DataFrame) -> DataFrame:
    """Areas (``aoi``, other columns kept) with ``total`` and ``reviewed`` boxes, zero and not ``staged`` where there are none."""
    counts = reviewed(labels, "aoi")
    told = areas.join(counts, "aoi", "left").withColumn("staged", F.col("total").isNotNull())
    return told.fillna(0, ["total", "reviewed"])


def role_report(areas: DataFrame) -> DataFrame:
    """``split, role, n`` of areas with their sums, which have ``*`` for what is summed over."""
    counts = areas.rollup("split", "role").agg(F.grouping("split").alias("_s"), F.grouping("role").alias("_r"), F.count(F.lit(1)).alias("n"))
    return counts.select(F.when(F.col("_s") == 1, "*").otherwise(F.col("split")).alias("split"), F.when(F.col("_r") == 1, "*").otherwise(F.col("role")).alias("role"), "n")


def unvalidated_roles(areas: DataFrame) -> DataFrame:
    """Roles that no area of the validation split has."""
    return areas.select("role").distinct().join(areas.filter(F.col("split") == "validation").select("role"), "role", "left_anti")


def folder_tallies(areas: DataFrame) -> DataFrame:
    """``bucket, areas, total, reviewed`` of areas (``split, total, reviewed``, nulls where not staged) by split, with ``all`` for the sum."""
    bucket = F.when(F.col("total").isNull(), "not staged").otherwise(F.col("split"))
    sums = [F.count(F.lit(1)).alias("areas"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "reviewed")]]
    told = areas.withColumn("bucket", bucket).rollup("bucket").agg(F.grouping("bucket").alias("_all"), *sums)
    return told.select(F.when(F.col("_all") == 1, "all").otherwise(F.col("bucket")).alias("bucket"), "areas", "total", "reviewed")


def export_totals(windows: DataFrame, held: DataFrame) -> DataFrame:
    """``split, windows, boxes``: windows (``split, aoi, x, y``) of an export and the boxes (``yolo_boxes``) in them."""
    boxes = held.groupBy("aoi", "x", "y").agg(F.count(F.lit(1)).alias("_n"))
    return windows.join(boxes, ["aoi", "x", "y"], "left").groupBy("split").agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("boxes"))


def shown_problems(found: DataFrame, key: str, *, most: int = 20) -> tuple[list[str], int]:
    """The first ``most`` defects by key as lines for a report, and how many more there are."""
    first = found.orderBy(key, "problem").limit(most).collect()
    return [f"{r[key]}: {r['problem']}" for r in first], max(0, found.count() - most)


def coalesced_edits(edits: DataFrame, *, gap_ms: int = 700) -> DataFrame:
    """Undo entries: runs of edits of one box, each within ``gap_ms`` of the one before.

    ``edits`` has ``seq``, ``box``, ``at_ms`` and a ``session``; an edit of another box ends a run.
    """
    order = Window.partitionBy("session").orderBy("seq")
    fresh = F.lag("box").over(order).isNull() | (F.lag("box").over(order) != F.col("box")) | (F.col("at_ms") - F.lag("at_ms").over(order) >= gap_ms)
    runs = edits.withColumn("run", F.sum(F.when(fresh, 1).otherwise(0)).over(order))
    return runs.groupBy("session", "run").agg(F.min("seq").alias("seq"), F.first("box").alias("box"), F.count(F.lit(1)).alias("edits"), F.max("at_ms").alias("at_ms"))


def yolo_boxes(windows: DataFrame, boxes: DataFrame, *, size_px: int, metres_px: float, origin_e: float, origin_n: float) -> DataFrame:
    """Boxes of an area whose corners all lie in a window (closed), with corners as shares of the window.

    ``windows`` has ``aoi, x, y`` in grid pixels; ``boxes`` has ``aoi, det_id``, the class and corner columns.
    Both meet in slots of a window's size: a box in that of its north-west corner, a window in the four it touches.
    """
    pixel = {f"{a}{k}": (F.col(f"x{k}") - origin_e) / metres_px if a == "u" else (origin_n - F.col(f"y{k}")) / metres_px for k in range(4) for a in ("u", "v")}
    placed = boxes.withColumns(pixel)
    for axis, slot in (("u", "sx"), ("v", "sy")):
        placed = placed.withColumn(slot, F.floor(F.least(*[F.col(f"{axis}{k}") for k in range(4)]) / size_px).cast("long"))
    touched = windows
    for axis, slot in (("x", "sx"), ("y", "sy")):
        first = F.floor(F.col(axis) / size_px).cast("long")
        touched = touched.withColumn(slot, F.explode(F.array(first, first + 1)))
    pairs = touched.join(placed, ["aoi", "sx", "sy"]).drop("sx", "sy")
    shares = {name: (F.col(name) - F.col("x" if name[0] == "u" else "y")) / size_px for name in pixel}
    return pairs.withColumns(shares).filter(G.all_of([F.col(c).between(0.0, 1.0) for c in shares]))


def yolo_line(prefix: str = "") -> Column:
    """``class u0 v0 ... u3 v3`` with six decimals."""
    parts = [class_index(F.col("class")).cast("string")] + [F.format_string("%.6f", F.col(f"{prefix}{a}{k}")) for k in range(4) for a in ("u", "v")]
    return F.concat_ws(" ", *parts)
