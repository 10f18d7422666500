"""Spatial joins by grid buckets.

A theta join on coordinates would compare everything with everything. Both sides
are dealt to square buckets instead and joined on the bucket, so that Spark can
hash, sort, broadcast or split the join as sizes demand; the exact predicate is
checked on candidates only. Where both sides span buckets, a pair counts in the
bucket that holds the lower left corner of the shared envelope, and so once.

Defined results: null coordinates and null outlines meet nothing; a point that
several areas hold keeps the first by position; repeated rows are kept on the left
of an attachment; empty tables give empty results; other columns of the left side
are kept, those of areas only if they are named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.staging import staged as stored

Envelope = tuple[Column, Column, Column, Column]
#: Names of an area's envelope columns.
ENVELOPE = ("a_min_e", "a_min_n", "a_max_e", "a_max_n")


def _span(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size).cast("long"), F.floor(high / size).cast("long"))


def by_bucket(frame: DataFrame, envelope: Envelope, size: float, *, reach: float = 0.0) -> DataFrame:
    """Rows by every bucket their envelope, widened by ``reach``, touches: adds ``bx`` and ``by``."""
    return frame.withColumn("bx", F.explode(_span(envelope[0] - reach, envelope[2] + reach, size))).withColumn("by", F.explode(_span(envelope[1] - reach, envelope[3] + reach, size)))


def with_polygon(areas: DataFrame, edges: Column) -> DataFrame:
    """``areas`` with ``edges`` and its envelope columns ``a_min_e`` ... ``a_max_n``."""
    kept = areas.withColumn("edges", edges)
    east, north = F.transform("edges", lambda e: e["ax"]), F.transform("edges", lambda e: e["ay"])
    return kept.withColumns({"a_min_e": F.array_min(east), "a_min_n": F.array_min(north), "a_max_e": F.array_max(east), "a_max_n": F.array_max(north)})



def area_envelope() -> Envelope:
    return tuple(F.col(c) for c in ENVELOPE)


def point_candidates(points: DataFrame, areas: DataFrame, *, size: float, reach: float = 0.0) -> DataFrame:
    """Pairs of a point (``cx``, ``cy``) and an area whose widened envelope holds it."""
    dealt = points.withColumn("bx", F.floor(F.col("cx") / size).cast("long")).withColumn("by", F.floor(F.col("cy") / size).cast("long"))
    near = by_bucket(areas, area_envelope(), size, reach=reach)
    inside = F.col("cx").between(F.col("a_min_e") - reach, F.col("a_max_e") + reach) & F.col("cy").between(F.col("a_min_n") - reach, F.col("a_max_n") + reach)
    return dealt.join(near, ["bx", "by"]).filter(inside).drop("bx", "by")


def first_match(pairs: DataFrame, key: str, order: list[Column], *keep: str) -> DataFrame:
    """The first pair of each ``key`` by ``order``, with the columns ``keep``."""
    ranked = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])
    return pairs.groupBy(key).agg(F.min_by(F.struct(*keep), ranked).alias("_m")).select(key, *[F.col(f"_m.{c}").alias(c) for c in keep])


def attach_area(points: DataFrame, areas: DataFrame, key: str, position: str, *keep: str, size: float = 100.0) -> DataFrame:
    """Left join of the first area, by ``position``, that strictly holds a point; null where none does."""
    pairs = point_candidates(points.select(key, "cx", "cy"), areas.select(position, *keep, "edges", *ENVELOPE), size=size)
    held = pairs.filter(G.inside_strict(F.col("cx"), F.col("cy"), F.col("edges")))
    return points.join(first_match(held, key, [F.col(position)], *keep), key, "left")


def attach_nearest(points: DataFrame, areas: DataFrame, key: str, position: str, *keep: str, within: float, size: float = 100.0) -> DataFrame:
    """Left join of the nearest area within a distance; ties go to the first by ``position``."""
    pairs = point_candidates(points.select(key, "cx", "cy"), areas.select(position, *keep, "edges", *ENVELOPE), size=size, reach=within)
    near = pairs.withColumn("distance_m", G.distance(F.col("cx"), F.col("cy"), F.col("edges"))).filter(F.col("distance_m") <= within)
    return points.join(first_match(near, key, [F.col("distance_m"), F.col(position)], *keep, "distance_m"), key, "left")


def held_by_any(points: DataFrame, areas: DataFrame, key: str, *, size: float = 100.0) -> DataFrame:
    """Keys of points strictly inside some area."""
    pairs = point_candidates(points.select(key, "cx", "cy"), areas.select("edges", *ENVELOPE), size=size)
    return pairs.filter(G.inside_strict(F.col("cx"), F.col("cy"), F.col("edges"))).select(key).distinct()


def touched_by_any(boxes: DataFrame, areas: DataFrame, key: str, *, size: float = 100.0) -> DataFrame:
    """Keys of boxes (corner columns) that share a point with some area."""
    own = boxes.select(key, G.edges_of(G.box_ring()).alias("own"), *[c.alias(n) for c, n in zip(G.envelope(), ("b0", "b1", "b2", "b3"), strict=True)])
    left = by_bucket(own, (F.col("b0"), F.col("b1"), F.col("b2"), F.col("b3")), size)
    right = by_bucket(areas.select("edges", *ENVELOPE), area_envelope(), size)
    near = (F.col("b0") <= F.col("a_max_e")) & (F.col("a_min_e") <= F.col("b2")) & (F.col("b1") <= F.col("a_max_n")) & (F.col("a_min_n") <= F.col("b3"))
    return left.join(right, ["bx", "by"]).filter(near).filter(G.intersects_touch(F.col("own"), F.col("edges"))).select(key).distinct()


def box_pairs(a: DataFrame, b: DataFrame, *, size: float = 32.0) -> DataFrame:
    """Pairs of boxes whose envelopes overlap, each once.

    ``a`` and ``b`` have ``id`` and corner columns; the result has them with the prefixes ``a_`` and ``b_``.
    """

    def dealt(frame: DataFrame, prefix: str) -> DataFrame:
        named = frame.select(*[F.col(c).alias(prefix + c) for c in frame.columns]).withColumns(dict(zip([f"{prefix}e{k}" for k in range(4)], G.envelope(prefix), strict=True)))
        return by_bucket(named, tuple(F.col(f"{prefix}e{k}") for k in range(4)), size)

    pairs = dealt(a, "a_").join(dealt(b, "b_"), ["bx", "by"])
    west, south = F.greatest("a_e0", "b_e0"), F.greatest("a_e1", "b_e1")
    overlap = (west <= F.least("a_e2", "b_e2")) & (south <= F.least("a_e3", "b_e3"))
    home = (F.floor(west / size).cast("long") == F.col("bx")) & (F.floor(south / size).cast("long") == F.col("by"))
    return pairs.filter(overlap & home).drop("bx", "by", *[f"{p}e{k}" for p in ("a_", "b_") for k in range(4)])

