"""Boxes as an editor handles them: a centreline with a width."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres a box's width and length are kept within.
WIDTHS, LENGTHS = (1.5, 6.0), (2.0, 30.0)
#: A centreline shorter than this has no direction.
POINT_M = 1e-6


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _clamped(value: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.lit(bounds[1]), F.greatest(F.lit(bounds[0]), value))


def clamp_width(value: Column) -> Column:
    return _clamped(value, WIDTHS)


def clamp_length(value: Column) -> Column:
    return _clamped(value, LENGTHS)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _plus(p: Column, v: Column, times: Column | float = 1.0) -> Column:
    return point(p["x"] + v["x"] * times, p["y"] + v["y"] * times)


def _minus(p: Column, q: Column) -> Column:
    return _plus(p, q, -1.0)


def _size(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"])


def _mean(p: Column, q: Column) -> Column:
    return point((p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2)


def _direction(step: Column) -> Column:
    """A vector of length one; north where there is no direction."""
    return _bound(step, lambda v: F.when(_size(v) < POINT_M, point(F.lit(0.0), F.lit(1.0))).otherwise(point(v["x"] / _size(v), v["y"] / _size(v))))


def box_of(nose: Column, tail: Column, width: Column) -> Column:
    """Ring around a centreline: along its left side, back along its right."""

    def ring(along: Column) -> Column:
        left = point(-along["y"], along["x"])
        return F.zip_with(F.array(nose, tail, tail, nose), F.array(*map(F.lit, (0.5, 0.5, -0.5, -0.5))), lambda end, side: _plus(end, left, side * width))

    return _bound(_direction(_minus(tail, nose)), ring)


def _north_east(step: Column) -> Column:
    """How far a step leads north-east, or east where that does not tell."""
    return _bound(step, lambda v: F.when(F.abs(v["x"] + v["y"]) > POINT_M, v["x"] + v["y"]).otherwise(v["x"] - v["y"]))


def centreline_of(ring: Column) -> Column:
    """``nose`` and ``tail``: the middles of the short sides, the one farther north-east first."""

    def ends(r: Column) -> Column:
        corner = [F.get(r, F.lit(k % 4)) for k in range(5)]
        middle = [_mean(corner[k], corner[k + 1]) for k in range(4)]
        first_short = _size(_minus(corner[1], corner[0])) <= _size(_minus(corner[2], corner[1]))
        return F.when(first_short, F.array(middle[0], middle[2])).otherwise(F.array(middle[1], middle[3]))

    def ordered(e: Column) -> Column:
        one, other = F.get(e, F.lit(0)), F.get(e, F.lit(1))
        ahead = _north_east(_minus(one, other)) > 0
        return F.struct(F.when(ahead, one).otherwise(other).alias("nose"), F.when(ahead, other).otherwise(one).alias("tail"))

    return _bound(_bound(ring, ends), ordered)


def _line(nose: Column, tail: Column) -> Column:
    return F.struct(nose.alias("nose"), tail.alias("tail"))


def lengthened(nose: Column, tail: Column, by: Column, width: Column) -> Column:
    """A centreline made longer about its middle, within bounds and never shorter than the box is wide; one without direction stays."""

    def grown(line: Column) -> Column:
        step, middle = _minus(line["tail"], line["nose"]), _mean(line["nose"], line["tail"])
        half = F.greatest(clamp_length(_size(step) + by), width) / 2
        along = _direction(step)
        return F.when(_size(step) < POINT_M, line).otherwise(_line(_plus(middle, along, -half), _plus(middle, along, half)))

    return _bound(_line(nose, tail), grown)


def turned(nose: Column, tail: Column, degrees: Column) -> Column:
    """A centreline turned clockwise about its middle."""
    sin, cos = F.sin(F.radians(degrees)), F.cos(F.radians(degrees))

    def swung(line: Column) -> Column:
        middle = _mean(line["nose"], line["tail"])
        arm = _minus(line["nose"], middle)
        way = point(arm["x"] * cos + arm["y"] * sin, arm["y"] * cos - arm["x"] * sin)
        return _line(_plus(middle, way), _minus(middle, way))

    return _bound(_line(nose, tail), swung)


def colour(status: Column, name: Column) -> Column:
    """What a box is drawn as: rejected, its class, or candidate."""
    return F.when(status == "rejected", "rejected").when(F.coalesce(name, F.lit("")) != "", name).otherwise("candidate")


def elapsed(seconds: Column) -> Column:
    """``42s``, ``12m 05s`` or ``1h 3m`` of whole seconds."""
    hours, minutes, rest = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60
    return F.when(seconds >= 3600, F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m"))).when(seconds >= 60, F.concat(minutes.cast("string"), F.lit("m "), F.lpad(rest.cast("string"), 2, "0"), F.lit("s"))).otherwise(F.concat(seconds.cast("string"), F.lit("s")))


def safe_name(name: Column) -> Column:
    """Whether a name may be part of a path."""
    return F.coalesce(name.rlike("^[A-Za-z0-9_-]+$"), F.lit(False))
