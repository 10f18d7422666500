"""Sweeping windows with a detector, and putting what it finds on the map.

Defined results: windows without an image, or with a tile missing, give no boxes;
repeated windows are swept once each and their boxes merged; null labels are of no
class to keep; areas without windows give no rows; an empty table gives an empty one;
other columns of windows are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.functions import grid
from gridsight.operators import nms

MIN_LENGTH_M = 4.0


class Detector(Protocol):
    """Boxes of one image: ``(label, confidence, x0, y0, ... x3, y3)`` in its pixels."""

    def detect(self, image: bytes) -> list[tuple]: ...


def detect(windows: DataFrame, load: Callable[[], Detector]) -> DataFrame:
    """Raw boxes of ``windows (area, x, y, image)``; the detector is loaded once per task. Windows without an image are skipped."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            rows = [(w.area, w.x, w.y, k, *box) for w in frame.itertuples(index=False) if w.image is not None for k, box in enumerate(model.detect(bytes(w.image)))]
            yield pd.DataFrame(rows, columns=["area", "x", "y", "k", "label", "confidence", *G.CORNERS])

    corners = ", ".join(f"{c} double" for c in G.CORNERS)
    area = windows.schema["area"].dataType.simpleString()
    return windows.select("area", "x", "y", "image").mapInPandas(run, f"area {area}, x long, y long, k long, label string, confidence double, {corners}")


def georeference(raw: DataFrame, zoom: int) -> DataFrame:
    """Corners from window pixels to grid metres."""
    metres = grid.resolution(zoom)
    placed = {}
    for k in range(4):
        placed[f"x{k}"] = grid.ORIGIN_E + (F.col("x") + F.col(f"x{k}")) * metres
        placed[f"y{k}"] = grid.ORIGIN_N - (F.col("y") + F.col(f"y{k}")) * metres
    return raw.withColumns(placed)


#: Vehicle classes of the public aerial data set that detectors are trained on.
VEHICLES = ("large vehicle", "small vehicle")


def finds_vehicles(names: Column) -> Column:
    """Whether any of a model's class names is a vehicle's; null and empty lists have none."""
    return F.coalesce(F.arrays_overlap(F.transform(names, F.lower), F.array(*map(F.lit, VEHICLES))), F.lit(False))


class OnnxDetector:
    """A model file read by onnxruntime when it is first used; ``prepare`` makes its input of an image, ``boxes`` the rows of its outputs."""

    def __init__(self, path: str, prepare: Callable[[bytes], np.ndarray], boxes: Callable[[list[np.ndarray]], list[tuple]]):
        self.path, self.prepare, self.boxes, self._session = path, prepare, boxes, None

    def detect(self, image: bytes) -> list[tuple]:
        if self._session is None:
            import onnxruntime

            self._session = onnxruntime.InferenceSession(self.path, providers=["CPUExecutionProvider"])
        return self.boxes(self._session.run(None, {self._session.get_inputs()[0].name: self.prepare(image)}))


def window_tiles(windows: DataFrame, *, size: int = grid.WINDOW_PX) -> DataFrame:
    """``windows`` (``x, y`` in grid pixels) by the tiles they show: adds ``tile_col`` and ``tile_row``."""

    def span(low: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / grid.TILE_PX).cast("long"), F.floor((low + size - 1) / grid.TILE_PX).cast("long")))

    return windows.withColumn("tile_col", span(F.col("x"))).withColumn("tile_row", span(F.col("y")))


def stitch(windows: DataFrame, tiles: DataFrame, decode: Callable[[bytes], np.ndarray], encode: Callable[[np.ndarray], bytes], *, size: int = grid.WINDOW_PX) -> DataFrame:
    """``area, x, y, image`` of windows put together from ``tiles (tile_col, tile_row, body)``; null if a tile is missing.

    ``decode`` gives a tile's pixels as (rows, columns, channels), ``encode`` makes an image of a window's.
    A window's tiles are few whatever the table's size, so they meet in one row.
    """
    needed = window_tiles(windows.select("area", "x", "y").distinct(), size=size)
    met = needed.join(tiles.groupBy("tile_col", "tile_row").agg(F.first("body", ignorenulls=True).alias("body")), ["tile_col", "tile_row"], "left")
    held = met.groupBy("area", "x", "y").agg(F.collect_list(F.struct("tile_col", "tile_row", "body")).alias("tiles"))
    px = grid.TILE_PX

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            images = []
            for w in frame.itertuples(index=False):
                if any(t["body"] is None for t in w.tiles):
                    images.append(None)
                    continue
                canvas = None
                for t in w.tiles:
                    body = decode(bytes(t["body"]))
                    canvas = np.zeros((size, size, body.shape[2]), body.dtype) if canvas is None else canvas
                    left, top = t["tile_col"] * px - w.x, t["tile_row"] * px - w.y
                    c0, c1, r0, r1 = max(0, left), min(size, left + px), max(0, top), min(size, top + px)
                    canvas[r0:r1, c0:c1] = body[r0 - top : r1 - top, c0 - left : c1 - left]
                images.append(encode(canvas))
            yield frame[["area", "x", "y"]].assign(image=images)

    kind = windows.schema["area"].dataType.simpleString()
    return held.mapInPandas(run, f"area {kind}, x long, y long, image binary")


def observed(windows: DataFrame, seen: Observation) -> DataFrame:
    """``windows`` counted on their way: ``seen.get`` has ``windows`` and how many were ``skipped`` once an action is over."""
    return windows.observe(seen, F.count(F.lit(1)).alias("windows"), F.count_if(F.col("image").isNull()).alias("skipped"))


def told(index: Column, total: Column, *, every: int = 100) -> Column:
    """Whether progress is told at a window: the first, the last and every hundredth."""
    return (index == 1) | (index == total) | (index % every == 0)


def sweep(windows: DataFrame, load: Callable[[], Detector], zoom: int, *, min_length_m: float = MIN_LENGTH_M, keep: list[str] | None = None, across: bool = False) -> DataFrame:
    """Detections of areas: seams are merged before short boxes go, so a short confident box may remove a longer one.

    Areas are swept by themselves, so boxes of two that overlap both stay, unless ``across`` merges them too.
    """
    found = georeference(detect(windows, load), zoom)
    if keep is not None:
        found = found.filter(F.col("label").isin(keep))
    # The id follows window order, as ties in confidence go to the earlier box.
    named = found.withColumn("id", F.struct("area", "y", "x", "k"))
    return nms.merge(named, within=None if across else "area").filter(G.length_m() >= min_length_m)
