"""Outlines of vehicles from masks, instead of their boxes.

A segmenter marks the pixels of a vehicle; what lies outside its box is cut off, and the
largest connected patch is traced along its pixels' sides and simplified.

Defined results: a mask of few pixels has no outline, so its box stays; windows without
an image give none; of patches of equal size the first from the top is traced; holes in
a patch are not kept; repeated boxes are outlined each; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsight.functions import geometry as G
from gridsight.functions import grid

#: Least pixels of a mask, and how far a simplified outline may be from the traced one, in metres.
LEAST_PIXELS, TOLERANCE_M = 40, 0.15


class Segmenter(Protocol):
    """One mask (rows, columns) for each ring of pixel positions."""

    def segment(self, image: bytes, rings: list[np.ndarray]) -> list[np.ndarray]: ...


def ring_mask(ring: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Pixels whose middle lies inside a ring ``(corners, 2)``."""
    x, y = np.arange(shape[1]) + 0.5, (np.arange(shape[0]) + 0.5)[:, None]
    inside = np.zeros(shape, bool)
    for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, 0), strict=True):
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return inside


def traced(mask: np.ndarray) -> np.ndarray | None:
    """The outer border of a mask's largest patch as pixel corners, clockwise on the image; None for an empty mask."""
    wide = np.pad(mask, 1)
    sides: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for dy, dx, (ax, ay), (bx, by) in ((-1, 0, (0, 0), (1, 0)), (0, 1, (1, 0), (1, 1)), (1, 0, (1, 1), (0, 1)), (0, -1, (0, 1), (0, 0))):
        rows, columns = np.nonzero(mask & ~wide[1 + dy : wide.shape[0] - 1 + dy, 1 + dx : wide.shape[1] - 1 + dx])
        for r, c in zip(rows.tolist(), columns.tolist(), strict=True):
            sides.setdefault((c + ax, r + ay), []).append((c + bx, r + by))
    best, most = None, 0.0
    while sides:
        start = min(sides, key=lambda p: (p[1], p[0]))
        path, at, way = [start], start, (1, 0)
        while True:
            ends = sides[at]
            # Where two patches touch at a corner, turning right stays on this one.
            to = max(ends, key=lambda e: (-way[1] * (e[0] - at[0]) + way[0] * (e[1] - at[1])))
            ends.remove(to)
            if not ends:
                del sides[at]
            way, at = (to[0] - at[0], to[1] - at[1]), to
            if at == start:
                break
            path.append(at)
        points = np.array(path, float)
        after = np.roll(points, -1, 0)
        area = (points[:, 0] * after[:, 1] - after[:, 0] * points[:, 1]).sum() / 2
        if area > most:  # borders of holes run the other way
            best, most = points, area
    return best


def simplified(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """A ring without the points that lie within ``tolerance`` of what is left."""
    far = int(((ring - ring[0]) ** 2).sum(1).argmax())
    closed = np.concatenate([ring, ring[:1]])
    keep = np.zeros(len(closed), bool)
    keep[[0, far, len(ring)]] = True
    spans = [(0, far), (far, len(ring))]
    while spans:
        low, high = spans.pop()
        if high - low < 2:
            continue
        a, step = closed[low], closed[high] - closed[low]
        away = closed[low + 1 : high] - a
        size = np.hypot(*step)
        gaps = np.abs(step[0] * away[:, 1] - step[1] * away[:, 0]) / size if size else np.hypot(away[:, 0], away[:, 1])
        k = int(gaps.argmax())
        if gaps[k] > tolerance:
            keep[low + 1 + k] = True
            spans += [(low, low + 1 + k), (low + 1 + k, high)]
    return closed[:-1][keep[:-1]]


def outline(mask: np.ndarray, ring: np.ndarray, tolerance: float) -> np.ndarray | None:
    """The simplified outline, in pixels, of what a mask has within a box; None where that is too little."""
    held = mask & ring_mask(ring, mask.shape)
    found = traced(held) if held.sum() >= LEAST_PIXELS else None
    found = None if found is None else simplified(found, tolerance)
    return None if found is None or len(found) < 3 else found


def outlines(windows: DataFrame, boxes: DataFrame, load: Callable[[], Segmenter], zoom: int) -> DataFrame:
    """``id, ring`` of ``boxes (id, corners)`` in the slot of ``windows (x, y, image)`` that holds their centre; a null ring keeps the box.

    Windows are those of the absolute raster, so a box has one; a window's boxes are few.
    """
    cx, cy = G.centre()
    slot_x, slot_y = grid.window_slot(cx, cy, zoom)
    placed = boxes.select("id", *G.CORNERS, slot_x.alias("sx"), slot_y.alias("sy"))
    held = placed.groupBy("sx", "sy").agg(F.collect_list(F.struct("id", *G.CORNERS)).alias("boxes"))
    met = held.join(windows.select(F.floor(F.col("x") / grid.WINDOW_PX).cast("long").alias("sx"), F.floor(F.col("y") / grid.WINDOW_PX).cast("long").alias("sy"), "x", "y", "image"), ["sx", "sy"])
    metres = grid.resolution(zoom)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            out = []
            for w in frame[frame.image.notna()].itertuples(index=False):
                rings = [np.array([[(b[f"x{k}"] - grid.ORIGIN_E) / metres - w.x, (grid.ORIGIN_N - b[f"y{k}"]) / metres - w.y] for k in range(4)]) for b in w.boxes]
                for b, ring, mask in zip(w.boxes, rings, model.segment(bytes(w.image), rings), strict=True):
                    found = outline(mask, ring, TOLERANCE_M / metres)
                    out.append((b["id"], None if found is None else [{"x": grid.ORIGIN_E + (w.x + x) * metres, "y": grid.ORIGIN_N - (w.y + y) * metres} for x, y in found.tolist()]))
            yield pd.DataFrame(out, columns=["id", "ring"])

    kind = boxes.schema["id"].dataType.simpleString()
    return met.select("x", "y", "image", "boxes").mapInPandas(run, f"id {kind}, ring array<struct<x: double, y: double>>")
