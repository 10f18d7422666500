"""Tiles, windows and cells of the image grid (EPSG:3879)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The grid's top-left corner, its resolution at zoom 0, tile and window sizes, the deepest zoom.
ORIGIN_N, ORIGIN_E, RESOLUTION_0 = 8388608.0, 24451424.0, 8192.0
TILE_PX, MAX_ZOOM, WINDOW_PX, OVERLAP_M = 256, 17, 1024, 30.0


def check_zoom(zoom: int) -> int:
    if not 0 <= zoom <= MAX_ZOOM:
        raise ValueError(f"zoom {zoom} is not in 0..{MAX_ZOOM}")
    return zoom


def resolution(zoom: int) -> float:
    return RESOLUTION_0 / 2 ** check_zoom(zoom)


def tile_span(zoom: int) -> float:
    return resolution(zoom) * TILE_PX


def matrix_size(zoom: int) -> int:
    return 2 ** check_zoom(zoom)


def tile_at(e: Column, n: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of the tile that holds a point; rows count southwards."""
    span = tile_span(zoom)
    return F.floor((e - ORIGIN_E) / span).cast("long"), F.floor((ORIGIN_N - n) / span).cast("long")


def tile_bounds(col: Column, row: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    span = tile_span(zoom)
    west, north = ORIGIN_E + col * span, ORIGIN_N - row * span
    return west, north - span, west + span, north


def tile_range(min_e: Column, min_n: Column, max_e: Column, max_n: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    """First and last column and row that cover bounds; upper edges are exclusive, but one tile is always covered."""
    span = tile_span(zoom)
    c0, r0 = F.floor((min_e - ORIGIN_E) / span).cast("long"), F.floor((ORIGIN_N - max_n) / span).cast("long")
    c1, r1 = (F.ceil((max_e - ORIGIN_E) / span) - 1).cast("long"), (F.ceil((ORIGIN_N - min_n) / span) - 1).cast("long")
    return c0, F.greatest(c0, c1), r0, F.greatest(r0, r1)


def tile_count(min_e: Column, min_n: Column, max_e: Column, max_n: Column, zoom: int) -> Column:
    c0, c1, r0, r1 = tile_range(min_e, min_n, max_e, max_n, zoom)
    return (c1 - c0 + 1) * (r1 - r0 + 1)


def to_pixel(e: Column, n: Column, zoom: int) -> tuple[Column, Column]:
    return (e - ORIGIN_E) / resolution(zoom), (ORIGIN_N - n) / resolution(zoom)


def from_pixel(x: Column, y: Column, zoom: int) -> tuple[Column, Column]:
    return ORIGIN_E + x * resolution(zoom), ORIGIN_N - y * resolution(zoom)


def window_starts(low: Column, high: Column, size: int, step: int) -> Column:
    """First pixels of windows from ``low`` to ``high``: every ``step``, the last moved back to end flush, one where all fits."""
    count = F.greatest(F.lit(1), F.ceil((high - low - size) / step) + 1)
    return F.transform(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1), lambda k: F.greatest(low, F.least(low + k * step, high - size)))


def windows(areas: DataFrame, zoom: int, *, size: int = WINDOW_PX, overlap_m: float = OVERLAP_M) -> DataFrame:
    """``areas`` (with min_e, min_n, max_e, max_n) by window: adds the origins ``x`` and ``y`` in grid pixels."""
    step = size - math.ceil(overlap_m / resolution(zoom))
    if step < 1:
        raise ValueError(f"windows of {size} px cannot share {overlap_m} m at zoom {zoom}")
    corners = to_pixel(F.col("min_e"), F.col("max_n"), zoom), to_pixel(F.col("max_e"), F.col("min_n"), zoom)
    for name, low, high in zip(("x", "y"), *corners, strict=True):
        areas = areas.withColumn(name, F.explode(window_starts(F.floor(low).cast("long"), F.ceil(high).cast("long"), size, step)))
    return areas


def tiles(areas: DataFrame, zoom: int) -> DataFrame:
    """``areas`` by covering tile: adds ``tile_row`` and ``tile_col``."""
    c0, c1, r0, r1 = tile_range(F.col("min_e"), F.col("min_n"), F.col("max_e"), F.col("max_n"), zoom)
    return areas.withColumn("tile_row", F.explode(F.sequence(r0, r1))).withColumn("tile_col", F.explode(F.sequence(c0, c1)))


def window_slot(e: Column, n: Column, zoom: int) -> tuple[Column, Column]:
    """Slot of the absolute window raster; pixels are truncated before they are divided."""
    x, y = to_pixel(e, n, zoom)
    return F.floor(x.cast("long") / WINDOW_PX).cast("long"), F.floor(y.cast("long") / WINDOW_PX).cast("long")


def cell_of(e: Column, n: Column, size: float) -> tuple[Column, Column]:
    return F.floor(e / size).cast("long"), F.floor(n / size).cast("long")


def cell_bounds(col: Column, row: Column, size: float) -> tuple[Column, Column, Column, Column]:
    return col * size, row * size, (col + 1) * size, (row + 1) * size


def cell_centre(col: Column, row: Column, size: float) -> tuple[Column, Column]:
    return (col + 0.5) * size, (row + 0.5) * size


def cell_name(col: Column, row: Column) -> Column:
    return F.concat(F.lit("e"), col.cast("string"), F.lit("n"), row.cast("string"))


def cells(areas: DataFrame, size: float) -> DataFrame:
    """``areas`` by the cells their envelopes share positive area with: adds ``cell_col`` and ``cell_row``."""

    def span(low: Column, high: Column) -> Column:
        first = F.floor(low / size).cast("long")
        return F.sequence(first, F.greatest(first, (F.ceil(high / size) - 1).cast("long")))

    return areas.withColumn("cell_col", F.explode(span(F.col("min_e"), F.col("max_e")))).withColumn("cell_row", F.explode(span(F.col("min_n"), F.col("max_n"))))
