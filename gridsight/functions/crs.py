"""Transverse Mercator on GRS80 as column expressions (Krüger's series to third order)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80's semi-major axis and inverse flattening.
AXIS, INVERSE_FLATTENING = 6378137.0, 298.257222101
#: Central meridian, scale and false easting of the grids, by EPSG number.
GRIDS = {3879: (25.0, 1.0, 25500000.0), 3067: (27.0, 0.9996, 500000.0)}

_N = 1 / (2 * INVERSE_FLATTENING - 1)
RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ECCENTRICITY = 2 * math.sqrt(_N) / (1 + _N)
ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def grid_of(srid: int) -> tuple[float, float, float]:
    if srid not in GRIDS:
        raise ValueError(f"unknown grid EPSG:{srid}")
    return GRIDS[srid]


def from_wgs84(lon: Column, lat: Column, srid: int) -> tuple[Column, Column]:
    """Easting and northing of a longitude and latitude in degrees."""
    meridian, scale, false_easting = grid_of(srid)
    sin_lat = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin_lat) - ECCENTRICITY * F.atanh(ECCENTRICITY * sin_lat))
    turn = F.radians(lon - meridian)
    xi, eta = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return false_easting + scale * RADIUS * east, scale * RADIUS * north


def to_wgs84(easting: Column, northing: Column, srid: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a grid position."""
    meridian, scale, false_easting = grid_of(srid)
    xi, eta = northing / (scale * RADIUS), (easting - false_easting) / (scale * RADIUS)
    x, y = xi, eta
    for j, b in enumerate(BETA, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return meridian + F.degrees(F.atan2(F.sinh(y), F.cos(x))), F.degrees(lat)


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Between two grids, or from or to WGS84 (4326)."""
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else to_wgs84(x, y, source)
    return (lon, lat) if target == 4326 else from_wgs84(lon, lat, target)
