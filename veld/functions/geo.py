"""Geographic expressions (X9): ellipsoidal Mercator (EPSG:3395) and haversine.

Closed-form Catalyst math instead of a geometry library: a point is two DOUBLE columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from veld.functions._col import as_col

# WGS84 semi-major axis (m) and first eccentricity used by EPSG:3395.
WGS84_A = 6378137.0
WGS84_E = 0.0818191908426215
EARTH_RADIUS_M = 6371008.8


def mercator_x(lon) -> Column:
    return F.lit(WGS84_A) * F.radians(as_col(lon))


def mercator_y(lat) -> Column:
    phi = F.radians(as_col(lat))
    es = F.lit(WGS84_E) * F.sin(phi)
    return F.lit(WGS84_A) * F.ln(
        F.tan(F.lit(math.pi / 4) + phi / 2) * F.pow((1 - es) / (1 + es), WGS84_E / 2))


def mercator_distance(lat1, lon1, lat2, lon2) -> Column:
    """Planar distance in projected EPSG:3395 metres (what a buffer in that CRS measures)."""
    dx = mercator_x(lon1) - mercator_x(lon2)
    dy = mercator_y(lat1) - mercator_y(lat2)
    return F.sqrt(dx * dx + dy * dy)


def haversine_distance(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp = p2 - p1
    dl = F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def distance(lat1, lon1, lat2, lon2, metric: str = "mercator") -> Column:
    if metric == "mercator":
        return mercator_distance(lat1, lon1, lat2, lon2)
    if metric == "haversine":
        return haversine_distance(lat1, lon1, lat2, lon2)
    raise ValueError(f"unknown metric {metric!r}; use 'mercator' or 'haversine'")
