"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius of the globe and the international mile, both in metres.
GLOBE_RADIUS_METRES = 6_371_000.0
MILE_METRES = 1_609.344


def great_circle_miles(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in miles between two points given in degrees."""
    half_lat = (F.radians(lat_b) - F.radians(lat_a)) / 2
    half_lon = (F.radians(lon_b) - F.radians(lon_a)) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(half_lon), 2)
    # Rounding can push h just above 1 for opposite points, where asin would give NaN. `least`
    # skips nulls, so it must not see a null h.
    clamped = F.when(h.isNotNull(), F.least(h, F.lit(1.0)))
    return 2 * GLOBE_RADIUS_METRES * F.asin(F.sqrt(clamped)) / MILE_METRES
