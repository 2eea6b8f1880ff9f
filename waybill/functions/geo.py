"""Distances and grid cells as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.least(F.lit(1.0), F.pow(F.sin(half_lat), F.lit(2)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), F.lit(2))
    ))  # rounding may lift it above 1 for points on opposite sides, where the root would be NaN
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def speed_kmh(distance_km: Column, minutes: Column) -> Column:
    """``minutes`` must be null, never zero, where no time has passed."""
    return distance_km / (minutes / 60)


def grid(value: Column, decimals: int = 3) -> Column:
    """Round to a grid, ties to the even neighbour (``round`` would go away from zero)."""
    scale = float(10**decimals)
    return F.rint(value * scale) / scale
