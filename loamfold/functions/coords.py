"""Coordinates: cyclic encodings, grid blocks, keys and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamfold.functions.fixed import BLOCK_DEGREES
from loamfold.functions.nulls import flag

EARTH_RADIUS_M = 6371008.8
DEGREE_M = 111195.08


def trig(lat: Column, lon: Column) -> dict[str, Column]:
    return {
        "lat_sin": F.sin(F.radians(lat)),
        "lat_cos": F.cos(F.radians(lat)),
        "lon_sin": F.sin(F.radians(lon)),
        "lon_cos": F.cos(F.radians(lon)),
    }


def hemisphere(lat: Column) -> dict[str, Column]:
    return {"lat_abs": F.abs(lat), "is_south": flag(lat < 0)}


def block_number(value: Column, size: float = BLOCK_DEGREES) -> Column:
    """Grid row or column; rounds towards minus infinity, NULL for a missing coordinate."""
    return F.floor(value / F.lit(size)).cast("bigint")


def block_key(lat: Column, lon: Column, size: float = BLOCK_DEGREES) -> Column:
    """``"lat_lon"`` text key of the block; NULL if a coordinate is missing."""
    rows, cols = block_number(lat, size), block_number(lon, size)
    return F.when(rows.isNotNull() & cols.isNotNull(), F.concat_ws("_", rows.cast("string"), cols.cast("string")))


def rounded_key(value: Column, digits: int = 4) -> Column:
    """Coordinate rounded half-even and scaled to a long, so it can be an equi-join key."""
    scale = float(10**digits)
    return F.round(F.bround(value, digits) * F.lit(scale), 0).cast("bigint")


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres."""
    half_dlat = F.radians(lat2 - lat1) / F.lit(2.0)
    half_dlon = F.radians(lon2 - lon1) / F.lit(2.0)
    chord = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), F.lit(2.0)
    )
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
