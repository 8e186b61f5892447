"""Spectral indices. Formulas are written once by band role; sensors differ only in their roles and names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamfold.functions.fixed import BANDS, INDICES, L8_FIRST_YEAR, S2_FIRST_YEAR


def _normalised(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def all_indices(bands: Mapping[str, Column]) -> dict[str, Column]:
    """Every index for a mapping of role to column; ``nir_narrow`` falls back to ``nir``."""
    blue, green, red = bands["blue"], bands["green"], bands["red"]
    nir, swir = bands["nir"], bands["swir1"]
    narrow = bands.get("nir_narrow", nir)
    return {
        "NDVI": _normalised(nir, red),
        "EVI": F.lit(2.5) * F.try_divide(nir - red, nir + red * F.lit(6.0) - blue * F.lit(7.5) + F.lit(1.0)),
        "NDWI": _normalised(green, nir),
        "BSI": F.try_divide((swir + red) - (narrow + blue), swir + red + narrow + blue),
        "ClayRatio": F.try_divide(swir, narrow),
        "IronOxide": F.try_divide(red, blue),
        "SAVI": F.lit(1.5) * F.try_divide(nir - red, nir + red + F.lit(0.5)),
    }


def sensor_features(sensor: str, bands: Mapping[str, Column]) -> dict[str, Column]:
    """Named bands and indices of one sensor, in output order."""
    roles = bands if sensor == "S2" else {k: v for k, v in bands.items() if k != "nir_narrow"}
    indices = all_indices(roles)
    named = {name: bands[role] for role, name in BANDS[sensor].items()}
    return {**named, **{name: indices[name] for name in INDICES[sensor]}}


def sensor_names(sensor: str) -> list[str]:
    return list(BANDS[sensor].values()) + INDICES[sensor]


def sensor_for_year(start_year: Column) -> Column:
    """Sensor whose archive covers the start year."""
    return (
        F.when(start_year >= S2_FIRST_YEAR, F.lit("S2"))
        .when(start_year >= L8_FIRST_YEAR, F.lit("L8"))
        .otherwise(F.lit("L7"))
    )
