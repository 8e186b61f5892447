"""Spectral features of points from scene tables: windows, composites, indices, means around the point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.fixed import CLOUD_LIMIT, RADIUS_M, RECENT_WINDOW
from loamfold.functions.spectral import sensor_features, sensor_for_year, sensor_names
from loamfold.operators.columns import any_of
from loamfold.operators.quantiles import many_medians
from loamfold.operators.spatial import in_window, scenes_in_windows, within_radius
from loamfold.session import stored

ROLES = ["blue", "green", "red", "nir", "nir_narrow", "swir1", "swir2"]
PLACE = ["Latitude", "Longitude"]
WINDOW = ["start_year", "end_year", "sensor"]


def clear_enough() -> Column:
    """The cloud filter holds for the S2 sensor only."""
    return (F.col("sensor") != "S2") | (F.col("cloud_pct") < CLOUD_LIMIT)


def site_means(pixels: DataFrame, sensor: str, prefix: str, keys: list[str]) -> DataFrame:
    """Mean over a site's pixels of each band and index of the composites."""
    named = sensor_features(sensor, {role: F.col(role) for role in ROLES})
    return pixels.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{name}") for name, c in named.items()])


def recent_composite(scenes: DataFrame) -> DataFrame:
    """Per pixel the median of each band over the fixed window.

    The window is the same for all points, so a pixel is composed once, however
    many points lie near it.
    """
    first, last = (F.lit(day).cast("date") for day in RECENT_WINDOW)
    kept = scenes.where((F.col("sensor") == "S2") & clear_enough() & in_window(F.col("ts"), first, last))
    return many_medians(kept, ROLES, ["pixel_id"])


def dated_composite(windows: DataFrame, scenes: DataFrame) -> DataFrame:
    """Per pixel and distinct window the median of each band.

    ``windows`` is ``(pixel_id, start_year, end_year, sensor)``. A window meets only the scenes of its own pixel and
    sensor. Scenes are dealt by these, once each, before they are repeated for their windows, so that no buffer of a
    median is moved.
    """
    keys = ["pixel_id", "sensor"]
    clear = scenes.where(clear_enough()).select(*keys, "ts", *ROLES).repartition(*keys)
    return many_medians(scenes_in_windows(windows, clear, keys), ROLES, ["pixel_id", *WINDOW])


def satellite_features(
    points: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    radius_m: float = RADIUS_M,
) -> DataFrame:
    """``points`` ``(ID, Latitude, Longitude, start_year, end_year)`` to one wide row per id.

    ``scenes``: ``(pixel_id, sensor, ts, cloud_pct, bands by role)``; ``pixels``:
    ``(pixel_id, Latitude, Longitude)``. Work is done per distinct place and window and
    handed to the points at the end. A composite may have
    ``quantiles.MOST`` scenes, far more than one a day; more are an error. Means are not weighted by edge coverage.
    """
    nowhere = any_of([F.col(c).isNull() for c in PLACE])
    dated = points.where(~nowhere).withColumn("sensor", sensor_for_year(F.col("start_year")))
    sites = dated.select(*PLACE).distinct()
    near = stored(within_radius(sites, pixels, radius_m).drop("distance_m"), "near-pixels")

    recent = near.join(recent_composite(scenes), "pixel_id")
    out = dated.join(site_means(recent, "S2", "s2_recent_", PLACE), PLACE, "left")

    pairs = stored(dated.select(*PLACE, *WINDOW).na.drop().distinct().join(near, PLACE), "window-pixels")
    composed = stored(
        dated_composite(pairs.select("pixel_id", *WINDOW).distinct(), scenes), "dated-composites"
    )
    matched = pairs.join(composed, ["pixel_id", *WINDOW])
    names = {s: sensor_features(s, {role: F.col(role) for role in ROLES}) for s in ("S2", "L8", "L7")}
    means = matched.groupBy(*PLACE, *WINDOW).agg(
        *[
            F.avg(F.when(F.col("sensor") == s, c)).alias(f"{s.lower()}_contemp_{name}")
            for s, named in names.items()
            for name, c in named.items()
        ]
    )
    found = out.join(means, [*PLACE, *WINDOW], "left").select("ID", *feature_names())
    # Points without a place have no features; they bypass the joins instead of meeting on a null key.
    return found.unionByName(points.where(nowhere).select("ID"), allowMissingColumns=True)


def feature_names() -> list[str]:
    contemporaneous = [f"{s.lower()}_contemp_{n}" for s in ("S2", "L8", "L7") for n in sensor_names(s)]
    return [f"s2_recent_{n}" for n in sensor_names("S2")] + contemporaneous
