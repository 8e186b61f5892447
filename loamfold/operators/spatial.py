"""Joins of points to documents, raster cells, pixels within a radius, date windows and centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.functions.coords import DEGREE_M, great_circle_m, rounded_key

MAX_CENTRES = 1000


def with_rounded_keys(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    return df.withColumns({"lat_key": rounded_key(F.col(lat)), "lon_key": rounded_key(F.col(lon))})


def _spread_missing(df: DataFrame, first: str, second: str, by: str) -> DataFrame:
    """Keys that match nothing for rows without a place, different ones, so they do not all meet in one task."""
    missing = F.col(first).isNull() | F.col(second).isNull()
    return df.withColumns(
        {
            first: F.when(missing, F.xxhash64(by)).otherwise(F.col(first)),
            second: F.when(missing, F.lit(None).cast("bigint")).otherwise(F.col(second)),
        }
    )


def documents_at(points: DataFrame, documents: DataFrame, key: str = "ID") -> DataFrame:
    """Left join on coordinates rounded to four decimals; ``documents`` has ``lat_key, lon_key``."""
    keyed = _spread_missing(with_rounded_keys(points), "lat_key", "lon_key", key)
    return keyed.join(documents, ["lat_key", "lon_key"], "left").drop("lat_key", "lon_key")


def raster_values(
    points: DataFrame,
    cells: DataFrame,
    layers: Sequence[str],
    origin: tuple[float, float],
    step: tuple[float, float],
    nodata: float,
    prefix: str = "wc_",
    key: str = "ID",
) -> DataFrame:
    """Value of each layer in the cell a point falls into; ``(lat0, lon0)`` is the upper left corner.

    ``cells`` is long ``(layer, row, col, value)``. The layers are brought side by
    side first, so the points are joined, and shuffled, once.
    """
    lat0, lon0 = origin
    dlat, dlon = step
    wide = cells.groupBy("row", "col").agg(
        *[
            F.max(F.when(F.col("layer") == layer, F.nullif(F.col("value"), F.lit(nodata)))).alias(f"{prefix}{layer}")
            for layer in layers
        ]
    )
    located = points.withColumns(
        {
            "row": F.floor((F.lit(lat0) - F.col("Latitude")) / F.lit(dlat)).cast("bigint"),
            "col": F.floor((F.col("Longitude") - F.lit(lon0)) / F.lit(dlon)).cast("bigint"),
        }
    )
    located = _spread_missing(located, "row", "col", key)
    return located.join(wide, ["row", "col"], "left").select(*points.columns, *[f"{prefix}{x}" for x in layers])


def _grid_row(lat: Column, size: float) -> Column:
    return F.floor(lat / F.lit(size)).cast("bigint")


def _row_cells(row: Column, size: float) -> Column:
    """Number of equal cells around a grid row, each at least as wide as ``size`` degrees of latitude."""
    farthest = (F.greatest(F.abs(row), F.abs(row + 1)) + 1) * F.lit(size)
    shrink = F.when(farthest < 89.9, F.cos(F.radians(farthest))).otherwise(F.lit(0.0))
    return F.greatest(F.floor(F.lit(360.0 / size) * shrink), F.lit(1)).cast("bigint")


def _grid_column(lon: Column, cells: Column) -> Column:
    return F.floor((lon + F.lit(180.0)) * cells / F.lit(360.0)).cast("bigint")


def within_radius(sites: DataFrame, pixels: DataFrame, radius_m: float, pixel_key: str = "pixel_id") -> DataFrame:
    """Pixels within ``radius_m`` of each site: all site columns, the pixel key and ``distance_m``.

    Sites and pixels (``Latitude, Longitude`` each) meet in grid cells no
    narrower than the radius at any latitude, also across the date line: each site
    visits its own cell and the eight around it, so the join is a plain equi-join
    and only pairs that are already close are measured. Give it distinct places,
    not one row per sample.
    """
    size = 1.01 * radius_m / DEGREE_M
    own_row = _grid_row(F.col("Latitude"), size)
    around = []
    for di in (-1, 0, 1):
        row = own_row + di
        cells = _row_cells(row, size)
        for dj in (-1, 0, 1):
            column = F.pmod(_grid_column(F.col("Longitude"), cells) + dj, cells)
            around.append(F.struct(row.alias("ci"), column.alias("cj")))
    visiting = sites.select("*", F.explode(F.array_distinct(F.array(*around))).alias("_cell"))
    pixel_row = _grid_row(F.col("Latitude"), size)
    pixel_cells = _row_cells(pixel_row, size)
    placed = pixels.select(
        pixel_key,
        F.col("Latitude").alias("_plat"),
        F.col("Longitude").alias("_plon"),
        F.struct(
            pixel_row.alias("ci"),
            F.pmod(_grid_column(F.col("Longitude"), pixel_cells), pixel_cells).alias("cj"),
        ).alias("_cell"),
    )
    distance = great_circle_m(F.col("Latitude"), F.col("Longitude"), F.col("_plat"), F.col("_plon"))
    return (
        visiting.join(placed, "_cell")
        .withColumn("distance_m", distance)
        .where(F.col("distance_m") <= radius_m)
        .select(*sites.columns, pixel_key, "distance_m")
    )


def in_window(ts: Column, start: Column, end: Column) -> Column:
    """Start included, end excluded."""
    return (ts >= start) & (ts < end)


def year_window(start_year: Column, end_year: Column) -> tuple[Column, Column]:
    """From 1 January of the start year to 31 December of the end year."""
    return F.make_date(start_year, F.lit(1), F.lit(1)), F.make_date(end_year, F.lit(12), F.lit(31))


def scenes_in_windows(windows: DataFrame, scenes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each window ``(*keys, start_year, end_year, …)`` with its scenes ``(*keys, ts, …)``.

    The windows of a key, of which there are no more than pairs of years where they are distinct, meet its scenes as one
    list, and a scene is repeated only for those it lies in. Groups that hold all keys need no shuffle of the result.
    """
    keys = list(keys)
    named = [c for c in windows.columns if c not in keys]
    first, end = year_window(F.col("start_year"), F.col("end_year"))
    listed = windows.groupBy(*keys).agg(F.collect_list(F.struct(*named, first.alias("_first"), end.alias("_end"))).alias("_windows"))
    met = scenes.join(listed, keys).withColumn("_windows", F.filter("_windows", lambda w: in_window(F.col("ts"), w["_first"], w["_end"])))
    found = met.withColumn("_window", F.explode("_windows"))
    return found.select(*keys, *[F.col("_window")[c].alias(c) for c in named], *[c for c in scenes.columns if c not in keys])


def centre_list(centres: DataFrame) -> list[tuple[int, float, float]]:
    """Fitted centres as model parameters: k rows, where k is chosen by the caller and checked here."""
    rows = centres.select("cluster", "c_lat", "c_lon").limit(MAX_CENTRES + 1).collect()
    if len(rows) > MAX_CENTRES:
        raise ValueError(f"more than {MAX_CENTRES} centres")
    return sorted((row["cluster"], row["c_lat"], row["c_lon"]) for row in rows)


def nearest_centre(
    df: DataFrame, centres: DataFrame | list[tuple[int, float, float]], lat: Column, lon: Column
) -> DataFrame:
    """Add ``cluster`` and ``centre_distance`` (degrees) of the nearest centre, ties to the lower number.

    Both are NULL for a missing coordinate. The centres are written into the
    expression, so the assignment is generated code without a join.
    """
    listed = centres if isinstance(centres, list) else centre_list(centres)

    def candidate(number: int, c_lat: float, c_lon: float) -> str:
        dlat, dlon = f"(_lat - ({c_lat!r}D))", f"(_lon - ({c_lon!r}D))"
        return f"named_struct('d', {dlat} * {dlat} + {dlon} * {dlon}, 'k', {number})"

    candidates = [candidate(*centre) for centre in listed]
    smallest = F.expr(f"least({', '.join(candidates)})" if len(candidates) > 1 else candidates[0])
    placed = df.withColumns({"_lat": lat.cast("double"), "_lon": lon.cast("double")})
    known = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    best = placed.withColumn("_best", F.when(known, smallest))
    named = best.withColumns({"cluster": F.col("_best.k"), "centre_distance": F.sqrt(F.col("_best.d"))})
    return named.drop("_best", "_lat", "_lon")
