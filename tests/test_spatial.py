"""Radius join against brute force, also across the date line and near the poles."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamfold.operators import spatial
from loamfold.plans import satellite


def haversine(a, b):
    (la, lo), (lb, lp) = (map(math.radians, p) for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371008.8 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("lat,lon", [(0.0, 0.0), (-35.0, 20.0), (64.0, 179.999), (-64.0, -179.999), (84.9, 10.0), (89.95, 0.0), (89.9999, 77.0), (-89.9999, 3.0)])
def test_radius_join_equals_brute_force(spark, lat, lon):
    rng = np.random.default_rng(1)
    spread_lat = 0.02
    spread_lon = min(0.02 / max(math.cos(math.radians(lat)), 1e-4), 170.0)

    def cloud(n):
        lats = np.clip(lat + (rng.random(n) - 0.5) * spread_lat, -90, 90)
        lons = (lon + (rng.random(n) - 0.5) * spread_lon + 180) % 360 - 180
        return list(zip(lats.tolist(), lons.tolist()))

    sites, pixels = cloud(40), cloud(60)
    s = spark.createDataFrame([(i, *p) for i, p in enumerate(sites)], "site int, Latitude double, Longitude double")
    p = spark.createDataFrame([(i, *q) for i, q in enumerate(pixels)], "pixel_id int, Latitude double, Longitude double")
    rows = spatial.within_radius(s, p, 500.0).collect()
    got = sorted((r["site"], r["pixel_id"]) for r in rows)
    want = sorted((i, j) for i, a in enumerate(sites) for j, b in enumerate(pixels) if haversine(a, b) <= 500.0)
    assert got == want
    assert want


def test_window_end_is_excluded(spark):
    start, end = spatial.year_window(F.lit(2020), F.lit(2020))
    df = spark.sql("select explode(array(date'2019-12-31', date'2020-01-01', date'2020-12-30', date'2020-12-31')) as ts")
    kept = [r["ts"].isoformat() for r in df.where(spatial.in_window(F.col("ts"), start, end)).collect()]
    assert kept == ["2020-01-01", "2020-12-30"]


def test_nearest_centre(spark):
    centres = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 0.0, 10.0)], "cluster int, c_lat double, c_lon double")
    df = spark.createDataFrame([(1.0, 1.0), (9.0, 1.0), (5.0, 0.0), (None, 1.0)], "Latitude double, Longitude double")
    rows = spatial.nearest_centre(df, centres, F.col("Latitude"), F.col("Longitude")).collect()
    assert [r["cluster"] for r in rows] == [0, 1, 0, None]
    assert rows[2]["centre_distance"] == 5.0


def test_raster_cells_and_nodata(spark):
    cells = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 1, -9.0), ("b", 0, 0, 5.0)], "layer string, row long, col long, value double")
    points = spark.createDataFrame([(1, 9.5, 0.5), (2, 9.5, 1.5), (3, 3.0, 3.0), (4, None, 1.0)], "ID int, Latitude double, Longitude double")
    out = spatial.raster_values(points, cells, ["a", "b"], (10.0, 0.0), (1.0, 1.0), -9.0)
    got = {r["ID"]: (r["wc_a"], r["wc_b"]) for r in out.collect()}
    assert got == {1: (1.0, 5.0), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_composites_equal_a_plain_join(tables):
    from loamfold.catalog.join_queries import dated_points
    from loamfold.functions.spectral import sensor_for_year
    from loamfold.plans.satellite import ROLES, WINDOW, clear_enough, dated_composite

    points, scenes = dated_points(tables), tables.view("scenes")
    windows = points.select(F.col("site").alias("pixel_id"), "start_year", "end_year", sensor_for_year(F.col("start_year")).alias("sensor")).na.drop().distinct()
    start, end = spatial.year_window(F.col("start_year"), F.col("end_year"))
    plain = windows.join(scenes.where(clear_enough()), ["pixel_id", "sensor"]).where(spatial.in_window(F.col("ts"), start, end))
    want = plain.groupBy("pixel_id", *WINDOW).agg(*[F.median(c).alias(c) for c in ROLES])
    got = dated_composite(windows, scenes)
    round_off = lambda df: df.select("pixel_id", *WINDOW, *[F.round(c, 9).alias(c) for c in ROLES])
    assert want.count() > 0
    assert round_off(want).exceptAll(round_off(got)).isEmpty() and round_off(got).exceptAll(round_off(want)).isEmpty()


def test_windows_meet_their_scenes_and_medians_are_not_moved(spark):
    windows = [("p", "S2", 2015, 2016), ("p", "S2", 2016, 2016), ("p", "S2", 2017, 2016), ("p", "L8", 2015, 2015), ("q", "S2", None, 2016), (None, "S2", 2015, 2016)]
    days = ["2014-12-31", "2015-01-01", "2015-12-31", "2016-01-01", "2016-12-30", "2016-12-31"]
    scenes = [(p, s, datetime.date.fromisoformat(d), 0, *([float(i)] * len(satellite.ROLES))) for p in ("p", "q", None) for s in ("S2", "L8") for i, d in enumerate(days)]
    some = spark.createDataFrame(windows, "pixel_id string, sensor string, start_year int, end_year int")
    all_scenes = spark.createDataFrame(scenes, "pixel_id string, sensor string, ts date, cloud_pct long, " + ", ".join(f"{r} double" for r in satellite.ROLES))
    met = spatial.scenes_in_windows(some, all_scenes, ["pixel_id", "sensor"])
    found = sorted((r["sensor"], r["start_year"], r["end_year"], r["ts"].isoformat()) for r in met.collect())
    assert found == sorted([*[("S2", 2015, 2016, d) for d in days[1:5]], *[("S2", 2016, 2016, d) for d in days[3:5]], ("L8", 2015, 2015, days[1])])
    composed = satellite.dated_composite(some, all_scenes)
    assert {(r["sensor"], r["start_year"]): r["red"] for r in composed.collect()} == {("S2", 2015): 2.5, ("S2", 2016): 3.5, ("L8", 2015): 1.0}
    plan = composed._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "start_year" in line]
