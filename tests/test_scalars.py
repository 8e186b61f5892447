"""Hand-written cases for scalar functions: null, blank, broken, boundary."""

import math

import pytest
from pyspark.sql import functions as F

from loamfold.functions import chemistry, coords, dates, depth, documents, nulls, spectral


def evaluate(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row["out"] for row in df.orderBy("i").select(fn(F.col("v")).alias("out")).collect()]


DEPTHS = ["0-20", "0 - 20", "30", "", None, "abc", "20-", "1.5-2.5", "0-20-50", "-5-10", "1d-2"]


def test_depth_midpoints(spark):
    split = evaluate(spark, DEPTHS, "string", depth.midpoint_split)
    assert split == [10.0, 10.0, None, None, None, None, None, 2.0, 10.0, None, None]
    regex = evaluate(spark, DEPTHS, "string", depth.midpoint_regex)
    assert regex == [10.0, 10.0, 30.0, None, None, None, 20.0, 2.0, 10.0, 7.5, 1.5]


def test_depth_bounds(spark):
    upper = evaluate(spark, DEPTHS, "string", lambda c: depth.bounds(c)[0])
    lower = evaluate(spark, DEPTHS, "string", lambda c: depth.bounds(c)[1])
    assert upper == [0.0, 0.0, None, None, None, None, 20.0, 1.5, 0.0, None, None]
    assert lower == [20.0, 20.0, None, None, None, None, None, 2.5, 20.0, 5.0, 2.0]


def test_depth_flags_of_missing_are_zero(spark):
    for profile in ("split", "regex"):
        for side in (0, 1):
            got = evaluate(spark, [None], "double", lambda c, p=profile, s=side: depth.depth_flags(c, p)[s])
            assert got == [0]
    assert evaluate(spark, [20.0, 15.0, 15.5, 30.0, 30.5], "double", lambda c: depth.depth_flags(c, "split")[0]) == [1, 1, 1, 0, 0]
    assert evaluate(spark, [20.0, 15.0, 15.5, 30.0, 30.5], "double", lambda c: depth.depth_flags(c, "regex")[1]) == [0, 0, 0, 0, 1]


def test_dates(spark):
    texts = ["13/02/2015", "3/2/2015", "2015-02-03", "3-2-2015", "broken", "31/02/2015", "", None]
    got = [d.isoformat() if d else None for d in evaluate(spark, texts, "string", dates.parse_dayfirst)]
    assert got == ["2015-02-13", "2015-02-03", "2015-02-03", "2015-02-03", None, None, None, None]
    years = evaluate(spark, ["12/03/2016", " 2014 ", "n/a", "", None], "string", lambda c: dates.trailing_year(c, 2013))
    assert years == [2016, 2014, 2013, 2013, 2013]
    assert evaluate(spark, [1999, 2010, 2024, None], "int", dates.decade) == [1990, 2010, 2020, 2010]
    assert evaluate(spark, [3, 6, 11, None], "int", dates.wet_season) == [1, 0, 1, 0]


def test_numbers_as_text(spark):
    texts = ["7.1", "", "n/a", None, " 2 ", "1e3", "nan", "1d", "-.5", "inf"]
    assert evaluate(spark, texts, "string", nulls.to_number) == [7.1, None, None, None, 2.0, 1000.0, None, None, -0.5, None]


def test_blocks_round_down(spark):
    got = evaluate(spark, [0.0, 0.5, 0.49, -0.3, -0.5, -0.51, None], "double", coords.block_number)
    assert got == [0, 1, 0, -1, -1, -2, None]
    df = spark.createDataFrame([(-0.3, 33.8), (None, 1.0)], "a double, b double")
    keys = [r["k"] for r in df.select(coords.block_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert keys == ["-1_67", None]


def test_rounded_key_is_half_even(spark):
    assert evaluate(spark, [2.00005, -1.39284, 0.00004], "double", coords.rounded_key) == [20000, -13928, 0]


def test_clip_keeps_missing(spark):
    assert evaluate(spark, [-1.0, 0.0, 2.0, None], "double", nulls.clip_lower) == [0.0, 0.0, 2.0, None]


def test_log_round_trip(spark):
    values = [0.0, 0.5, 12.25, 490.0, None]
    got = evaluate(spark, values, "double", lambda c: nulls.from_log(nulls.log_positive(c)))
    assert got[-1] is None
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[:-1], values[:-1]))


def test_ratio_with_zero_denominator_is_finite(spark):
    assert evaluate(spark, [0.0], "double", lambda c: nulls.padded_ratio(F.lit(1.0), c)) == [pytest.approx(1e6)]
    assert evaluate(spark, [-1e-6], "double", lambda c: nulls.padded_ratio(F.lit(1.0), c)) == [None]


def test_chemistry_null_rules(spark):
    df = spark.createDataFrame([(1, "6.0", None, 2.0)], "ID int, ph string, C_organic double, C_total double")
    coerced = chemistry.coerced_chemistry(df)
    assert coerced.columns[-1] == "electrical_conductivity"
    split = coerced.select(*[c.alias(n) for n, c in chemistry.interactions("split").items()]).first()
    regex = coerced.select(*[c.alias(n) for n, c in chemistry.interactions("regex").items()]).first()
    assert split["C_org_x_ph"] is None and split["log_C_organic"] is None
    assert regex["ph_x_Corg"] == 0.0 and regex["C_inorganic"] == 2.0


def test_indices_with_zero_denominator_are_null(spark):
    bands = {role: F.lit(0.0) for role in ("blue", "green", "red", "nir", "nir_narrow", "swir1", "swir2")}
    row = spark.range(1).select(*[c.alias(n) for n, c in spectral.sensor_features("S2", bands).items()]).first()
    assert row["NDVI"] is None and row["ClayRatio"] is None and row["SAVI"] == 0.0
    assert list(row.asDict()) == spectral.sensor_names("S2")


DOCUMENT = (
    '{"properties": {"layers": [{"name": "clay", "unit_measure": {"d_factor": 10}, "depths": ['
    '{"label": "0-5cm", "values": {"mean": 120}}, {"label": "5-15 cm", "values": {"mean": null}},'
    '{"label": "0-5cm", "values": {"mean": 130}}]}, {"name": "sand", "unit_measure": {"d_factor": 0}, "depths": ['
    '{"label": "0-5cm", "values": {"mean": 7}}]}, {"name": "silt"}]}}'
)


def test_documents(spark):
    texts = [DOCUMENT, "null", "{}", '{"properties": {"lay', '{"other": 1}', None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "ID int, text string")
    rows = documents.with_flattened(df, "text", "regex").orderBy("ID").collect()
    assert rows[0]["sg_clay_0-5cm"] == 13.0
    assert rows[0]["sg_clay_5-15cm"] is None
    assert rows[0]["sg_sand_0-5cm"] == 7.0
    assert rows[0]["sg_silt_0-5cm"] is None
    for row in rows[1:]:
        assert all(row[n] is None for n in documents.feature_names("regex"))
    raw = documents.with_flattened(df, "text", "split").orderBy("ID").first()
    assert raw["sg_clay_0-5cm"] == 130.0
