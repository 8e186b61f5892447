"""Exact quantiles: the bracket path against numpy, on awkward groups."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loamfold.operators import quantiles

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def groups():
    rng = np.random.default_rng(3)
    hot = rng.lognormal(3, 2, 6000)
    return {
        "hot": hot,
        "ties": rng.integers(0, 4, 3000).astype(float),
        "mostly_zero": np.where(rng.random(3000) < 0.9, 0.0, rng.random(3000)),
        "constant": np.full(1000, 7.5),
        "narrow": 1e6 + rng.random(2000) * 1e-3,
        "negative": -rng.random(900) * 100,
        "pair": np.array([1.0, 2.0]),
        "single": np.array([3.0]),
        "empty": np.array([np.nan, np.nan]),
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(k, None if np.isnan(v) else float(v)) for k, vs in groups().items() for v in vs]
    rows += [(None, float(v)) for v in range(11)]
    return spark.createDataFrame(rows, "k string, v double").repartition(6)


@pytest.mark.parametrize("accuracy", [50, 200, 10_000])
def test_bracket_path_equals_numpy(frame, accuracy):
    out = quantiles.exact_quantiles(frame, ["v"], FRACTIONS, ["k"], accuracy=accuracy)
    got = {row["k"]: row for row in out.collect()}
    assert len(got) == len(groups()) + 1
    for name, values in {**groups(), None: np.arange(11.0)}.items():
        values = values[~np.isnan(values)]
        assert got[name]["n"] == len(values)
        for i, fraction in enumerate(FRACTIONS):
            if len(values) == 0:
                assert got[name][f"q{i}"] is None
            else:
                assert got[name][f"q{i}"] == pytest.approx(np.quantile(values, fraction), rel=1e-12, abs=1e-12)


def test_equals_the_built_in_function(frame):
    exact = quantiles.exact_quantiles(frame, ["v"], FRACTIONS, ["k"], accuracy=50)
    plain = frame.groupBy("k").agg(F.count(F.nanvl("v", F.lit(None))).alias("n"), F.percentile(F.nanvl("v", F.lit(None)), FRACTIONS).alias("q"))
    order = lambda df: sorted(df.collect(), key=lambda r: str(r["k"]))
    for a, b in zip(order(exact), order(plain)):
        assert a["k"] == b["k"] and a["n"] == b["n"]
        assert [a[f"q{i}"] for i in range(len(FRACTIONS))] == pytest.approx(b["q"]) if b["q"] is not None else a["q3"] is None


def test_medians_without_keys(frame):
    row = quantiles.exact_medians(frame, ["v"], accuracy=50).collect()
    values = np.concatenate([*groups().values(), np.arange(11.0)])
    assert len(row) == 1
    assert row[0]["v"] == pytest.approx(np.nanmedian(values))


def test_partitions_do_not_matter(frame):
    many = quantiles.exact_medians(frame.repartition(13), ["v"], ["k"], accuracy=50)
    one = quantiles.exact_medians(frame.coalesce(1), ["v"], ["k"], accuracy=50)
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))


def test_many_medians_equal_numpy(frame):
    got = {r["k"]: r["v"] for r in quantiles.many_medians(frame, ["v"], ["k"]).collect()}
    want = {**groups(), None: np.arange(11.0)}
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k] is None if np.isnan(values).all() else got[k] == pytest.approx(np.nanmedian(values))


def test_many_medians_refuse_a_group_beyond_their_bound(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", 2.0), ("b", None)], "k string, v double")
    assert {r["k"]: r["v"] for r in quantiles.many_medians(df, ["v"], ["k"], most=3).collect()} == {"a": 2.0, "b": 1.5}
    with pytest.raises(PySparkException, match="a group has 3 rows, more than 2"):
        quantiles.many_medians(df, ["v"], ["k"], most=2).collect()
