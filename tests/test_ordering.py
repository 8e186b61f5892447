"""Global order, ranks and codes against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loamfold.operators import correlation, ordering


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_row_index(spark, parts):
    ids = [f"id{i * 37 % 501:04d}" for i in range(501)]
    df = spark.createDataFrame([(x,) for x in ids], "ID string").repartition(5)
    got = {r["ID"]: r["row_index"] for r in ordering.with_row_index(df, ["ID"], parts=parts).collect()}
    assert got == {x: i for i, x in enumerate(sorted(ids))}


def test_average_ranks(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 400), "v": rng.integers(0, 9, 400).astype(float)})
    pdf.loc[pdf.index[:250], "k"] = 1
    df = spark.createDataFrame(pdf)
    got = {(r["k"], r["v"]): r["rank"] for r in ordering.average_ranks(df, ["k"], "v", parts=5).collect()}
    pdf["rank"] = pdf.groupby("k")["v"].rank()
    want = {(k, v): r for k, v, r in pdf[["k", "v", "rank"]].itertuples(index=False)}
    assert got == want


def test_codes_sort_as_text(spark):
    df = spark.createDataFrame([("2",), ("10",), ("1",), ("2",), (None,)], "c string")
    assert {r["c"]: r["code"] for r in ordering.label_codes(df, "c").collect()} == {"1": 0, "10": 1, "2": 2}


def test_latest_and_first(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, 2, "b"), (2, 5, "z")], "ID int, seq int, v string")
    latest = {r["ID"]: (r["seq"], r["v"]) for r in ordering.latest_per_key(df, "ID", "seq").collect()}
    first = {r["ID"]: (r["seq"], r["v"]) for r in ordering.first_per_key(df, "ID", "seq").collect()}
    assert latest == {1: (3, None), 2: (5, "z")}
    assert first == {1: (1, "a"), 2: (5, "z")}


def test_spearman_and_pearson(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"ID": range(n), "a": rng.integers(0, 20, n) * 1.0, "b": rng.random(n), "flat": 1.0})
    pdf["c"] = pdf["a"] ** 2 + rng.random(n)
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "b"] = np.nan
    pdf["void"] = np.nan
    names = ["a", "b", "c", "flat", "void"]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "ID long, a double, b double, flat double, c double, void double")
    for method, rows in (("spearman", correlation.spearman(df, names, parts=3)), ("pearson", correlation.pearson(df, names))):
        want = pdf[names].corr(method=method)
        seen = 0
        for r in rows.collect():
            expected = want.loc[r["x_name"], r["y_name"]]
            seen += 1
            if np.isnan(expected):
                assert r["r"] is None
            else:
                assert r["r"] == pytest.approx(expected, abs=1e-9)
        assert seen == (15 if method == "spearman" else 10)


def test_batches(spark):
    df = spark.range(250).withColumnRenamed("id", "ID")
    sizes = {r["batch_id"]: r["n"] for r in ordering.with_batches(df, ["ID"], 100).groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}


def test_pearson_blocks_with_gaps_and_constants(spark):
    """Large offsets, missing values, columns without spread (in all rows, or in those of one pair), empty columns and tables."""
    draw = np.random.default_rng(7)
    n = 3000
    a = 1e6 + draw.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + draw.normal(size=n), "c": draw.normal(size=n), "k": np.full(n, 0.1), "h": np.where(np.arange(n) % 2, 0.3, draw.normal(size=n)), "e": np.full(n, np.nan)})
    pdf.loc[draw.random(n) < 0.3, "b"] = np.nan
    pdf.loc[np.arange(n) % 2 == 0, "c"] = np.nan  # where c is present, h is constant
    names = list(pdf.columns)
    rows = [tuple(None if v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    want = pdf.corr()
    got = {(r.x_name, r.y_name): r.r for r in correlation.pearson(df, names).collect()}
    assert len(got) == 15
    for (x, y), r in got.items():
        if "k" in (x, y) or "e" in (x, y) or {x, y} == {"c", "h"}:
            assert r is None
        else:
            assert abs(r - want.loc[x, y]) < 1e-9
    assert [r.r for r in correlation.pearson(df.limit(0), ["a", "b"]).collect()] == [None]
