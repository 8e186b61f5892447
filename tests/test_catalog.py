"""Every query with a SQL counterpart returns the same rows as the other engine."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def as_set(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_matches_other_engine(spark, duck, folder, name):
    result = entry_module.queries()[name](spark, folder)
    expected = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = as_set(result.collect(), result.columns)
    want = as_set(expected.fetchall(), expected.columns)
    assert len(got) == len(want)
    assert got == want


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 8
    assert {r["Depth_cm"] for r in rows} >= {"0-20", "20-50", None}
