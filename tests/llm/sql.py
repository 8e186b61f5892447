"""Runs a query next to its SQL on DuckDB."""

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()


def same_rows(frame, sql, folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(map(repr, cursor.fetchall()))
    got = sorted(repr(tuple(r)) for r in frame.select(names).collect())
    assert got == want
    return len(got)
