import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamfold.llm import vector_codes
from loamfold.llm.vector_codes import compressed, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 16), st.integers(1, 9), st.integers(1, 40), st.integers(0, 2**32 - 1), st.sampled_from([2, 50, 1 << 24]))
def test_search_is_that_over_all_entries(entries, size, points, seed, spread):
    draw = np.random.default_rng(seed)
    book = draw.integers(-spread, spread, (entries, size))
    rows = draw.integers(-spread, spread, (points, size))
    rows[: min(points, entries)] = book[: min(points, entries)]
    found, distance = nearest(rows, book)
    all_of = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    assert found.tolist() == all_of.argmin(axis=1).tolist()  # the first of equal ones
    assert distance.tolist() == all_of.min(axis=1).tolist()


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain integers; rows whose vector may be used, in order of their id."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}, ""
    size = len(kept[0][1]) // parts
    cut = [(i, [v[p * size : (p + 1) * size] for p in range(parts)]) for i, v in kept]
    books = [[list(v[p]) for _, v in cut[:entries]] for p in range(parts)]

    def near(part, p):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[near(v[p], p)[1] for p in range(parts)] for _, v in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for (_, v), c in zip(cut, chosen, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    codes = [(i, "".join(f"{near(v[p], p)[1]:02x}" for p in range(parts)), sum(near(v[p], p)[0] for p in range(parts))) for i, v in cut]
    return codes, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def shown(rows, books):
    found = rows.select("vec_id", F.lower(F.hex("code")), "error").collect()
    return sorted(map(tuple, found), key=repr), books.digest()


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_integers(spark, seed):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(0, (0.3, 0.001)[seed % 2], 24).astype("f4").tolist(), int(draw.integers(4))) for i in draw.permutation(120).tolist()]
    rows += [(200, None, 1), (201, [None] + [0.5] * 23, 1), (202, [math.nan] * 24, 1), (203, [math.inf] + [0.5] * 23, 2), (204, [-math.inf] * 24, None)]
    rows += [(None, rows[0][1], None), rows[3], rows[3], (7, rows[5][1], None)]
    got = shown(*compressed(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    codes, digest = brute(rows)
    assert got == (sorted(codes, key=repr), digest)


def test_few_rows_and_none(spark):
    some = spark.createDataFrame([(4, [0.5] * 8, None), (2, [-0.25] * 8, 3), (9, [0.4] * 8, 3)], SCHEMA)
    rows, books = compressed(some)
    assert books.entries.shape == (8, 3, 1)
    assert shown(rows, books)[0] == [(2, "00" * 8, 0), (4, "01" * 8, 0), (9, "02" * 8, 0)]
    rows, books = compressed(some.limit(0))
    assert rows.count() == 0 and rows.columns == ["vec_id", "label", "code", "error"] and books.digest() == hashlib.sha256(b"").hexdigest()
    assert compressed(some.where("false").union(spark.createDataFrame([(1, None, 1)], SCHEMA)))[0].count() == 0


def test_other_lengths_large_components_and_clashes(spark):
    mixed = spark.createDataFrame([(1, [0.5] * 8, 0), (2, [0.5] * 16, 0), (3, [], 0)], SCHEMA)
    assert sorted(map(tuple, compressed(mixed)[0].select("vec_id", "error").collect())) == [(1, 0), (2, None), (3, None)]
    assert [r.error for r in compressed(mixed.where("vec_id = 3"))[0].collect()] == [0]
    with pytest.raises(ValueError, match="equal parts"):
        compressed(spark.createDataFrame([(1, [0.5] * 9, 0)], SCHEMA))
    with pytest.raises(Exception, match="8192 or more"):
        compressed(spark.createDataFrame([(1, [1e30] * 8, 0)], SCHEMA))
    for name in ("code", "error", "whole"):
        with pytest.raises(ValueError, match=name):
            compressed(mixed.withColumnRenamed("label", name))


def test_codes_stand_for_their_entries(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(0, 0.3, 16).astype("f4").tolist(), 0) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    coded, books = compressed(frame)
    back = coded.select("vec_id", "error", vector_codes.decoded(F.col("code"), books).alias("near")).collect()
    for r in back:
        assert sum((math.floor(4096 * x) - y) ** 2 for x, y in zip(rows[r.vec_id][1], r.near, strict=True)) == r.error
