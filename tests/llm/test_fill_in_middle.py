import hashlib
import re

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from loamfold.llm.fill_in_middle import RankIndex, fill_in_middle, line_bounds, restored


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=200), st.sampled_from([1, 3, 50, 1024]))
def test_the_index_is_exact_and_its_segments_keep_the_error(lengths, error):
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    index = RankIndex.fit(bounds, error)
    assert index.at(np.arange(len(bounds))).tolist() == bounds.tolist()
    assert np.abs(index.residual).max() <= error + 1
    assert len(index.first) <= len(bounds) and index.first[0] == 0


def test_segments_are_as_long_as_they_can_be():
    bounds = np.arange(0, 80 * 10_000, 80)
    assert len(RankIndex.fit(bounds, 1).first) == 1
    bent = np.concatenate([bounds, bounds[-1] + np.arange(7, 7 * 5000, 7)])
    assert len(RankIndex.fit(bent, 4).first) == 2
    with pytest.raises(ValueError, match="error"):
        RankIndex.fit(bounds, 1 << 15)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\n\r é😀", max_size=60))
@example("\n")
@example("\n\na")
def test_bounds_are_those_of_the_pattern(text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert line_bounds(text).tolist() == [0, *np.cumsum([len(u) for u in units], dtype=np.int64).tolist()]


def brute(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["", None, "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "x <P> y\nz\n", "<S", "<\n<\nS>\n<S\n>", "<S<P\nS>M>\n", "é😀\nñ\n", "\r\n\r\n", "line\n" * 50_000, "w " * 200_000, "> <\n" * 30]


def test_odd_texts_against_brute_force(spark):
    rows = [(i, t, "tie") for i, t in enumerate(ODD * 8)] + [(None, "a\nb\nc", None), (5, "same\nrow\n", "x"), (5, "same\nrow\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = fill_in_middle(docs).withColumn("back", restored_column()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert len(got) == len(rows)
    for row, (doc_id, text, note) in zip(sorted(got, key=key), sorted(rows, key=key), strict=True):
        assert (row.doc_id, row.text, row.note) == (doc_id, text, note)
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == brute(doc_id, text)
        assert row.back == (text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def restored_column():
    from pyspark.sql import functions as F

    return restored(F.col("output"), F.col("form"))


def test_rates_and_index(spark):
    docs = spark.createDataFrame([(i, "a\nbb\nccc\n" * (i % 7 + 1)) for i in range(400)], "doc_id long, text string")
    got = fill_in_middle(docs, rate=60, suffix_first=25, error=2, with_index=True).collect()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text, 60, 25)
        index = RankIndex(np.array([s.rank for s in r.segments]), np.array([s.offset for s in r.segments]), np.array([s.slope for s in r.segments]), np.frombuffer(r.residuals, "<i2"))
        assert index.at(np.arange(r.n + 1)).tolist() == line_bounds(r.text).tolist()


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", 3)], "doc_id long, text string, n long")
    assert fill_in_middle(docs.limit(0), keep=["doc_id"]).count() == 0
    assert fill_in_middle(docs, keep=["doc_id"]).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    with pytest.raises(ValueError, match="'n'"):
        fill_in_middle(docs)
