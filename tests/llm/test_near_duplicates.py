import random
import re

import numpy as np
import pytest

from loamfold.llm import queries
from loamfold.llm.components import components
from loamfold.llm.near_duplicates import near_duplicates, superminhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def shingles(text, width=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in SPACE.split(lowered) if w]
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute(rows, percent):
    """Smallest id reachable per row, all pairs compared through shared shingles."""
    sets = [shingles(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, inter in common.items():
            if 100 * inter >= percent * (len(s) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return [(doc, len(sets[i]), ids.get(find(i))) for i, (doc, _) in enumerate(rows)]


def checked(spark, rows, percent):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=order) == sorted(brute(rows, percent), key=order)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_query_against_all_pairs(spark, folder):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in queries.RUNNERS["op8_superminhash"](spark, folder).collect()}
    assert got == set(brute(docs, 85))


def test_a_large_group_of_edited_copies(spark, monkeypatch):
    monkeypatch.setattr("loamfold.llm.near_duplicates.BLOCK", 16)
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(240):
        words = list(base)
        for _ in range(draw.randrange(8)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    checked(spark, rows + rows[:50], 85)


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [(3, None), (4, ""), (5, " \n "), (6, "One two"), (2, "one TWO"), (7, "one two three"), (None, "one two"), (6, "One two"), (9, long), (8, long + " end"), (None, "alone here")]
    checked(spark, rows, 80)
    wide = spark.createDataFrame([(1, "a b c", "x", 5)], "doc_id long, text string, node string, bucket int")
    assert near_duplicates(wide).collect()[0].component_id == 1
    assert near_duplicates(wide.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    both, one, two = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 20, 20))
    hits = []
    for salt in range(300):
        a, b = np.concatenate([both, one]) * np.uint64(2 * salt + 1), np.concatenate([both, two]) * np.uint64(2 * salt + 1)
        s = superminhash(np.concatenate([a, b]), np.array([0, 80, 160]))
        hits.append((s[0] == s[1]).mean())
    assert np.mean(hits) == pytest.approx(0.6, abs=0.015)
    assert np.std(hits) < np.sqrt(0.6 * 0.4 / 48)  # below that of independent minima


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(29, 5), (60, 60), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 5 for i in [5, *range(7, 30)]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
