import hashlib
import random
import re

import numpy as np

from loamfold.llm import decontamination, queries
from loamfold.llm.decontamination import benchmark_matches, suffix_array, without_matches, words_hit

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_query_against_brute_force(spark, folder):
    docs, items = ([tuple(r)[:2] for r in queries.table(spark, folder, t).collect()] for t in ("documents", "benchmark"))
    got = {tuple(r) for r in queries.RUNNERS["op6_suffix_arrays"](spark, folder).collect()}
    assert got == set(brute(docs, items))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_suffix_array_order():
    draw = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        letters = draw.integers(1, 4, n).astype(np.uint32)
        for depth in (2, 3, 10):
            keys = [tuple(letters[i : i + depth]) for i in range(n)]
            order = suffix_array(letters, depth)
            assert sorted(order.tolist()) == list(range(n))
            assert [keys[i] for i in order] == sorted(keys)


def test_blocks_shards_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PASS_BYTES", 200)
    monkeypatch.setattr(decontamination, "SHARD", 16)
    draw = random.Random(2)
    vocabulary = ["a", "b", "cé", "D9", "ñ"]
    text = lambda n: draw.choice([" ", ", "]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 3, 4, 6, 9]) + 2)) for i in range(30)] + [(30, None), (31, ""), (31, "b B b"), (5, "zz")]
    docs = [(i, text(draw.randrange(40))) for i in range(60)] + [(7, None), (8, ""), (9, "-"), (None, "b b b"), (1, "b b b"), (1, "b b b"), (99, " ".join([items[3][1]] * 500))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = benchmark_matches(d, b, 4, ["doc_id"])
    got = [(r.doc_id, r.n_words, r.n_hit, len({m.item_id for m in r.matches})) for r in found.withColumn("n_hit", words_hit(found.matches)).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted([r[:4] for r in brute(docs, items, 4)], key=order)


def test_longest_match_and_place(spark):
    item = [f"i{k}" for k in range(40)]
    doc = ["x", *item[5:30], "y", *item[20:40], "z"]
    d = spark.createDataFrame([(1, " ".join(doc), "keep", 3)], "doc_id long, text string, item_id string, length int")
    b = spark.createDataFrame([("q", " ".join(item).upper())], "item_id string, text string")
    row = benchmark_matches(d, b).first()
    assert [tuple(m) for m in row.matches] == [("q", 5, 1, 25), ("q", 20, 27, 20)] and row.item_id == "keep"
    assert without_matches(d, b).count() == 0 and without_matches(d, b.limit(0)).columns == d.columns
    assert without_matches(d, b.limit(0)).count() == 1 and benchmark_matches(d.limit(0), b).count() == 0
