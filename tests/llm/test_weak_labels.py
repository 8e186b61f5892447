import re

import numpy as np
import pyarrow as pa
import pytest

from loamfold.llm import queries, weak_labels
from loamfold.llm.weak_labels import expectation_maximisation, fit, pattern_of, scored, signals, train, votes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ratios(text):
    w, raw = WORD.findall(text or ""), (text or "").encode()
    n = max(len(w), 1)
    big, small = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 or b >= 128 for b in raw)
    return [big / max(big + small, 1), sum(b in b"#*$%&<>" for b in raw) / n, raw.count(b"!") / n, raw.count(b"|") / n, sum(a == b for a, b in zip(w, w[1:], strict=False)) / n, len(set(w)) / n, raw.count(b".") / n]


TEXTS = ["A plain sentence. " * 30, "SHOUT!! LOUD!! " * 30, "a | b | c " * 40, "no no no no yes " * 20, "w%%% x### y&&& " * 30, "", None, " \n\t", "é", "ÉÀ ab Cd0 \n 12", "one two three"]


def test_ratios_and_votes_against_plain_python():
    found = signals(pa.array(TEXTS, pa.string()))
    assert found.n.tolist() == [len(WORD.findall(t or "")) for t in TEXTS]
    assert np.allclose(found.ratios, [ratios(t) for t in TEXTS])
    named = dict(zip(TEXTS, votes(found).tolist(), strict=True))
    assert named[""] == named[None] == [1] * 7 and named[TEXTS[1]][0] == 0 and named[TEXTS[2]][3] == 0 and named[TEXTS[3]][4] == 0 and named[TEXTS[4]][1] == 0
    assert 0 not in named[TEXTS[0]][:5]
    # a slice of a longer column gives the same
    part = signals(pa.array(["before", *TEXTS], pa.string())[1:])
    assert (part.shape == found.shape).all() and (part.word == found.word).all() and (part.echo == found.echo).all()


def test_expectation_maximisation_finds_planted_accuracies():
    draw = np.random.default_rng(0)
    n, catch = 40000, np.array([0.5, 0.4, 0.6, 0.3, 0.45, 0.5, 0.4])
    good = draw.random(n) < 0.8
    objects = draw.random((n, 7)) < np.where(good[:, None], 0.001, catch)
    voted = np.where(draw.random((n, 7)) < 0.2, 1, np.where(objects, 0, 2))
    seen, which, counts = np.unique(pattern_of(voted), return_inverse=True, return_counts=True)
    likely, accuracy, share = expectation_maximisation(seen, counts.astype(float))
    assert share == pytest.approx(0.8, abs=0.02) and np.abs(accuracy[0] - catch).max() < 0.05
    assert ((likely > 0.5)[which] == good).mean() > 0.95


def test_scorer_learns_a_separating_feature():
    rows = [(np.array([i % 2, 5]), np.array([0.5, 0.5])) for i in range(40)]
    weights = train(rows, np.array([float(i % 2) for i in range(40)]))
    assert weights[1] > 1 > -1 > weights[0]


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in queries.table(spark, folder, "labels").collect()}
    rows = queries.RUNNERS["op2_weak_label_classifier"](spark, folder).collect()
    assert len(rows) == 1000
    right = [r.kept == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert sum(right) / len(right) > 0.99
    again = queries.RUNNERS["op2_weak_label_classifier"](spark, folder).collect()
    assert sorted(rows) == sorted(again)


def test_odd_rows(spark):
    docs = [(i, t, "x") for i, t in enumerate(TEXTS)] * 3 + [(None, TEXTS[0], None), (50, "plain words here. " * 20000, "y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, word string")
    model = fit(frame)
    got = scored(frame, model)
    assert got.columns == ["doc_id", "text", "word", "n_words", "pattern", "posterior", "score", "kept"]
    rows = got.collect()
    assert len(rows) == len(docs) and not any(r.kept for r in rows if not (r.text or "").strip())
    assert all(r.kept == (r.posterior > 0.5) for r in rows if r.n_words >= 50)
    kept = scored(frame, model, only_kept=True)
    assert kept.columns == frame.columns and kept.count() == sum(r.kept for r in rows)
    empty = fit(frame.limit(0))
    assert scored(frame.limit(0), empty).count() == 0 and fit(frame.where("text = ''")).share == empty.share
    with pytest.raises(ValueError, match="score"):
        scored(frame.withColumnRenamed("word", "score"), model)
    assert weak_labels.FEATURES == len(model.weights) - 1
