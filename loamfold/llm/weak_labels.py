"""Quality classifier: a weak-label model over heuristic labellers, and a hashed linear scorer trained on its posterior.

Each labeller votes good, bad or abstains on a document. Spark counts the vote patterns of all documents (at most
3^7 of them, whatever the corpus); expectation-maximisation on those counts estimates how each labeller votes on good
and on bad documents, and gives each pattern its probability of being good. A logistic scorer over hashed words, word
shapes and repetitions learns these probabilities from a bounded sample and scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructType

from loamfold.llm.words import buffers, byte_table, sliced, words_of

#: Distinct texts that the scorer is trained on at most (those with the smallest hashes).
TRAINED = 5000
#: Text bytes whose features a task holds at once; a longer text is taken alone.
HELD = 1 << 22
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 16, 1 << 12
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + 1
#: Labellers: name, and the limits between good, no vote and bad of a ratio (bad beyond the second, on its side).
LABELLERS = [("capitals", 0.3, 0.5), ("symbols", 0.05, 0.2), ("exclamations", 0.05, 0.2), ("pipes", 0.02, 0.1), ("echoes", 0.05, 0.2), ("variety", 0.3, 0.1), ("sentences", 0.02, 0.001)]
#: Share of good documents that a labeller objects to at most.
FALSE_ALARMS = 0.002
#: Words below which variety and sentences say nothing.
ENOUGH = 50
_CASED = byte_table(" \t\n\v\f\r", lower=False)


def _classes() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[ord("a") : ord("z") + 1] = out[128:] = ord("a")
    out[ord("A") : ord("Z") + 1] = ord("A")
    out[ord("0") : ord("9") + 1] = ord("0")
    out[[9, 10, 11, 12, 13]] = 32
    return out


_CLASS = _classes()


@dataclass(frozen=True)
class Signals:
    """Per text its number of words and ratios; per word its buckets."""

    n: np.ndarray
    ratios: np.ndarray
    first: np.ndarray
    word: np.ndarray
    shape: np.ndarray
    echo: np.ndarray


def signals(column: pa.Array) -> Signals:
    words = words_of(column, _CASED)
    offsets, data = buffers(column)
    low = int(offsets[0]) if len(offsets) else 0
    data, offsets = data[low : int(offsets[-1])], offsets - low
    kinds = _CLASS[data]
    # the shape of a word: its runs of small letters, capitals, digits and each other character
    kept = np.ones(len(kinds), dtype=bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    before = np.concatenate([[0], np.cumsum(kept)])
    shapes = pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(before[offsets].astype(np.int64)), pa.py_buffer(kinds[kept].tobytes())])
    shape = words_of(shapes, _CASED).hashes
    n, first = np.diff(words.first), words.first
    echo = np.zeros(len(words.hashes), dtype=bool)
    echo[1:] = words.hashes[1:] == words.hashes[:-1]
    echo[first[:-1][n > 0]] = False

    def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marks)])[bounds])

    distinct = np.array([len(np.unique(words.hashes[a:b])) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], dtype=np.int64)
    capitals, small = per_text(kinds == ord("A"), offsets), per_text(kinds == ord("a"), offsets)
    some = np.maximum(n, 1)
    symbol = np.isin(data, np.frombuffer(b"#*$%&<>", np.uint8))
    ratios = [capitals / np.maximum(capitals + small, 1), per_text(symbol, offsets) / some, per_text(data == ord("!"), offsets) / some, per_text(data == ord("|"), offsets) / some, per_text(echo, first) / some, distinct / some, per_text(data == ord("."), offsets) / some]
    return Signals(n, np.stack(ratios, axis=1) if len(n) else np.zeros((0, len(LABELLERS))), first, (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), (shape % np.uint64(SHAPE_BUCKETS)).astype(np.int64) + WORD_BUCKETS, echo)


def votes(found: Signals) -> np.ndarray:
    """One row per text: 2 good, 1 no vote, 0 bad."""
    out = np.ones((len(found.n), len(LABELLERS)), dtype=np.int64)
    for k, (name, good, bad) in enumerate(LABELLERS):
        x = found.ratios[:, k]
        out[:, k] += (x <= good).astype(np.int64) - (x >= bad) if good < bad else (x >= good).astype(np.int64) - (x <= bad)
        if name in ("variety", "sentences"):
            out[found.n < ENOUGH, k] = 1
    out[found.n == 0] = 1
    return out


def pattern_of(voted: np.ndarray) -> np.ndarray:
    return voted @ 3 ** np.arange(voted.shape[1])


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of good per pattern; per labeller its accuracies on bad and on good documents; the share of good ones.

    An accuracy is the share of right votes among the votes given: where a labeller abstains it says nothing.
    Labellers are taken as independent given the class, and to object to at most ``FALSE_ALARMS`` of the good documents:
    without that bound the kinds of bad documents, which hardly overlap, are split between the classes. The start calls
    a document bad if any labeller objects. Each estimate has two pseudo-votes, one right and one wrong.
    """
    voted = votes_of(patterns)
    yes, no = (voted == 2).astype(float), (voted == 0).astype(float)
    good = np.where(no.any(axis=1), 0.0, 1.0)
    accuracy, share = np.full((2, voted.shape[1]), 0.5), 0.5
    for _ in range(rounds):
        bad_mass, good_mass = counts * (1 - good), counts * good
        accuracy = np.stack([(bad_mass @ no + 1) / (bad_mass @ (yes + no) + 2), (good_mass @ yes + 1) / (good_mass @ (yes + no) + 2)])
        accuracy[1] = np.maximum(accuracy[1], 1 - FALSE_ALARMS)
        share = (good_mass.sum() + 1) / (counts.sum() + 2)
        odds = np.log(share / (1 - share)) + yes @ np.log(accuracy[1] / (1 - accuracy[0])) + no @ np.log((1 - accuracy[1]) / accuracy[0])
        fresh = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if np.abs(fresh - good).max(initial=0) < 1e-9:
            break
        good = fresh
    return good, accuracy, share


def train(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 300, decay: float = 1e-6) -> np.ndarray:
    """Weights of a logistic scorer (the last is the constant) by gradient steps with momentum; rows are (buckets, values)."""
    weights, speed = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    size = np.array([len(b) for b, _ in rows])
    owner = np.repeat(np.arange(len(rows)), size)
    bucket, value = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    # both classes weigh the same, and so do common and rare features
    balance = np.where(good > 0.5, 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1))
    mean = np.bincount(bucket, value * balance[owner], minlength=FEATURES)
    step = 4 / np.sqrt(np.maximum(np.bincount(bucket, value**2 * balance[owner], minlength=FEATURES), 1e-4))
    step[mean == 0] = 0
    for _ in range(rounds):
        score = np.bincount(owner, weights[bucket] * value, minlength=len(rows)) + weights[-1]
        error = balance * (good - 1 / (1 + np.exp(-np.clip(score, -50, 50))))
        slope = np.append(step * np.bincount(bucket, error[owner] * value, minlength=FEATURES), 4 * error.sum())
        speed = 0.9 * speed + slope - decay * weights
        weights += 0.1 * speed
    return weights


@dataclass(frozen=True)
class Model:
    patterns: np.ndarray
    good: np.ndarray
    accuracy: np.ndarray
    share: float
    weights: np.ndarray

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Probability of good by the weak labels; the share of good documents for a pattern never seen."""
        if not len(self.patterns):
            return np.full(len(pattern), self.share)
        at = np.minimum(np.searchsorted(self.patterns, pattern), len(self.patterns) - 1)
        return np.where(self.patterns[at] == pattern, self.good[at], self.share)


def _example(found: Signals, i: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = int(found.first[i]), int(found.first[i + 1])
    ids = np.concatenate([found.word[a:b], found.shape[a:b], np.full(int(found.echo[a:b].sum()), FEATURES - 1)])
    bucket, count = np.unique(ids, return_counts=True)
    return bucket, count / max(b - a, 1)


def fit(docs: DataFrame, text: str = "text", trained: int = TRAINED) -> Model:
    """The model of a corpus. Votes of all documents are counted; the scorer is trained on ``trained`` of them at most."""
    texts = docs.select(F.col(text).cast("string").alias("text"))
    pick = F.xxhash64("text")

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "text", HELD):
                found = signals(batch.column("text"))
                seen, count = np.unique(pattern_of(votes(found))[found.n > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(count.astype(np.int64))], names=["pattern", "n"])

    counted = texts.mapInArrow(patterns, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    seen, counts = (np.array([r[k] for r in counted], dtype=np.int64) for k in (0, 1))
    good, accuracy, share = expectation_maximisation(seen, counts.astype(float))
    model = Model(seen, good, accuracy, share, np.zeros(FEATURES + 1))

    lowest = texts.where("text IS NOT NULL").select(pick.alias("h")).distinct().orderBy("h").limit(trained).agg(F.max("h")).first()[0]
    if lowest is None:
        return model

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "text", HELD):
                found = signals(batch.column("text"))
                likely = model.posterior(pattern_of(votes(found)))
                rows = [(*_example(found, i), float(likely[i])) for i in np.flatnonzero(found.n > 0)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.list_(pa.int32()), pa.list_(pa.float32()), pa.float64()))], names=["bucket", "value", "good"])

    def learn(group: pa.Table) -> pa.Table:
        rows = [(np.array(b, dtype=np.int64), np.array(v, dtype=float)) for b, v in zip(group["bucket"].to_pylist(), group["value"].to_pylist(), strict=True)]
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0].tobytes(), rows[i][1].tobytes()))  # rows come in any order
        weights = train([rows[i] for i in order], group["good"].to_numpy()[order])
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64()))})

    # equal texts are one example, so a text copied everywhere does not fill the sample's one task
    sample = texts.where(pick <= lowest).distinct().mapInArrow(examples, "bucket array<int>, value array<float>, good double")
    learned = sample.withColumn("one", F.lit(True)).groupBy("one").applyInArrow(learn, "weights array<double>").collect()
    return Model(seen, good, accuracy, share, np.array(learned[0][0]) if learned else model.weights)


def scored(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5, only_kept: bool = False) -> DataFrame:
    """``docs`` with ``n_words, pattern, posterior, score, kept``; or, if ``only_kept``, the rows kept as they are.

    ``score`` is the scorer's probability of a good text, ``kept`` is ``score >= least``. A null, empty or blank text
    has score 0 and is not kept. Rows stay, repeated ones too; a column named like an added one is an error (not with
    ``only_kept``); an empty table gives an empty table.
    """
    added = ["n_words", "pattern", "posterior", "score", "kept"]
    if not only_kept and (clash := set(added) & set(docs.columns)):
        raise ValueError(f"columns {sorted(clash)} are added by the classifier")
    schema = StructType([*docs.schema.fields])
    if not only_kept:
        for name, kind in zip(added, (LongType(), IntegerType(), DoubleType(), DoubleType(), BooleanType()), strict=True):
            schema = schema.add(name, kind)
    weights = model.weights.astype(np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, text, HELD):
                found = signals(batch.column(text))
                each = weights[found.word] + weights[found.shape] + weights[FEATURES - 1] * found.echo
                total = np.diff(np.concatenate([[0.0], np.cumsum(each)])[found.first]) / np.maximum(found.n, 1) + weights[-1]
                value = np.where(found.n > 0, 1 / (1 + np.exp(-np.clip(total, -50, 50))), 0.0).round(6)
                kept = (value >= least) & (found.n > 0)
                if only_kept:
                    yield batch.filter(pa.array(kept))
                    continue
                pattern = pattern_of(votes(found))
                extra = [found.n.astype(np.int64), pattern.astype(np.int32), model.posterior(pattern).round(6), value, kept]
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, extra)], names=[*batch.schema.names, *added])

    return docs.mapInArrow(score, schema)
