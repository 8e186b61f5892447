"""Benchmark passages in training documents, by suffix arrays over shards of the training words.

Each task builds, shard by shard, the suffix array of its documents' words and looks up every window of the benchmark
in it by binary search. Consecutive windows on one diagonal join to the longest verbatim match and its place. The
benchmark visits the documents in blocks of bounded size, one pass per block, so it may be of any size; documents are
never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from loamfold.llm.words import ALNUM, sliced, words_of

#: Benchmark text bytes in one pass, on average; and words of one shard.
PASS_BYTES, SHARD = 1 << 22, 1 << 20
#: Training text bytes whose words a task holds at once; a longer text is taken alone.
HELD = 1 << 23
MATCH = StructType().add("item_id", StringType()).add("item_word", LongType()).add("word", LongType()).add("length", LongType())


def suffix_array(letters: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``letters`` (32 bits each), sorted by their first ``depth`` letters.

    Prefix doubling: the first sort takes two letters; ranks by k letters give those by up to 2 k; only suffixes that
    still share a rank with others are sorted again. Letters beyond the end count as 0.
    """
    n = len(letters)
    wide = np.zeros(n + 1, dtype=np.uint64)
    wide[:n] = letters
    key = wide[:-1] << np.uint64(32) | wide[1:]
    order = np.argsort(key)
    known = 2
    rank = np.zeros(n + depth + 1, dtype=np.int64)
    sorted_key = key[order]
    head = np.ones(n, dtype=bool)
    head[1:] = sorted_key[1:] != sorted_key[:-1]
    while True:
        # the rank of a group is one more than the place of its first suffix, so splitting one moves no other
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
        alone = head & np.append(head[1:], True)
        if known >= depth or alone.all():
            return order
        step = min(known, depth - known)
        at = np.flatnonzero(~alone)
        own = order[at]
        key = rank[own].astype(np.uint64) << np.uint64(32) | rank[own + step].astype(np.uint64)
        inner = np.argsort(key, kind="stable")
        order[at] = own[inner]
        key = key[inner]
        head[at[1:]] = key[1:] != key[:-1]
        head[at[0]] = True
        known += step


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block of the benchmark, and where in which item each stands."""

    words: np.ndarray  # one row per window, 64-bit words, padded with 0
    size: np.ndarray
    item: np.ndarray  # places sorted by window: item, first word of the window there
    place: np.ndarray
    first: np.ndarray  # window i stands at the places first[i] ... first[i + 1] - 1
    ids: list[str | None]


def windows_of(items: list[tuple[str | None, str | None]], width: int) -> Windows:
    """All windows of ``width`` words; an item of fewer words, but not none, is one window."""
    words = words_of(pa.array([t for _, t in items], pa.large_string()), ALNUM)
    n = np.diff(words.first)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    item = np.repeat(np.arange(len(items)), count)
    place = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    size = np.minimum(n, width)[item]
    begin = words.first[:-1][item] + place
    table = np.zeros((len(item), width), dtype=np.uint64)
    for i in range(width):
        here = i < size
        table[here, i] = words.hashes[begin[here] + i]
    distinct, which = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    sizes = np.zeros(len(distinct), dtype=np.int64)
    sizes[which] = size
    return Windows(distinct, sizes, item[order], place[order], np.searchsorted(which[order], np.arange(len(distinct) + 1)), [i for i, _ in items])


def _letters(words: np.ndarray) -> np.ndarray:
    """32 bits of each word; 0 is kept for ends of documents."""
    return np.maximum(words >> np.uint64(32), np.uint64(1)).astype(np.uint32)


def _range(letters: np.ndarray, order: np.ndarray, wanted: np.ndarray, size: np.ndarray, upper: bool) -> np.ndarray:
    """By binary search, per window the number of suffixes below it (or, if ``upper``, below or beginning with it)."""
    low, high = np.zeros(len(size), dtype=np.int64), np.full(len(size), len(order), dtype=np.int64)
    steps = np.arange(wanted.shape[1])
    inside = steps < size[:, None]
    for _ in range(int(len(order)).bit_length()):
        middle = np.minimum((low + high) // 2, len(order) - 1)
        there = letters[order[middle][:, None] + steps]
        differ = (there != wanted) & inside
        at = differ.argmax(axis=1)
        rows = np.arange(len(size))
        below = np.where(differ[rows, at], there[rows, at] < wanted[rows, at], upper)
        go = low < high
        low = np.where(go & below, middle + 1, low)
        high = np.where(go & ~below, middle, high)
    return low


def occurrences(words: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """All (word place, window) at which a window stands in ``words``; a word of 0 ends a document."""
    width = windows.words.shape[1]
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    wanted = _letters(windows.words)
    for begin in range(0, len(words), SHARD):
        part = words[begin : begin + SHARD + width - 1]
        letters = np.zeros(len(part) + width, dtype=np.uint32)
        letters[: len(part)] = np.where(part == 0, np.uint32(0), _letters(part))
        order = suffix_array(letters[: len(part)], width)
        low, high = (_range(letters, order, wanted, windows.size, upper) for upper in (False, True))
        count = high - low
        window = np.repeat(np.arange(len(count)), count)
        place = order[np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + low[window]]
        # letters are half of a word's hash: compare the whole; a place in the overlap belongs to the next shard
        right = place < SHARD
        for i in range(width):
            here = right & (i < windows.size[window])
            right[here] = part[place[here] + i] == windows.words[window[here], i]
        places.append(place[right] + begin)
        found.append(window[right])
    return np.concatenate(places), np.concatenate(found)


def longest_matches(place: np.ndarray, window: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """Windows that follow each other in both texts as one match: item, its word, training word, length."""
    count = windows.first[window + 1] - windows.first[window]
    own = np.repeat(np.arange(len(window)), count)
    at = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + windows.first[window][own]
    item, there, here, size = windows.item[at], windows.place[at], place[own], windows.size[window][own]
    order = np.lexsort((there, here - there, item))
    item, there, here, size = item[order], there[order], here[order], size[order]
    head = np.ones(len(item), dtype=bool)
    head[1:] = (item[1:] != item[:-1]) | (here[1:] - there[1:] != here[:-1] - there[:-1]) | (there[1:] != there[:-1] + 1)
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(item))[: len(begin)] - 1
    return item[begin], there[begin], here[begin], there[end] + size[end] - there[begin]


def _pass(windows: Windows, first: bool, last: bool):
    """One pass over the documents: their text is the last column, before it the matches of earlier passes."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, batch_text := whole.schema.names[-1], HELD):
                words = words_of(batch.column(batch_text), ALNUM)
                n = np.diff(words.first)
                docs = batch.num_rows
                # documents one after the other with a 0 after each
                line = np.zeros(len(words.hashes) + docs, dtype=np.uint64)
                start = words.first[:-1] + np.arange(docs)
                line[np.arange(len(words.hashes)) + np.repeat(np.arange(docs), n)] = np.maximum(words.hashes, np.uint64(1))
                item, there, here, length = longest_matches(*occurrences(line, windows), windows) if len(windows.size) else [np.zeros(0, np.int64)] * 4
                doc = np.searchsorted(start, here, side="right") - 1
                order = np.lexsort((item, here, doc))
                item, there, here, length, doc = (x[order] for x in (item, there, here, length, doc))
                ids = pa.array(windows.ids, pa.string()).take(pa.array(item))
                new = pa.StructArray.from_arrays([ids, pa.array(there), pa.array(here - start[doc]), pa.array(length)], names=MATCH.names)
                bound = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bound), new)
                names = batch.schema.names
                columns = [batch.column(c) for c in names[: -1 if first else -3]]
                old = pa.array([[]] * docs, lists.type) if first else batch.column(names[-2])
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n.astype(np.int64)), lists if first else pa.array([a + b for a, b in zip(old.to_pylist(), lists.to_pylist(), strict=True)], lists.type)] + ([] if last else [batch.column(batch_text)]),
                    names=[*names[: len(columns)], "n_words", "matches"] + ([] if last else [batch_text]),
                )

    return search


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: list[str] | None = None, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text) with ``n_words`` and ``matches``.

    ``matches`` lists the longest verbatim passages shared with an item: ``item_id`` (as a string), ``item_word``,
    ``word`` (first word of the passage there and in the document, from 0) and ``length`` in words. Words are runs of
    0-9, a-z and characters beyond ASCII after lower-casing A-Z; passages have ``width`` words or more, or are a whole
    shorter item. A null or empty text has no words and no matches. Repeated items match each; an item without an id
    has a null one. Rows of ``docs`` stay as they are, repeated ones too; an empty table gives an empty table, an empty
    benchmark gives no matches. A kept column named ``n_words`` or ``matches`` is an error.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    if clash := {"n_words", "matches"} & set(keep):
        raise ValueError(f"columns {sorted(clash)} are added by the search")
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("string").alias("content"))
    total = items.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    passes = max(1, -(-total // PASS_BYTES))
    here = "_text"
    df = docs.select(*keep, F.col(text).cast("string").alias(here))
    base = StructType([docs.schema[c] for c in keep]).add("n_words", LongType()).add("matches", ArrayType(MATCH))
    for k in range(passes):
        block = items.where(F.pmod(F.xxhash64("item", "content"), F.lit(passes)) == k).collect()  # about PASS_BYTES
        last = k == passes - 1
        search = _pass(windows_of([tuple(r) for r in block], width), k == 0, last)
        df = df.mapInArrow(search, base if last else StructType([*base.fields]).add(here, StringType()))
    return df


def words_hit(matches: Column) -> Column:
    """Number of words inside any of the matches."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("until"))

    def add(state: Column, one: Column) -> Column:
        end = one["word"] + one["length"]
        return F.struct(
            (state["total"] + F.greatest(end - F.greatest(one["word"], state["until"]), F.lit(0))).alias("total"),
            F.greatest(state["until"], end).alias("until"),
        )

    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["word"].alias("word"), m["length"].alias("length"))))
    return F.when(F.size(matches) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(ordered, zero, add, lambda s: s["total"]))


def without_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that share no passage with the benchmark; see ``benchmark_matches``."""
    renamed = docs.select(F.struct("*").alias("row"), F.col(text).alias("content"))
    found = benchmark_matches(renamed, benchmark, width, ["row"], "content", item)
    return found.where(F.size("matches") == 0).select("row.*")
