"""Vector code compression: product codebooks, with the nearest entry found by equal-average search.

All arithmetic is on whole numbers, so sums do not depend on how rows lie. The table is read once per round; what a task
sends back is one sum per entry and position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamfold.session import stored

#: Components times ``SCALE`` are below ``LARGEST`` in size, so that squared distances are exact in 64 bits.
SCALE, LARGEST = 4096, 1 << 25


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest of ``entries`` to each point; of equally near ones the lowest index.

    Entries are put in order of the sum of their components. Each point begins where its own sum would stand and takes
    the entry on either side whose sum is nearer, until the squared gap of the sums over the dimension, which no squared
    distance is below, is larger than the best distance.
    """
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, dimension, last = sums[order], max(1, entries.shape[1]), len(entries)
    far = np.int64(2**62)
    best, chosen = np.full(len(points), far), np.full(len(points), last)
    own = points.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    active = np.arange(len(points))
    while active.size:
        below, above = left[active], right[active]
        gap_below = np.where(below >= 0, own[active] - sums[np.maximum(below, 0)], far)
        gap_above = np.where(above < last, sums[np.minimum(above, last - 1)] - own[active], far)
        gap = np.minimum(gap_below, gap_above)
        # -(-x // d) is the ceiling: a whole distance is below it just where d times the distance is below x
        going = gap < far
        going[going] = -(-gap[going] * gap[going] // dimension) <= best[active[going]]
        active, down = active[going], (gap_below <= gap_above)[going]
        entry = order[np.where(down, below[going], above[going])]
        distance = ((points[active] - entries[entry]) ** 2).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < chosen[active]))
        best[active[better]], chosen[active[better]] = distance[better], entry[better]
        left[active[down]] -= 1
        right[active[~down]] += 1
    return chosen, best


def whole_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``whole``, the components as ``floor(SCALE * x)``; rows go whose vector is null or has a null, NaN or infinite component.

    A finite component of ``LARGEST / SCALE`` or more in size is an error.
    """
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) < LARGEST / SCALE)
    checked = F.when(fits, scaled.cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component is {LARGEST // SCALE} or more in size")).cast("array<int>"))
    return vectors.where(F.col(vector).isNotNull() & finite).withColumn("whole", checked)


def _points(batch: pa.RecordBatch, column: int, parts: int) -> list[np.ndarray]:
    """Of each part, one row per row of the batch."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(flat.reshape(batch.num_rows, len(flat) // batch.num_rows), parts, axis=1)


def fit(whole: DataFrame, key: str = "vec_id", parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks of ``parts`` equal parts after ``rounds`` of assigning and averaging; all rows of ``whole`` count.

    The first entries are the vectors with the smallest keys (nulls last, equal keys in order of the vector). The
    length of the first is that of all; vectors of other lengths do not count. An entry without points stays. The
    driver gets one sum and count per entry and position, and the codebooks go with the tasks.
    """
    seeds = [r[0] for r in whole.orderBy(F.col(key).asc_nulls_last(), "whole").limit(entries).select("whole").collect()]
    if not seeds:
        return Codebooks(np.empty((parts, 0, 0), dtype=np.int64))
    size = len(seeds[0])
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    first = np.array([s for s in seeds if len(s) == size], dtype=np.int64)
    books = np.stack(np.split(first, parts, axis=1)) if size else np.empty((parts, len(first), 0), dtype=np.int64)
    used = whole.where(F.size("whole") == size).select("whole")
    for _ in range(rounds if size else 0):
        sums = used.mapInArrow(_sums(books), "part int, entry int, position int, total long, n long")
        found = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        books = books.copy()
        for part, entry, position, total, n in found:
            books[part, entry, position] = total // n
    return Codebooks(books)


def _sums(books: np.ndarray):
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros_like(books), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for part, points in enumerate(_points(batch, 0, parts) if batch.num_rows else ()):
                chosen, _ = nearest(points, books[part])
                np.add.at(totals[part], chosen, points)
                counts[part] += np.bincount(chosen, minlength=entries)
        part, entry, position = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, books.shape))
        columns = [part.astype(np.int32), entry.astype(np.int32), position.astype(np.int32), totals[part, entry, position], counts[part, entry]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "position", "total", "n"])

    return run


def encoded(whole: DataFrame, books: Codebooks) -> DataFrame:
    """``whole`` with ``code`` (binary, an entry per part) in place of the vector, and ``error``, the squared distances of all parts.

    A vector of another length than the codebooks' has null in both.
    """
    if clash := {"code", "error"} & set(whole.columns):
        raise ValueError(f"columns {sorted(clash)} are added")
    parts, count, size = books.entries.shape
    if count > 256:
        raise ValueError("a code has one byte per part")
    kept = [c for c in whole.columns if c != "whole"]
    nothing = {"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("long")}
    schema = whole.select(*kept).schema.add("code", "binary").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [nearest(points, books.entries[i]) for i, points in enumerate(_points(batch, len(kept), parts))]
            codes = np.stack([chosen for chosen, _ in found], axis=1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], names=[*kept, "code", "error"])

    same = F.size("whole") == parts * size
    coded = whole.where(same).select(*kept, "whole").mapInArrow(run, schema)
    return coded.unionByName(whole.where(~same).select(*kept).withColumns(nothing))


def decoded(code: Column, books: Codebooks) -> Column:
    """The vector of whole numbers that a code stands for; the codebooks are a literal of the expression."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in part]) for part in books.entries.tolist()])
    digits = F.sequence(F.lit(0), F.lit(len(books.entries) - 1))
    return F.flatten(F.transform(digits, lambda i: F.get(F.get(entries, i), F.conv(F.substring(F.hex(code), 2 * i + 1, F.lit(2)), 16, 10).cast("int"))))


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, Codebooks]:
    """``vectors`` without the vector, with ``code`` and ``error``, and the codebooks fitted on all of them.

    Rows whose vector is null or holds a null or non-finite component are left out. Fewer rows than ``entries`` give as
    many entries; an empty table gives an empty table and codebooks without entries; a null key counts after all others;
    repeated rows are vectors of their own; an input column named like an added one is an error.
    """
    if clash := {"whole", "code", "error"} & set(vectors.columns):
        raise ValueError(f"columns {sorted(clash)} are added")
    whole = stored(whole_vectors(vectors, vector).drop(vector), "whole-vectors")
    books = fit(whole, key, parts, entries, rounds)
    return encoded(whole, books), books
