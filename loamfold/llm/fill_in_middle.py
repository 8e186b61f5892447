"""Fill-in-middle examples cut at line boundaries that a learned rank index finds.

The index maps the rank of a boundary to its offset in a text: segments of a piecewise-linear function, each as long as
its error stays within a bound, and the small difference left at every boundary. A cut is predicted by its segment and
corrected by its difference, so it is exact, and the index takes two bytes per boundary and 24 per segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Most code points by which a segment may miss a boundary; two bytes hold what is left.
ERROR = 1024
#: Characters of output that a task holds before it hands them on.
HELD = 1 << 23


@dataclass(frozen=True)
class RankIndex:
    """Segments ``first`` rank, ``offset`` there and ``slope``, and per rank what the segment misses."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, bounds: np.ndarray, error: int = ERROR) -> RankIndex:
        """Greedy segments over ascending ``bounds``: each goes on while one line through its first point meets all the others within ``error``."""
        if not 0 < error < 1 << 15:
            raise ValueError("the error must be between 1 and 32767")
        bounds = np.asarray(bounds, dtype=np.int64)
        firsts, slopes, first = [], [], 0
        while first < len(bounds):
            low, high, stop, step = -np.inf, np.inf, first + 1, 16
            while stop < len(bounds):
                rise = bounds[stop : stop + step] - bounds[first]
                run = np.arange(stop - first, stop - first + len(rise))
                lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
                fitting = int(np.argmax(lows > highs)) if (lows > highs).any() else len(rise)
                if fitting:
                    low, high = lows[fitting - 1], highs[fitting - 1]
                stop += fitting
                if fitting < len(rise):
                    break
                step *= 2
            firsts.append(first)
            slopes.append((low + high) / 2 if stop > first + 1 else 0.0)
            first = stop
        starts = np.array(firsts, dtype=np.int64)
        bare = cls(starts, bounds[starts], np.array(slopes), np.empty(0, dtype=np.int16))
        residual = bounds - bare.predicted(np.arange(len(bounds)))
        return cls(bare.first, bare.offset, bare.slope, residual.astype(np.int16))

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, side="right") - 1
        return self.offset[segment] + np.rint(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of the boundaries of these ranks."""
        return self.predicted(ranks) + self.residual[ranks]


def line_bounds(text: str) -> np.ndarray:
    """Code points before each line and after the last; a line ends with its line feed or with the text."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 10) + 1
    last = [len(text)] if text and (not len(ends) or ends[-1] != len(text)) else []
    return np.concatenate([[0], ends, last]).astype(np.int64)


def draws(key: object, seed: int) -> list[int]:
    """Four numbers below 2**32 from the hash of seed and key; a null key is hashed as an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    seed: int = 7,
    rate: int = 100,
    suffix_first: int = 50,
    error: int = ERROR,
    with_index: bool = False,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with ``n, form, prefix_chars, middle_chars, output``.

    A text is cut at two of its ``n + 1`` line boundaries, drawn from ``seed`` and ``key``; ``rate`` percent of the texts
    are rearranged, of these ``suffix_first`` percent with the suffix ahead (``spm``, else ``psm``). A text without
    characters, or with a mark in it, is ``plain``: it is the output and has null for both lengths. A null text counts
    as empty; a null key is drawn for as an empty string; repeated rows are treated alike; an empty table gives an empty
    table; an input column named like an added one is an error. ``with_index`` adds the index of the boundaries,
    ``segments`` and ``residuals`` (binary, two little-endian bytes a boundary).
    """
    kept = list(docs.columns if keep is None else keep)
    index_kind = ", segments array<struct<rank: long, offset: long, slope: double>>, residuals binary" if with_index else ""
    added = T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string" + index_kind)
    if clash := set(added.names) & set(kept):
        raise ValueError(f"columns {sorted(clash)} are added")
    # the key and the text go in once more under names of their own, ahead of the columns that stay
    sent = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), *kept)
    schema = T.StructType([*docs.select(*kept).schema, *added])
    new = to_arrow_schema(added)

    def example(number: object, content: str) -> tuple:
        bounds = line_bounds(content)
        index = RankIndex.fit(bounds, error)
        n = len(bounds) - 1
        row: tuple = (n, "plain", None, None, content)
        one, two, share, order = draws(number, seed)
        if content and share % 100 < rate and not any(mark in content for mark in (PREFIX, SUFFIX, MIDDLE)):
            a, b = (int(c) for c in index.at(np.array(sorted((one % (n + 1), two % (n + 1))))))
            prefix, middle, suffix = content[:a], content[a:b], content[b:]
            if order % 100 < suffix_first:
                row = (n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
            else:
                row = (n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")
        if with_index:
            segments = [{"rank": r, "offset": o, "slope": s} for r, o, s in zip(index.first.tolist(), index.offset.tolist(), index.slope.tolist(), strict=True)]
            row += (segments, index.residual.astype("<i2").tobytes())
        return row

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, stay = batch.column(0), batch.column(1), batch.columns[2:]
            rows: list[tuple] = []
            begun = held = 0
            for i in range(batch.num_rows):
                rows.append(example(keys[i].as_py(), texts[i].as_py() or ""))
                held += len(rows[-1][4])
                if held > HELD or i == batch.num_rows - 1:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), new, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(c.slice(begun, len(rows)) for c in stay), *columns], names=[*kept, *new.names])
                    rows, begun, held = [], i + 1, 0

    return sent.mapInArrow(batches_of, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The marks in it are those put there, as texts with marks are left plain."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    one, two, middle = F.get(parts, 1), F.get(parts, 2), F.get(parts, 3)
    return F.when(form == "psm", F.concat(one, middle, two)).when(form == "spm", F.concat(two, middle, one)).otherwise(output)
