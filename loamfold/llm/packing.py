"""Best-fit decreasing packing of pieces into sequences of a fixed capacity.

Best fit depends on the lengths alone, and pieces of one length are interchangeable. The plan is therefore made from
the number of pieces of each length (at most ``capacity`` numbers, whatever the size of the corpus) and says, per run
of equally long pieces, which bins they fill. Pieces find their run by their rank among the pieces of their length,
which Spark counts in salted groups: no length, however common, meets in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamfold.session import stored


class OpenCapacities:
    """A segment tree over remaining capacities 0 ... ``most``; a leaf is set while a bin with that rest is open."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = bytearray(2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest open capacity of at least ``need``: up while only smaller ones are below, then down to the left."""
        node = self.leaves + need
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Run:
    """``count`` pieces of ``length``, from rank ``rank``: ``each`` per bin from bin ``bin`` on, at ``offset`` there."""

    length: int
    rank: int
    count: int
    each: int
    bin: int
    offset: int


def best_fit_runs(counts: Mapping[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over counted lengths; equal to placing the pieces one by one."""
    tree, bins, runs = OpenCapacities(capacity), defaultdict(list), []
    opened = 0

    def leave(rest: int, first: int, number: int) -> None:
        if rest and number:
            bins[rest].append((first, number))
            tree.mark(rest, True)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, left = 0, counts[length]
        while left:
            rest = tree.tightest(length)
            if rest is None:
                rest, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            else:
                first, number = bins[rest].pop()
                if not bins[rest]:
                    tree.mark(rest, False)
            # a bin that took one piece is the tightest for the next, so each is filled before another is begun
            each = rest // length
            whole = min(number, left // each)
            for n, k in ((whole, each), (1, left - whole * each)) if whole < number else ((whole, each),):
                if n and k:
                    runs.append(Run(length, rank, n * k, k, first, capacity - rest))
                    leave(rest - k * length, first, n)
                    rank, left, first, number = rank + n * k, left - n * k, first + n, number - n
            leave(rest, first, number)
    return runs


def pack(pieces: DataFrame, order: list[str], capacity: int = 2048, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where best-fit decreasing puts each piece.

    ``order`` names columns that tell pieces apart; equal rows are pieces of their own and interchangeable. Lengths
    must be between 1 and ``capacity``; a piece with another length or none gets null in both columns. Input columns
    keep their names (one named like an added column is an error); an empty table gives an empty table. ``pieces``
    is read twice, so pass a stored table.
    """
    if clash := {"sequence_id", "offset", "_salt", "_rank", "_base", "_cell"} & set(pieces.columns):
        raise ValueError(f"columns {sorted(clash)} are added by packing")
    salts = max(1, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    valid = F.col(length).between(1, capacity)
    cell = F.when(valid, F.col(length) * F.lit(salts) + F.pmod(F.xxhash64(*order), F.lit(salts)))
    salted = pieces.withColumn("_cell", cell)
    sizes = stored(salted.where(F.col("_cell").isNotNull()).groupBy("_cell").agg(F.count("*").alias("_n"), F.first(length).cast("long").alias("_length")), "pack-sizes")
    before = Window.partitionBy("_length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # at most one row per length: the capacity bounds what the driver gets
    counts = {r[0]: r[1] for r in sizes.groupBy("_length").agg(F.sum("_n")).collect()}
    runs = sorted(best_fit_runs(counts, capacity), key=lambda r: (r.length, r.rank))
    table = {name: np.array([getattr(r, name) for r in runs], dtype=np.int64) for name in ("length", "rank", "each", "bin", "offset")}

    # equal cells meet in one window, one length's pieces are spread over all salts
    own = F.row_number().over(Window.partitionBy("_cell").orderBy(*order)) - 1
    known = salted.where(F.col("_cell").isNotNull()).withColumn("_own", own).join(base, "_cell").withColumn("_rank", F.col("_own") + F.col("_base")).drop("_own", "_base", "_cell")
    schema = known.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.int64(1) << np.int64(46)
        begins = table["length"] * span + table["rank"]
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            run = np.searchsorted(begins, size * span + rank, side="right") - 1
            step = rank - table["rank"][run]
            each = table["each"][run]
            kept = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "_rank"]
            names = [name for name in batch.schema.names if name != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(table["bin"][run] + step // each), pa.array(table["offset"][run] + step % each * size)], names=[*names, "sequence_id", "offset"])

    placed = known.mapInArrow(place, schema)
    rest = pieces.where(~F.coalesce(valid, F.lit(False))).withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    return placed.unionByName(rest)


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """One row per sequence: ``sequence_id``, its ``ids`` (binary, in order of place) and ``doc_ids``.

    A sequence has at most ``capacity`` pieces, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", F.col(ids).alias("ids"))))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part["ids"]))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
