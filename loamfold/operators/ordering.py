"""Global order without a single-task window: range partitions, then offsets.

A window without a partition key, or with one hot key, sorts everything in one
task. Here rows are range partitioned on the whole order and sorted once; sums
run along each partition as its rows stream by, and are written with them. The
totals of the partitions give the offsets. Rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamfold.session import stored


def _running(weights: Sequence[str]):
    """Per row the sums of the rows before it in its partition that have the same ``_key``; rows stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(weights, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            key = batch.column(names.index("_key")).to_numpy()
            heads = np.flatnonzero(np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]]))
            out = {}
            for w in weights:
                value = batch.column(names.index(w)).fill_null(0).to_numpy().astype(np.int64)
                before = np.concatenate([[0], np.cumsum(value)])
                base = np.full(len(value), -carried[w])
                # each key starts at zero where it begins in this batch
                run_of = np.searchsorted(heads, np.arange(len(value)), side="right") - 1
                started = run_of >= 0
                base[started] = before[heads[run_of[started]]]
                out[w] = before[:-1] - base
                carried[w] = int(out[w][-1] + value[-1])
            last = key[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[w]) for w in weights)], names=[*names, *(f"_in_{w}" for w in weights)])

    return run


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & left[key].eqNullSafe(named[f"_r{i}"])
    return left.join(named, condition, "left").drop(*[f"_r{i}" for i in range(len(keys))])


def cumulated(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weights: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Add ``before_<w>``: the sum of ``w`` over the rows of the same key that come earlier.

    ``order`` must be unique within a key; weights are whole numbers. Without ``parts``
    the number of ranges follows the session's shuffle partitions and the size of the
    data. What is written again per row is the row itself and its sums.
    """
    keys, order = list(keys), list(order)
    ranged = df.repartitionByRange(*([parts] if parts else []), *keys, *order).sortWithinPartitions(*keys, *order)
    marked = ranged.withColumns({"_key": F.xxhash64(F.lit(0), *[F.struct(F.col(k).isNull(), F.col(k)) for k in keys]), "_chunk": F.spark_partition_id()})
    schema = T.StructType([*marked.schema.fields])
    for w in weights:
        schema = schema.add(f"_in_{w}", T.LongType())
    chunks = stored(marked.mapInArrow(_running(weights), schema).drop("_key"), "ordered-chunks")
    totals = chunks.groupBy(*keys, "_chunk").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    lower = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # only a key that spans several ranges has offsets: at most one row per range and one per key
    offsets = totals.select(
        *keys, "_chunk", *[F.coalesce(F.sum(f"_sum_{w}").over(lower), F.lit(0)).alias(f"_off_{w}") for w in weights]
    ).where(any_nonzero([f"_off_{w}" for w in weights]))
    joined = _key_join(chunks, stored(offsets, "chunk-offsets"), [*keys, "_chunk"])
    return joined.select(*df.columns, *[(F.col(f"_in_{w}") + F.coalesce(F.col(f"_off_{w}"), F.lit(0))).alias(f"before_{w}") for w in weights])


def any_nonzero(columns: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(c) != 0 for c in columns])


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index", parts: int | None = None) -> DataFrame:
    """0-based position of each row in the given unique order."""
    numbered = cumulated(df.withColumn("_one", F.lit(1).cast("bigint")), [], order, ["_one"], parts)
    return numbered.withColumnRenamed("before__one", name).drop("_one")


def with_batches(df: DataFrame, order: Sequence[str], size: int, parts: int | None = None) -> DataFrame:
    """Add ``batch_id`` and the position ``pos`` within the batch."""
    indexed = with_row_index(df, order, "_index", parts)
    return indexed.withColumns(
        {
            "batch_id": F.floor(F.col("_index") / F.lit(float(size))).cast("bigint"),
            "pos": F.pmod(F.col("_index"), F.lit(size)).cast("bigint"),
        }
    ).drop("_index")


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """Tie-averaged 1-based rank of each distinct value per key: ``(*keys, value, n, rank)``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return cumulated(counts, keys, [value], ["n"], parts).select(
        *keys, value, "n", (F.col("before_n") + (F.col("n") + 1) / F.lit(2.0)).alias("rank")
    )


def label_codes(values: DataFrame, column: str, parts: int | None = None) -> DataFrame:
    """Sorted distinct non-null values with codes 0…n-1: ``(column, code)``.

    The codes are stored, so a lookup is broadcast if they are small, which keeps a
    frequent value from filling one task, and a shuffle join if they are not.
    """
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return stored(with_row_index(distinct, [column], "code", parts), "codes")


def latest_per_key(df: DataFrame, key: str, order: str, **facts: Column) -> DataFrame:
    """The last row per key by ``order``, and named aggregates of the key; combines on the map side, so a hot key is no burden."""
    return _extreme(df, key, order, F.max_by, facts)


def first_per_key(df: DataFrame, key: str, order: str, **facts: Column) -> DataFrame:
    """The first row per key by ``order``, and named aggregates of the key."""
    return _extreme(df, key, order, F.min_by, facts)


def _extreme(df: DataFrame, key: str, order: str, pick, facts: dict[str, Column]) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    named = [fact.alias(name) for name, fact in facts.items()]
    picked = df.groupBy(key).agg(pick(F.struct(*rest), F.col(order)).alias("_row"), *named)
    return picked.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns], *facts)
