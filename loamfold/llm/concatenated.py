"""Concatenate and cut: documents end to end as one stream of tokens, cut into windows of a fixed size.

The first pass tokenises where the texts lie and counts along each partition. Prefix sums over the totals of the
partitions give every partition its place in the stream, in two levels, so no task sees more than a block of them. The
second pass cuts what was written where windows end. Texts are tokenised once and nothing but totals is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamfold.llm.tokens import added_pattern, added_tokens, with_added, word_ids
from loamfold.session import stored

#: Tokens of a stored row at most, and partitions whose totals are summed in one group.
RUN, BLOCK = 1 << 18, 1024


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def token_runs(docs: DataFrame, vocabulary: str, end: int | None = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, start, length, doc_tokens, before, part, ids``: runs of at most ``RUN`` tokens, with the tokens before each in its partition.

    ``ids`` is binary, four little-endian bytes per id; ``end`` follows each document. Store the result before it is
    used: partitions are numbered as they were when they were tokenised.
    """
    added = added_tokens(vocabulary)
    tail = b"" if end is None else int(end).to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, places = word_ids(vocabulary), added_pattern(added)
        rows: list[tuple] = []
        before = held = 0
        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = with_added(ids_of, content.as_py() or "", added, places) + tail
                for at in range(0, len(ids), 4 * RUN):
                    run = ids[at : at + 4 * RUN]
                    rows.append((doc, at // 4, len(run) // 4, len(ids) // 4, before, run))
                    before += len(run) // 4
                held += len(ids)
                if held > 1 << 23:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    kind = "doc_id long, start long, length long, doc_tokens long, before long, ids binary"
    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(counted, kind).withColumn("part", F.spark_partition_id())


def partition_offsets(runs: DataFrame) -> DataFrame:
    """``part, base``: tokens in all partitions before each. A block of partitions is summed on its own, then the blocks."""
    totals = runs.groupBy("part").agg(F.sum("length").alias("total")).withColumn("block", F.floor(F.col("part") / BLOCK))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("_sum"))
    bases = blocks.select("block", F.coalesce(F.sum("_sum").over(earlier.orderBy("block")), F.lit(0)).alias("_base"))
    inner = F.coalesce(F.sum("total").over(earlier.partitionBy("block").orderBy("part")), F.lit(0))
    return totals.withColumn("_inner", inner).join(bases, "block").select("part", (F.col("_base") + F.col("_inner")).alias("base"))


def concatenated(docs: DataFrame, vocabulary: str, capacity: int = 1024, end: int | None = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    All documents, each followed by ``end``, form one stream in the order in which the table lies; window ``sequence_id``
    holds its tokens from ``capacity * sequence_id`` on. Only the last window can be short. A null text is an empty one,
    which has ``end`` alone (and no piece without ``end``). A null key stays null; repeated rows are documents of their
    own; other columns are left out, so their names cannot clash; an empty table gives an empty table.
    """
    runs = stored(token_runs(docs, vocabulary, end, text, key), "token-runs")
    placed = runs.join(stored(partition_offsets(runs), "partition-offsets"), "part")
    sent = placed.select("doc_id", "start", "doc_tokens", (F.col("base") + F.col("before")).alias("at"), "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, start, total, at, ids in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                content = ids.as_py()
                done, size = 0, len(content) // 4
                while done < size:
                    sequence, offset = divmod(at + done, capacity)
                    length = min(capacity - offset, size - done)
                    rows.append((doc, start + done, length, total, sequence, offset, content[4 * done : 4 * (done + length)]))
                    done += length
                held += len(content)
                if held > 1 << 23:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, schema)

    return sent.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def windows(pieces: DataFrame, capacity: int = 1024, pad: int = 0) -> DataFrame:
    """One row per sequence: ``sequence_id``, its ``ids``, ``n_tokens`` before padding, and ``boundaries``.

    ``boundaries`` are records ``offset, doc_id, start, length`` of the pieces in the window, so that attention and loss
    can stop between documents. A sequence is padded to ``capacity`` unless its length is a power of two. It has at most
    ``capacity`` pieces, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda joined, part: F.concat(joined, part["ids"]))
    sequences = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    padding = F.lit(int(pad).to_bytes(4, "little") * capacity)
    left = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(F.greatest(F.lit(capacity) - F.col("n_tokens"), F.lit(0)))
    boundaries = F.transform("parts", lambda p: F.struct(p["offset"], p["doc_id"], p["start"], p["length"]))
    return sequences.select("sequence_id", F.concat(whole, F.substring(padding, F.lit(1), (4 * left).cast("int"))).alias("ids"), "n_tokens", boundaries.alias("boundaries"))
