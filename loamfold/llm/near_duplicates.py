"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, connected components.

Documents with equal shingle sets collapse to one node first. Signatures give buckets; within a bucket, every member is
verified against one centre, which already connects a large group of copies with a link per member. Members of
different components that still share a bucket are then compared exactly in blocks of bounded size, each of which
returns a spanning forest of the links it finds. So no group is held by one task, no pairs within a group are
emitted, and no two documents of one bucket stay unconnected without an exact comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from loamfold.llm.components import components
from loamfold.llm.words import mix, shingles_of, sliced, words_of
from loamfold.session import stored

#: Slots of a signature, taken three to a band: two sets of similarity 0.85 share none of the 16 bands once in
#: 4 million, of 0.9 once in 300 million; two of 0.1 share one in 1.6 % of cases.
SLOTS, ROWS = 48, 3
#: Members of a bucket in one block of exact comparison, and shingles compared at once there.
BLOCK, COLUMNS = 256, 1 << 12
#: Text bytes whose hashes a task holds at once; a longer text is taken alone.
HELD = 1 << 22
_EMPTY = np.uint64(2**64 - 1)


def superminhash(hashes: np.ndarray, bound: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row per set; set i has the elements bound[i] ... bound[i + 1] - 1.

    Element e draws a random permutation p of the slots (Fisher-Yates, one step per level j) and offers p[j] the
    value j + r, 0 <= r < 1; a slot keeps the smallest offer. All elements take level j together; as later levels
    offer only larger values, a set stops at the first level at which all its slots are taken. Values are fixed-point
    numbers with 32 binary places. An empty set has no taken slot.
    """
    sets = len(bound) - 1
    owner = np.repeat(np.arange(sets), np.diff(bound))
    out = np.full(sets * slots, _EMPTY, dtype=np.uint64)
    own = hashes
    order = None
    for level in range(slots):
        drawn = mix(own + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        pick = level + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        at = np.arange(len(own))
        slot = pick if order is None else order[at, pick].astype(np.int64)
        np.minimum.at(out, owner * slots + slot, np.uint64(level << 32) | drawn >> np.uint64(32))
        open_sets = (out.reshape(sets, slots) == _EMPTY).any(axis=1)
        go_on = open_sets[owner]
        if not go_on.any():
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8), (int(go_on.sum()), 1))
        else:
            order = order[go_on]
        own, owner, pick, slot = own[go_on], owner[go_on], pick[go_on], slot[go_on]
        at = np.arange(len(own))
        order[at, pick] = order[at, level]
        order[at, level] = slot
    return out.reshape(sets, slots)


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, distinct between bands."""
    bands = signatures.shape[1] // rows
    parts = signatures.reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys


def _set_keys(hashes: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart: two sums of differently mixed elements, each mixed with the size."""
    keys = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)))])
        keys.append(mix(sums[bound[1:]] - sums[bound[:-1]] + np.diff(bound).astype(np.uint64)).view(np.int64))
    return keys[0], keys[1]


def _lists(values: np.ndarray, bound: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(values.view(np.int64)))


def shingle_rows(df: DataFrame, width: int, signatures: bool) -> DataFrame:
    """``df`` (its text last) with the text replaced by ``n_shingles, set_a, set_b`` and ``bands`` or ``shingles``."""
    text = df.columns[-1]
    last = "bands" if signatures else "shingles"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, text, HELD):
                found, bound = shingles_of(words_of(batch.column(text)), width)
                first, second = _set_keys(found, bound)
                n = np.diff(bound)
                if signatures:
                    keys = band_keys(superminhash(found, bound))
                    keys, ends = keys[n > 0].ravel(), np.concatenate([[0], np.cumsum((n > 0) * keys.shape[1])])
                    lists = _lists(keys, ends)
                else:
                    lists = _lists(found, bound)
                kept = [batch.column(c) for c in batch.schema.names[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(n.astype(np.int64)), pa.array(first), pa.array(second), lists], names=[*batch.schema.names[:-1], "n_shingles", "set_a", "set_b", last])

    schema = StructType(df.schema.fields[:-1])
    for name in ("n_shingles", "set_a", "set_b"):
        schema = schema.add(name, "long")
    return df.mapInArrow(hashed, schema.add(last, ArrayType(LongType())))


def _linked(inter, one, other, percent: int):
    return 100 * inter >= percent * (one + other - inter)


def _forest(percent: int):
    """Exact comparison of the members of one or two blocks; a spanning forest of the links between components."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, label, part = (group.column(c).to_numpy() for c in ("node", "label", "part"))
        items = group.column("shingles").chunk(0)
        values, size = items.flatten().to_numpy(), np.diff(items.offsets.to_numpy()).astype(np.int64)
        _, column, often = np.unique(values, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(node)), size)
        shared = often[column] > 1  # what only one member has is in no intersection
        row, column = row[shared], column[shared]
        column = np.unique(column, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        inter = np.zeros((len(node), len(node)), dtype=np.float64)
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [begin, begin + COLUMNS])
            has = np.zeros((len(node), COLUMNS), dtype=np.float32)
            has[row[a:b], column[a:b] - begin] = 1
            inter += has @ has.T
        close = _linked(inter, size[:, None], size[None, :], percent) & (label[:, None] != label[None, :])
        close &= (part[:, None] != part[None, :]) if part.min() != part.max() else True
        root = {x: x for x in label.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for i, j in np.argwhere(np.triu(close, 1)).tolist():
            one, other = find(int(label[i])), find(int(label[j]))
            if one != other:
                root[one] = other
                links.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return compare


def row_keys(key: str, text: str) -> list[Column]:
    """128 bits that tell rows with different ids or texts apart, as ``row_a`` and ``row_b``."""
    return [F.xxhash64(F.lit(salt), F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text)).alias(name) for salt, name in ((1, "row_a"), (2, "row_b"))]


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two rows are linked if 100 * |A & B| >= percent * |A | B| for their sets of distinct ``width``-word shingles (A-Z
    lower-cased, words split at ASCII white space; a text with fewer words is one shingle). ``component_id`` is the
    smallest ``doc_id`` reachable over links, ``kept`` is true where it is the row's own. A null or empty text, or one
    without words, has no shingles and is linked with nothing. A row without a ``doc_id`` links others but is nobody's
    smallest; its own ``component_id`` is null if its whole component has none, and ``kept`` is then true. Rows that
    repeat a ``doc_id`` are rows of their own. Other columns are left out; an empty table gives an empty table.
    """
    return _placed(docs, percent, width, key, text).select("doc_id", "n_shingles", "component_id", "kept")


def _placed(docs: DataFrame, percent: int, width: int, key: str, text: str) -> DataFrame:
    """As ``near_duplicates``, with ``row_a, row_b`` and whether the row is the ``first`` of its component."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), *row_keys(key, text), F.col(text).cast("string").alias("text"))
    sketches = stored(shingle_rows(rows, width, signatures=True), "sketches")
    # one node per distinct set; the row that stands for it has its smallest id
    nowhere = F.coalesce("doc_id", F.lit(2**63 - 1).cast("long"))
    classes = sketches.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct(nowhere.alias("id"), "row_a", "row_b", "doc_id")).alias("first"), F.first("bands").alias("bands"))
    nodes = stored(classes.select("set_a", "set_b", "n_shingles", "first", "bands", F.monotonically_increasing_id().alias("node")), "nodes")

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("_last")).where("centre < _last").select("bucket", "centre")
    hits = stored(members.join(buckets, "bucket"), "buckets")
    wanted = nodes.join(hits.select("node").distinct(), "node").select("node", "set_a", "set_b", "first.row_a", "first.row_b")
    # the texts of these nodes only are read again for their whole sets
    again = rows.join(wanted.select("row_a", "row_b").distinct(), ["row_a", "row_b"], "left_semi").select("text")
    full = shingle_rows(again, width, signatures=False).join(wanted.select("node", "set_a", "set_b"), ["set_a", "set_b"]).dropDuplicates(["node"])
    sets = stored(full.select("node", "n_shingles", "shingles"), "sets")

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("shingles").alias(f"s_{name}"))

    inter = F.size(F.array_intersect("s_a", "s_b"))
    pairs = hits.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = stored(pairs.join(side("b"), "b").join(side("a"), "a").where(_linked(inter, F.col("n_a"), F.col("n_b"), percent)).select("a", "b"), "star")
    labels = stored(components(star), "labels")

    labelled = stored(hits.select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("label")), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38)")).alias("_s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_x"), F.min("label").alias("_l"), F.max("label").alias("_m"))
    # buckets of the same members are compared once
    unsettled = mixed.where("_l != _m").groupBy("size", "_s", "_x").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    dealt = labelled.join(unsettled, "bucket").withColumn("part", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "label")
    blocks = stored(dealt, "blocks")
    open_blocks = blocks.groupBy("bucket", "low", "high").agg(F.min("label").alias("_l"), F.max("label").alias("_m")).where("_l != _m").select("bucket", "low", "high")
    compared = blocks.join(open_blocks, ["bucket", "low", "high"]).join(sets, "node").select("bucket", "low", "high", "part", "node", "label", "shingles")
    forest = compared.groupBy("bucket", "low", "high").applyInArrow(_forest(percent), "a long, b long")
    joined = stored(components(star.unionByName(forest)), "components")

    placed = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("least"))
    known = placed.join(smallest, "component").select("set_a", "set_b", "least")
    out = sketches.select("doc_id", "row_a", "row_b", "n_shingles", "set_a", "set_b").join(known, ["set_a", "set_b"], "left")
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    first = alone | ((F.col("row_a") == F.col("least.row_a")) & (F.col("row_b") == F.col("least.row_b")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "row_a", "row_b", first.alias("first"))


def representatives(docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per near-duplicate component: that with its smallest id (nulls last, ties by text hash).

    A null, empty or blank text is a component of its own. Rows equal in id and text count once, whatever their other
    columns.
    """
    placed = _placed(docs, percent, width, key, text).where("first").select(F.col("row_a").alias("_row_a"), F.col("row_b").alias("_row_b")).distinct()
    one, two = row_keys(key, text)
    keyed = docs.withColumns({"_row_a": one, "_row_b": two}).join(placed, ["_row_a", "_row_b"], "left_semi")
    return keyed.dropDuplicates(["_row_a", "_row_b"]).select(docs.columns)
