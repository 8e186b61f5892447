import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loamfold.llm import concatenated, queries


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(whole, text, end=0):
    ids = whole.encode(text or "", add_special_tokens=False).ids
    return np.array(ids if end is None else [*ids, end], dtype="<u4")


def test_query_covers_every_token_once(spark, folder, whole):
    docs = {r.doc_id: ids_of(whole, r.text) for r in queries.table(spark, folder, "documents").collect()}
    rows = queries.RUNNERS["op12_concatenate_and_cut"](spark, folder).collect()
    assert sorted(rows[0].asDict()) == sorted("doc_id start length ids_crc32 doc_tokens sequence_id offset".split())
    pieces, places = {}, {}
    for r in rows:
        ids = docs[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(ids) > 0 and r.doc_tokens == len(docs[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids.tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for found in (*pieces.values(), *places.values()):
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
    total = sum(map(len, docs.values()))
    filled = {s: sum(n for _, n in p) for s, p in places.items()}
    assert sorted(filled) == list(range(-(-total // 1024)))
    assert all(n == 1024 for s, n in filled.items() if s < total // 1024)


def test_odd_rows_over_many_partitions(spark, whole, monkeypatch):
    monkeypatch.setattr(concatenated, "RUN", 100)
    monkeypatch.setattr(concatenated, "BLOCK", 3)
    texts = ["", None, "one", "<|endoftext|>", "many words " * 700, "two  spaces\n", "é😀 ñ", "one"]
    rows = [(None if i == 3 else i % 20, texts[i % len(texts)], "x") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(11)
    for end, capacity in ((0, 16), (None, 1000), (7, 1)):
        pieces = concatenated.concatenated(docs, queries.byte_vocabulary(), capacity, end)
        found = pieces.collect()
        stream = b"".join(bytes(r.ids) for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)))
        assert [r.sequence_id * capacity + r.offset for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))] == np.cumsum([0, *[r.length for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))]])[:-1].tolist()
        # each document lies whole in the stream: its pieces, in the order of the stream, are its ids
        want = sorted(ids_of(whole, t, end).tobytes() for _, t, _ in rows if len(ids_of(whole, t, end)))
        got, current = [], b""
        for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
            if r.start == 0 and current:
                got.append(current)
                current = b""
            current += bytes(r.ids)
        assert sorted([*got, current]) == want and len(stream) == sum(map(len, want))


def test_windows_have_boundaries_and_padding(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9)) for i in range(50)] + [(50, None)], "doc_id long, text string")
    pieces = concatenated.concatenated(docs, queries.byte_vocabulary(), 64)
    rows = sorted(concatenated.windows(pieces, 64, pad=9).collect())
    total = sum(r.n_tokens for r in rows)
    for k, r in enumerate(rows):
        ids = np.frombuffer(bytes(r.ids), "<u4")
        power = r.n_tokens & (r.n_tokens - 1) == 0
        assert r.sequence_id == k and r.n_tokens == min(64, total - 64 * k) and len(ids) == (r.n_tokens if power else 64)
        assert set(ids[r.n_tokens :].tolist()) <= {9}
        assert r.boundaries[0].offset == 0 and r.boundaries[-1].offset + r.boundaries[-1].length == r.n_tokens
        for before, after in zip(r.boundaries, r.boundaries[1:], strict=False):
            assert after.offset == before.offset + before.length and after.start == 0
    short = concatenated.windows(concatenated.concatenated(docs.where("doc_id = 50"), queries.byte_vocabulary(), 64), 64).first()
    assert (short.n_tokens, len(short.ids)) == (1, 4)
    assert concatenated.concatenated(docs.limit(0), queries.byte_vocabulary()).count() == 0


def test_offsets_of_many_partitions(spark):
    runs = spark.range(5000).select((F.col("id") * 3).cast("int").alias("part"), (F.col("id") % 7 + 1).alias("length"))
    got = {r.part: r.base for r in concatenated.partition_offsets(runs).collect()}
    at = 0
    for i in range(5000):
        assert got[3 * i] == at
        at += i % 7 + 1
