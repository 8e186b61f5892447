import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loamfold.llm import queries
from loamfold.llm.packing import best_fit_runs, pack, sequences
from loamfold.llm.tokens import token_pieces, word_ids


def one_by_one(lengths, capacity):
    rests = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rests) if r >= n]
        if fitting:
            rests[min(fitting, key=lambda i: rests[i])] -= n
        else:
            rests.append(capacity - n)
    return Counter(rests)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_runs_place_as_one_by_one(lengths):
    runs = best_fit_runs(Counter(lengths), 40)
    used, ranks = Counter(), Counter()
    for r in runs:
        assert r.rank == ranks[r.length]
        ranks[r.length] += r.count
        for j in range(r.count):
            assert used[r.bin + j // r.each] == r.offset + j % r.each * r.length  # gapless
            used[r.bin + j // r.each] += r.length
    assert ranks == Counter(lengths)
    assert Counter(40 - u for u in used.values()) == one_by_one(lengths, 40)


TEXTS = ["", "a", "two  spaces", "a   b", "\n x", " lead", "trail ", "don't it's", "été ñ ß 12 34,5", "tab\tand\x0bvt", "x" * 300, "<|endoftext|> y", " nbsp z", "a \n b", "ab cd " * 3000]


def test_word_cache_gives_the_ids_of_the_library():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    own = word_ids(queries.byte_vocabulary())
    for text in TEXTS:
        assert np.frombuffer(own.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_query_packs_every_document(spark, folder):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    docs = queries.table(spark, folder, "documents").collect()
    want = set()
    for r in docs:
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(min(head, len(ids)), len(ids) + 1, 2048)]
        want |= {(r.doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))}
    rows = queries.RUNNERS["op5_best_fit_packing"](spark, folder).collect()
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert Counter(2048 - sum(n for _, n in p) for p in by.values()) == one_by_one([r.length for r in rows], 2048)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "word " * 5000, None)], "doc_id long, text string, length string")
    pieces = token_pieces(docs, queries.byte_vocabulary())
    rows = pieces.collect()
    assert sorted(r.length for r in rows if r.doc_id != 2) == [1, 1, 1]
    assert [r.length for r in sorted(rows, key=lambda r: (r.piece)) if r.doc_id == 2][1:] == [2048, 2048]
    placed = pack(pieces, ["doc_id", "piece"])
    whole = {r.sequence_id: r for r in sequences(placed).collect()}
    assert sum(len(r.ids) // 4 for r in whole.values()) == sum(r.length for r in rows)
    assert pack(token_pieces(docs.limit(0), queries.byte_vocabulary()), ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, 0), (2, None), (3, 9), (4, 5)], "doc_id long, length int")
    assert {r.doc_id: r.sequence_id for r in pack(odd, ["doc_id"], 8).collect()} == {1: None, 2: None, 3: None, 4: 0}
    with pytest.raises(ValueError, match="sequence_id"):
        pack(odd.withColumnRenamed("doc_id", "sequence_id"), ["length"])
