"""Token ids of whole texts, with a bounded cache of the ids of words."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published pre-tokenisation pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a task remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 1 << 18, 64
_RUN_OF_SPACES = re.compile(r"\s\s")


class WordIds(dict):
    """Ids, as little-endian unsigned 32-bit numbers, of a space and the word after it.

    Every match of the pattern begins at a space that follows no white space, so a text without two white space
    characters in a row can be cut before each space and its parts looked up. Other texts are encoded whole.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encoded(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.encoded(f" {word}")
        if len(word) <= LONGEST and len(self) < REMEMBERED:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if _RUN_OF_SPACES.search(text):
            return self.encoded(text)
        head, *rest = text.split(" ")
        return self.encoded(head) + b"".join(map(self.__getitem__, rest))


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Ids of the tokens that the tokenizer's JSON beside the ranks adds to them; a kind that takes in its surroundings is an error."""
    path = Path(vocabulary).with_suffix(".json")
    added = json.loads(path.read_text(encoding="utf-8"))["added_tokens"]
    if odd := [t["content"] for t in added if t["lstrip"] or t["rstrip"] or t["single_word"]]:
        raise ValueError(f"added tokens {odd} are not plain strings")
    return {t["content"]: t["id"] for t in added}


def added_pattern(added: dict[str, int]) -> re.Pattern[str] | None:
    """Finds the added tokens in a text, the longest first."""
    return re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None


def with_added(ids_of: WordIds, text: str, added: dict[str, int], places: re.Pattern[str] | None) -> bytes:
    """Ids of a text in which each added token, leftmost and longest first, has its own id; the parts between are texts of their own."""
    if places is None or not places.search(text):
        return ids_of.of(text)
    parts = places.split(text)  # the odd ones are added tokens
    return b"".join(added[part].to_bytes(4, "little") if i % 2 else ids_of.of(part) for i, part in enumerate(parts))


@cache
def word_ids(vocabulary: str) -> WordIds:
    """One cache per Python worker."""
    return WordIds(vocabulary)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end: int | None = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: ``doc_id, piece, start, length, ids``.

    ``ids`` is binary, four little-endian bytes per id. A document's ids are those of its whole text, in which strings
    of added tokens have their ids, followed by ``end``. Only documents longer than the capacity are cut; every piece but the first is full. A null text is an
    empty one (a piece with ``end`` alone); without ``end`` an empty document has no piece. A null key stays null;
    repeated rows are documents of their own; other columns are left out.
    """
    size = 4 * capacity
    added = added_tokens(vocabulary)
    tail = b"" if end is None else int(end).to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(vocabulary)
        places = added_pattern(added)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = with_added(ids_of, content.as_py() or "", added, places) + tail
                at = len(ids) % size or min(size, len(ids))
                bounds = [0, *range(at, len(ids) + 1, size)] if ids else [0]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc, piece, a // 4, (b - a) // 4, ids[a:b]))
                held += len(ids)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    kind = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(cut, kind)


def digest(ids: Column) -> Column:
    """Unsigned CRC-32 of the bytes of the ids."""
    return F.crc32(ids)
