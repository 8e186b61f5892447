"""Words of Arrow string columns as 64-bit hashes, computed over whole buffers with numpy.

The UTF-8 bytes of a batch are hashed in place, without a Python object per word. A word is a run of bytes that a
table marks as word bytes; bytes from 0x80 on always are, so a run of bytes is also a run of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at once: the temporary arrays of eight bytes per text byte stay in a core's cache.
CHUNK = 1 << 16
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def byte_table(separators: str, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the byte each stands for (A-Z as a-z if ``lower``)."""
    inside = np.ones(256, dtype=bool)
    inside[[ord(c) for c in separators]] = False
    stands = np.arange(256, dtype=np.uint8)
    if lower:
        stands[65:91] += 32
        inside[65:91] = inside[97:123]
    return inside, stands


#: Words are runs of anything but white space.
SPACED = byte_table(" \t\n\v\f\r")
#: Words are runs of 0-9, a-z and everything beyond ASCII.
ALNUM = byte_table("".join(chr(c) for c in range(128) if not chr(c).isalnum()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_PLACES = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


@dataclass
class Words:
    """Words of some texts in order: hash, place of the first byte, and per text the range of its words."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # text i has the words first[i] ... first[i + 1] - 1


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)


def words_of(column: pa.Array, table: tuple[np.ndarray, np.ndarray] = SPACED) -> Words:
    """The words of each text of ``column``; a word never spans two texts."""
    offsets, data = buffers(column)
    if not len(column):
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    low, high = int(offsets[0]), int(offsets[-1])
    data, offsets = data[low:high], offsets - low
    inside, stands = table
    is_word = inside[data]
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]  # first bytes of texts begin a word whatever stands before
    starts[heads] = is_word[heads]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | starts[1:]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    # hash = sum of letter * M^i over the word, brought back to i = 0 by M^-begin; sums run per chunk of whole words
    hashes = np.empty(len(begin), dtype=np.uint64)
    letters = _LETTERS[stands]
    k = 0
    while k < len(begin):
        stop = max(k + 1, int(np.searchsorted(end, begin[k] + CHUNK, side="right")))
        a, b = int(begin[k]), int(end[stop - 1])
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(letters[data[a:b]] * _power_table(_MULTIPLIER, b - a), out=sums[1:])
        own = sums[end[k:stop] - a] - sums[begin[k:stop] - a]
        hashes[k:stop] = own * _power_table(_INVERSE, b - a)[begin[k:stop] - a]
        k = stop
    hashes = mix(hashes ^ ((end - begin).astype(np.uint64) << np.uint64(48)))
    return Words(hashes, begin + low, end + low, np.searchsorted(begin, offsets))


_TABLES: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers of ``base``; a word longer than a chunk gets a longer table that is not kept."""
    if n > CHUNK:
        return _powers(base, n)
    if base not in _TABLES:
        _TABLES[base] = _powers(base, CHUNK)
    return _TABLES[base][:n]


def sliced(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in ``column`` hold at most ``most`` bytes, or one row."""
    offsets, _ = buffers(batch.column(column))
    k = 0
    while k < batch.num_rows:
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + most, side="right")) - 1)
        yield batch.slice(k, stop - k)
        k = stop


def shingles_of(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles per text, sorted within it: hashes, and the range of each text.

    A text with fewer words has its whole sequence as one shingle; a text without words has none.
    """
    h, first = words.hashes, words.first
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    bound = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(int(bound[-1]), dtype=np.uint64)
    if len(h) >= width:
        whole = np.zeros(len(h) - width + 1, dtype=np.uint64)
        for i in range(width):
            whole += h[i : len(h) - width + 1 + i] * _PLACES[i]
        whole = mix(whole)
    fresh = np.ones(len(out), dtype=bool)
    for a, b, at, m in zip(bound[:-1].tolist(), bound[1:].tolist(), first[:-1].tolist(), n.tolist(), strict=True):
        if m >= width:
            part = out[a:b]
            part[:] = whole[at : at + b - a]
            part.sort()
            fresh[a + 1 : b] = part[1:] != part[:-1]
        elif m:
            out[a] = mix(np.array([int((h[at : at + m] * _PLACES[:m]).sum()) + m & (2**64 - 1)], dtype=np.uint64))[0]
    if fresh.all():
        return out, bound
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[bound]
