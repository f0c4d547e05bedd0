"""Words of whole Arrow batches as byte spans and 64-bit hashes, computed by numpy without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once, so that memory does not follow the size of an Arrow batch.
BLOCK_BYTES = 4 << 20
_HASH_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0xD1342543DE82EF95)

#: Bytes of words between ASCII white space (blank, tab to carriage return).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and all characters beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A to Z in lower case."""
    return _FOLD[data]


@dataclass
class Words:
    """Words of several texts: word w is `data[start[w]:end[w]]`, text i has the words `first[i]` to `first[i + 1]`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column of at most `block_bytes`, or one longer text: first row, end, offsets, bytes."""
    column = pc.fill_null(column.cast(pa.string()), "")
    _, offsets, data = column.buffers()
    offset = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offset, offset[low] + block_bytes, "right")) - 1)
        yield low, high, offset[low : high + 1] - offset[low], data[offset[low] : offset[high]]
        low = high


def split_words(offset: np.ndarray, data: np.ndarray, word_bytes: np.ndarray, fold: bool = False) -> Words:
    """Maximal runs of `word_bytes` inside each text; `fold` lower-cases A to Z."""
    if fold:
        data = _FOLD[data]
    inside = word_bytes[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offset] = True  # a word never goes on from one text to the next
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | begins[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | begins[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offset))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U64(27))
    values = values * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """At least `count` powers of an odd number modulo 2^64, from the first one on."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, _HASH_BYTES + 1), U64(base & (2**64 - 1)))
        known[0] = 1
        _POWERS[base] = known = np.multiply.accumulate(known)
    return known


def word_hashes(words: Words) -> np.ndarray:
    """One 64-bit hash for each word: a polynomial of its bytes taken from prefix sums, then mixed."""
    result = np.empty(len(words.start), U64)
    inverse = pow(_BASE, -1, 2**64)
    low = 0
    while low < len(result):
        origin = int(words.start[low])
        high = max(low + 1, int(np.searchsorted(words.end, origin + _HASH_BYTES, "right")))
        part = words.data[origin : words.end[high - 1]].astype(U64) + U64(1)
        prefix = np.concatenate(([U64(0)], np.cumsum(part * powers(_BASE, len(part))[: len(part)], dtype=U64)))
        start, end = words.start[low:high] - origin, words.end[low:high] - origin
        value = (prefix[end] - prefix[start]) * powers(inverse, len(part) + 1)[start]
        result[low:high] = mixed(value + (end - start).astype(U64) * _STEP)
        low = high
    return result


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of `length` consecutive hashes; the length takes part."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, U64)
    value = np.full(count, U64(length))
    for shift in range(length):
        value = value * _STEP + hashes[shift : shift + count]
    return mixed(value)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
