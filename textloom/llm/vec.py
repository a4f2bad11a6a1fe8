"""Vectorised text primitives over Arrow string columns.

Every kernel works on one flat UTF-8 buffer plus document offsets, so that cost
per document is a few array operations and no Python string is built per word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one kernel call looks at; a longer document goes alone.
SLICE_BYTES = 2_000_000
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@functools.cache
def _powers(bits: int, base: int) -> np.ndarray:
    out = np.full(1 << bits, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(max(10, int(n - 1).bit_length() if n > 1 else 1), base)[:n]


@functools.cache
def separators() -> np.ndarray:
    """True at the bytes 0x20 and 0x09-0x0D."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(o):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    d = np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `limit` bytes of text each."""
    if not batch.num_rows:
        return
    _, o = buffers(batch.column(column))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(o, o[a] + limit, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of the words `[^\\x20\\x09-\\x0D]+` of each document."""
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = ~separators()[data]
    start = inside[:n].copy()
    start[1:] &= ~inside[: n - 1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    start[cut] = inside[cut]
    starts = np.flatnonzero(start)
    stop = inside[:n] & ~inside[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    stop[last] = inside[last]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte as one word; past the end they are zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


#: What is left of a word when only its first 0 to 8 bytes count.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end].

    Eight bytes at a time are mixed with their place and summed, so no regular
    text (as the Thue-Morse words are for polynomials modulo 2**64) makes two spans meet.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    word, size = lanes(data), ends - starts
    out = mix(word[starts] & _KEEP[np.minimum(size, 8)])
    long = np.flatnonzero(size > 8)
    if len(long):
        count = (size[long] + 7) >> 3
        first = np.cumsum(count) - count
        place = np.arange(int(count.sum())) - np.repeat(first, count)
        at = np.repeat(starts[long], count) + 8 * place
        value = word[at] & _KEEP[np.minimum(np.repeat(ends[long], count) - at, 8)]
        out[long] = np.add.reduceat(mix(mix(value) ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), first)
    return mix(out ^ (size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def equal_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each span has the bytes of the span that `other` points to."""
    size = ends - starts
    same = size == size[other]
    word = lanes(data)
    same &= ((word[starts] ^ word[starts[other]]) & _KEEP[np.minimum(size, 8)]) == 0
    long = np.flatnonzero(same & (size > 8) & (other != np.arange(len(starts))))
    if len(long):
        count = (size[long] + 7) >> 3
        first = np.cumsum(count) - count
        place = 8 * (np.arange(int(count.sum())) - np.repeat(first, count))
        differ = (word[np.repeat(starts[long], count) + place] ^ word[np.repeat(starts[other[long]], count) + place]) & _KEEP[np.minimum(np.repeat(size[long], count) - place, 8)]
        same[long] &= np.bitwise_or.reduceat(differ, first) == 0
    return same


def byte_values(data: np.ndarray) -> np.ndarray:
    return _byte_values()[data]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one run of word hashes (fewer words: one hash of them all)."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        out = mix(out ^ words[j : n - width + 1 + j]) + np.uint64(0x9E3779B97F4A7C15)
    return out
