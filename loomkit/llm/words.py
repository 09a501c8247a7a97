"""Words of UTF-8 texts as numpy arrays: boundaries and 64-bit hashes, batch-wise.

A word is a maximal run of bytes outside white space (``[^\\x20\\x09-\\x0D]+``), A-Z
lower-cased first.  All byte values of UTF-8 sequences are word bytes, so working on
bytes gives the same words as working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes handled at once; bounds the working arrays whatever the batch holds
CHUNK_BYTES = 1 << 21

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data, offsets


def _hash_span(data: np.ndarray, starts_at: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in ``data``; a word also ends where a text starts."""
    word = ~space[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = starts_at[(starts_at > 0) & (starts_at < len(data))]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    nth = np.cumsum(first) - 1
    place = np.arange(len(data)) - starts[np.maximum(nth, 0)]
    place[~word] = 0
    power = _powers(int(place.max()) + 1)
    value = _BYTE[data] * power[place]
    value[~word] = 0
    return mix(np.add.reduceat(value, starts)), starts


def word_hashes(column: pa.Array, space: np.ndarray = _SPACE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first, last, hashes, counts)`` for runs of rows ``first <= row < last``.

    ``hashes`` are the words of those rows in order, ``counts`` the words per row.  Runs
    hold about CHUNK_BYTES; a longer single text is hashed piece by piece at white space.
    """
    data, offsets = utf8(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        last = min(last, n)
        low, high = int(offsets[row]), int(offsets[last])
        if last == row + 1 and high - low > 2 * CHUNK_BYTES:
            parts, at = [], low
            while at < high:
                end = min(high, at + CHUNK_BYTES)
                while end < high and not space[data[end]]:
                    end += 1
                parts.append(_hash_span(data[at:end], np.zeros(1, dtype=np.int64), space)[0])
                at = end
            hashes = np.concatenate(parts)
            counts = np.array([len(hashes)])
        else:
            hashes, starts = _hash_span(data[low:high], offsets[row:last] - low, space)
            counts = np.diff(np.searchsorted(starts, offsets[row:last + 1] - low))
        yield row, last, hashes, counts
        row = last


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles row after row, and their number per row.

    A row with fewer words than ``k`` has its whole sequence as one shingle, a row
    without words none.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    weight = mix(np.arange(1, k + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    n = len(hashes)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total[:max(0, n - j)] += hashes[j:] * weight[j]
    valid = np.ones(n, dtype=bool)
    tail = np.minimum(counts, k - 1)
    for j in range(1, k):
        rows = tail >= j
        valid[ends[rows] - j] = False
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        c, b = int(counts[row]), int(begins[row])
        whole = np.append(hashes[b:b + c] * weight[:c], mix(np.array([c], dtype=np.uint64)))
        total[b] = whole.sum(dtype=np.uint64)
        valid[b] = True
    number = np.where(counts >= k, counts - (k - 1), np.minimum(counts, 1))
    return mix(total[valid]), number


def distinct_per_row(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, concatenated, and their number per row."""
    parts, number, at = [], np.zeros(len(counts), dtype=np.int64), 0
    for row, c in enumerate(counts):
        if c:
            own = np.sort(values[at:at + c])
            keep = np.ones(c, dtype=bool)
            keep[1:] = own[1:] != own[:-1]
            own = own[keep]
            parts.append(own)
            number[row] = len(own)
            at += c
    return (np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)), number
