"""Texts cut into chunks at white space, each distinct chunk encoded once per run of texts.

A chunk begins at each space, tab or newline behind a byte that is no ASCII white space, so
chunks put together are the text and no run of white space is cut.  Tokenizers whose tokens never reach over a chunk's end
give a text's ids as those of its chunks in order.  Chunks are told apart by 64-bit hashes
of their bytes; all work is numpy over runs of about RUN_BYTES, whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from loomkit.llm.words import mix

#: bytes of text worked on at once; a longer text is a run of its own
RUN_BYTES = 1 << 21
#: ids of distinct chunks that a worker keeps between runs (4 bytes each), emptied when full
KNOWN_IDS = 12_000_000
#: white space that is not ASCII; a text with it is one chunk, as tokenizers may join it to ASCII white space
WIDE_SPACE = "\u0085                 　"
#: the mark that piece vocabularies write for a space
SPACE_MARK = "▁"

_BYTE = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE, _START = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_START[[0x20, 0x09, 0x0A]] = True


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums of ``lengths``."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


@dataclass
class Run:
    """Chunks of the texts ``first <= row < last``; ``chunk`` numbers the distinct ones."""

    first: int
    last: int
    data: np.ndarray       # bytes of the texts, each with a space before it
    texts: np.ndarray      # offsets of the texts in ``data``
    per_text: np.ndarray   # chunks of each text
    chunk: np.ndarray      # number of each chunk among the distinct ones
    hashes: np.ndarray     # of the distinct chunks, ascending
    begin: np.ndarray      # where the first of each distinct chunk stands in ``data``
    size: np.ndarray       # its bytes

    def chunk_bytes(self, which: np.ndarray) -> bytes:
        """The chunks ``which``, put together."""
        return self.data[spans(self.begin[which], self.size[which])].tobytes()


def _whole(data: np.ndarray) -> np.ndarray:
    """Places of white space outside ASCII, or of a space mark."""
    hit = np.zeros(len(data), dtype=bool)
    for char in WIDE_SPACE + SPACE_MARK:
        raw = char.encode()
        here = np.flatnonzero(data[:len(data) - len(raw) + 1] == raw[0]) if len(data) >= len(raw) else []
        for j, b in enumerate(raw[1:], 1):
            if len(here):
                here = here[data[here + j] == b]
        if len(here):
            hit[here] = True
    return np.flatnonzero(hit)


def _chunk_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every chunk; they cover ``data`` without gaps."""
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    top = int(place.max()) + 1
    power = np.full(top, _BASE, dtype=np.uint64)
    power[0] = 1
    value = _BYTE[data] * np.multiply.accumulate(power)[place]
    return mix(np.add.reduceat(value, starts))


def runs(column: pa.Array, cut: bool = True, size: int | None = None) -> Iterator[Run]:
    """Runs of a string column, every text with a space put before it; null counts as empty.

    An empty text has no chunk.  With ``cut=False`` each text is one chunk.  ``size`` bytes
    make a run (RUN_BYTES if not given).
    """
    size = size or RUN_BYTES
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    n, row = len(at) - 1, 0
    while row < n:
        last = min(n, max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1))
        lengths = np.diff(at[row:last + 1])
        with_space = lengths + (lengths > 0)
        texts = offsets_of(with_space)
        data = np.full(int(texts[-1]), 0x20, dtype=np.uint8)
        data[spans(texts[:-1] + 1, lengths)] = raw[at[row]:at[last]]
        yield _cut(row, last, data, texts, cut)
        row = last


def _cut(first: int, last: int, data: np.ndarray, texts: np.ndarray, cut: bool) -> Run:
    heads = texts[:-1][np.diff(texts) > 0]
    start = np.zeros(len(data), dtype=bool)
    if cut and len(data):
        start = _START[data]
        start[1:] &= ~_SPACE[data[:-1]]
        for t in np.unique(np.searchsorted(texts, _whole(data), "right") - 1):
            start[texts[t]:texts[t + 1]] = False
    start[heads] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    per_text = np.diff(np.searchsorted(starts, texts))
    if not len(starts):
        none = np.empty(0, dtype=np.int64)
        return Run(first, last, data, texts, per_text, none, none.astype(np.uint64), none, none)
    hashes = _chunk_hashes(data, starts, ends)
    distinct, where, chunk = np.unique(hashes, return_index=True, return_inverse=True)
    return Run(first, last, data, texts, per_text, chunk, distinct, starts[where], (ends - starts)[where])


class Known:
    """Ids of chunks by hash, kept between runs."""

    def __init__(self, limit: int = KNOWN_IDS):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)
        self.begin = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.ids = np.empty(1 << 16, dtype=np.int32)
        self.used = 0

    def _add(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(max(need, self.used), dtype=np.int32)])
        self.ids[self.used:need] = ids
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.begin = np.insert(self.begin, place, self.used + offsets_of(counts)[:-1])
        self.size = np.insert(self.size, place, counts)
        self.used = need

    def ids_of(self, run: Run, encode: Callable[[Run, np.ndarray], tuple[np.ndarray, np.ndarray]]
               ) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, ids)`` of the run's distinct chunks.

        ``encode(run, which)`` gives the same for the chunks not met before.
        """
        if self.used > self.limit:
            self.clear()
        place = np.searchsorted(self.hashes, run.hashes)
        found = place < len(self.hashes)
        found[found] = self.hashes[place[found]] == run.hashes[found]
        new = np.flatnonzero(~found)
        if len(new):
            counts, ids = encode(run, new)
            self._add(run.hashes[new], counts, ids)
            place = np.searchsorted(self.hashes, run.hashes)
        counts = self.size[place]
        return counts, self.ids[spans(self.begin[place], counts)]


def text_ids(run: Run, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(counts, ids)`` of the run's texts from those of its distinct chunks."""
    per_chunk = counts[run.chunk]
    out = ids[spans(offsets_of(counts)[:-1][run.chunk], per_chunk)]
    ends = offsets_of(per_chunk)[offsets_of(run.per_text)]
    return np.diff(ends), out


class Decimals:
    """Numbers below ``n`` in decimal, as eight bytes with room for a mark."""

    def __init__(self, n: int):
        if n > 10_000_000:
            raise ValueError("more than seven digits")
        said = [str(i).encode() for i in range(n)]
        self.digits = np.frombuffer(b"".join(s.ljust(8, b"\0") for s in said), dtype="<u8")
        self.size = np.array([len(s) for s in said], dtype=np.uint8)
        self.held = np.frombuffer(b"".join(b"\1" * (k + 1) + b"\0" * (7 - k) for k in range(8)), dtype="<u8")

    def write(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(bytes, offsets)``: every id with its mark behind it."""
        size = self.size[ids]
        rows = self.digits[ids] | marks.astype(np.uint64) << (size.astype(np.uint64) << np.uint64(3))
        return rows.view(np.uint8)[self.held[size].view(bool)], offsets_of(size.astype(np.int64) + 1)
