"""Token sequences packed by the sum-of-squares rule.

Every document is encoded with a given public tokenizer, ended with one end id, and cut
into pieces of at most ``capacity`` tokens.  Pieces are dealt by hash into groups of about
``GROUP`` pieces (their number follows the table), and inside each group, longest first,
a piece goes where the sum over residual gaps of (open sequences with that gap) squared
becomes smallest; opening a new sequence is one of the choices.  Only piece lengths move.
"""

from __future__ import annotations

import gc
import math
import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomkit.llm import chunks
from loomkit.session import cut_lineage

CAPACITY, END_ID, GROUP = 4096, 1, 50_000
#: bare words that a worker keeps, emptied when full
WORDS = 400_000
#: marks that may follow a word; inside a word they join or split others
MARKS = string.punctuation
#: words encoded in one call
RUN = 200
_TOKENIZERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts chunk by chunk.

    The tokenizer drops white space and never joins across it, so a text's ids are those
    of its chunks (``chunks.runs``) in order; each distinct chunk is encoded once and kept
    by its hash.  A chunk of letters with ASCII marks behind it is two of the tokenizer's
    words, looked up apart, the letters in lower case as the tokenizer has them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.stems: dict[str, list[int]] = {}
        self.marks: dict[str, list[int]] = {"": []}
        self.known = chunks.Known()

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, new: list[str]) -> None:
        if len(self.stems) + len(new) > WORDS:
            self.stems.clear()
        runs = [" ".join(new[i:i + RUN]) for i in range(0, len(new), RUN)]
        ids = [i for one in self._plain(runs) for i in one]
        ends = (np.flatnonzero(self.ends[np.array(ids, dtype=np.int64)]) + 1).tolist() if ids else []
        if len(ends) == len(new):
            at = 0
            for word, end in zip(new, ends):
                self.stems[word] = ids[at:end]
                at = end
        else:  # some word was split further: one by one
            self.stems.update(zip(new, self._plain(new)))

    def encode_chunks(self, texts: list[str]) -> list[list[int]]:
        """Ids of every chunk."""
        out: list[list[int] | None] = [None] * len(texts)
        easy, hard = [], []
        for k, chunk in enumerate(texts):
            chunk = chunk.strip(" \t\n")
            stem = chunk.rstrip(MARKS)
            if len(stem) < 64 and stem.isalpha() and (stem.isascii() or not ("Σ" in stem or "İ" in stem)):
                easy.append((k, stem.lower(), chunk[len(stem):]))
            else:
                hard.append(k)
        marks = list({m for _, _, m in easy} - self.marks.keys())
        self.marks.update(zip(marks, self._plain(marks)))
        new = list({s for _, s, _ in easy} - self.stems.keys())
        if len(self.stems) + len(new) > WORDS:
            new = list({s for _, s, _ in easy})
        if new:
            self._words(new)
        for k, stem, mark in easy:
            out[k] = self.stems[stem] + self.marks[mark]
        for k, ids in zip(hard, self._plain([texts[k] for k in hard])):
            out[k] = ids
        if len(self.marks) > WORDS:
            self.marks = {"": []}
        return out

    def _new_chunks(self, run: chunks.Run, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, ends = run.chunk_bytes(which), np.cumsum(run.size[which]).tolist()
        texts, at = [], 0
        for end in ends:
            texts.append(raw[at:end].decode())
            at = end
        found = self.encode_chunks(texts)
        return (np.array([len(f) for f in found], dtype=np.int64),
                np.array([i for f in found for i in f], dtype=np.int32))

    def text_ids(self, run: chunks.Run) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, ids)`` of the run's texts."""
        gc.disable()  # many small lists and no cycles to find
        try:
            return chunks.text_ids(run, *self.known.ids_of(run, self._new_chunks))
        finally:
            gc.enable()


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _TOKENIZERS.get(path)
        if encoder is None:
            encoder = _TOKENIZERS[path] = Encoder(path)
        for batch in batches:
            doc = batch.column("doc_id")
            for part in chunks.runs(batch.column("text")):
                counts, ids = encoder.text_ids(part)
                at = chunks.offsets_of(counts + 1)
                whole = np.full(int(at[-1]), end_id, dtype="<u4")
                whole[chunks.spans(at[:-1], counts)] = ids
                per = -(-(counts + 1) // capacity)
                piece = chunks.spans(np.zeros(len(per), dtype=np.int64), per)
                start = piece * capacity
                begin = np.repeat(at[:-1], per) + start
                length = np.minimum(begin + capacity, np.repeat(at[1:], per)) - begin
                view = memoryview(whole).cast("B")
                crc = [zlib.crc32(view[4 * b:4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())]
                owner = doc.slice(part.first, part.last - part.first).take(pa.array(np.repeat(np.arange(len(per)), per)))
                yield pa.RecordBatch.from_arrays(
                    [owner, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document; null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_pieces(tokenizer, capacity, end_id),
                    "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length, placed in the order given.

    Moving a sequence from gap g to g - s changes the sum by
    ``-2 N(g) + 1 + 2 N(g - s) + 1`` (full sequences count nothing).  Ties go to the
    smallest gap, and to an open sequence before a new one.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, bins = [], [], 0
    closed = np.iinfo(np.int64).max
    for s in lengths:
        after = 2 * count[:capacity + 1 - s] + 1
        after[0] = 0
        change = np.where(count[s:] > 0, after - 2 * count[s:] + 1, closed)
        best = int(change.argmin())
        if change[best] <= int(after[capacity - s]):
            gap = best + s
            mine = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, mine, bins = capacity, bins, bins + 1
        sequence.append(mine)
        offset.append(capacity - gap)
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(mine)
    return sequence, offset


def _pack(groups: int, capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        if not table.num_rows:
            return table.drop_columns(["group"]).append_column("sequence_id", pa.array([], pa.int64())) \
                .append_column("offset", pa.array([], pa.int64()))
        sequence, offset = sum_of_squares(table["length"].to_pylist(), capacity)
        group = table["group"][0].as_py()
        return table.drop_columns(["group"]) \
            .append_column("sequence_id", pa.array(np.array(sequence, dtype=np.int64) * groups + group)) \
            .append_column("offset", pa.array(offset, pa.int64()))
    return run


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   group: int = GROUP) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    Null and empty texts are one piece holding only the end id.  Repeated rows are packed
    as often as they occur; equal lengths go by doc_id and piece.  An empty table gives an
    empty result; other columns are ignored.
    """
    pieces = cut_lineage(token_pieces(docs, tokenizer, capacity, end_id))
    groups = max(1, math.ceil(pieces.count() / group))
    return (pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
            .groupBy("group").applyInArrow(
                _pack(groups, capacity),
                "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
