"""Benchmark passages in training documents through a positional inverted index.

Every run of documents (about CHUNK_BYTES) becomes one shard of the index: for each
benchmark term its sorted postings, so the index is spread over all tasks and never moves.
A benchmark window is looked up rarest term first: the rarest term's postings, shifted by
its place in the window, are the candidate starts, and each further term's shifted
postings are intersected with them, next rarest first.  What is left are exact phrase
matches.  For proximity matches the words must come in order with at most ``slop`` other
words between them.

Windows are distinct, dealt into blocks of about ``WINDOWS`` by hash; one block at a time
is broadcast (its size bound), and every block is run against all documents.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomkit.llm.words import word_hashes
from loomkit.session import cut_lineage

SIZE, SLOP, WINDOWS = 10, 2, 50_000
#: word characters: digits, letters (A-Z as a-z) and every byte of a non-ASCII character
BREAKS = np.ones(256, dtype=bool)
BREAKS[ord("0"):ord("9") + 1] = BREAKS[ord("A"):ord("Z") + 1] = BREAKS[ord("a"):ord("z") + 1] = False
BREAKS[128:] = False
_RESULT = ("doc_id long, text_key long, n_words long, starts array<long>, ends array<long>, "
           "items array<string>, near array<string>")


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("item_id").to_pylist()
            for first, _, hashes, counts in word_hashes(batch.column("text"), BREAKS):
                own, wins, at = [], [], 0
                for i, c in enumerate(counts.tolist()):
                    for b in range(at, at + max(c - size, 0) + 1 if c else at):
                        own.append(items[first + i])
                        wins.append(hashes[b:min(b + size, at + c)].tobytes())
                    at += c
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(wins, pa.binary())],
                                                 ["item_id", "window"])
    return run


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``(window, items)``: distinct windows of word hashes and the items that hold them."""
    rows = benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_item_windows(size), "item_id string, window binary") \
        .groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


class Queries:
    """A block of windows: their terms as numbers of a sorted vocabulary."""

    def __init__(self, rows: list[tuple[bytes, list[str]]], size: int):
        words = [np.frombuffer(w, dtype=np.uint64) for w, _ in rows]
        self.items = [items for _, items in rows]
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.empty(0, dtype=np.uint64)
        self.terms = np.full((len(rows), size), -1, dtype=np.int64)
        for i, w in enumerate(words):
            self.terms[i, :len(w)] = np.searchsorted(self.vocabulary, w)


class Shard:
    """Positional postings of one run of documents, for the terms of a block."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, vocabulary: np.ndarray):
        term = np.searchsorted(vocabulary, hashes)
        at = np.flatnonzero(vocabulary[np.minimum(term, len(vocabulary) - 1)] == hashes) if len(vocabulary) \
            else np.empty(0, dtype=np.int64)
        self.words = len(hashes)
        # postings, sorted by term and then place, as one key each
        self.postings = np.sort(term[at] * (self.words + 1) + at)
        self.frequency = np.bincount(term[at], minlength=len(vocabulary))
        self.begin = np.cumsum(self.frequency) - self.frequency
        self.doc = np.repeat(np.arange(len(counts)), counts)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < self.words)
        key = term * (self.words + 1) + np.where(inside, place, self.words)
        found = np.searchsorted(self.postings, key)
        return inside & (found < len(self.postings)) & (
            self.postings[np.minimum(found, max(len(self.postings) - 1, 0))] == key)

    def following(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The term's first posting behind ``place``; ``words`` when there is none."""
        found = np.searchsorted(self.postings, term * (self.words + 1) + place, "right")
        key = self.postings[np.minimum(found, len(self.postings) - 1)]
        ok = (found < len(self.postings)) & (key // (self.words + 1) == term)
        return np.where(ok, key % (self.words + 1), self.words)

    def seeds(self, q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose terms all occur; their terms' order, rarest first; shifted postings
        of the rarest term as ``(window, start)``."""
        often = np.where(q.terms >= 0, self.frequency[np.maximum(q.terms, 0)], np.iinfo(np.int64).max)
        live = np.flatnonzero(often.min(axis=1) > 0)
        order = np.argsort(often[live], axis=1, kind="stable")
        rare = q.terms[live, order[:, 0]]
        n = self.frequency[rare]
        which = np.repeat(np.arange(len(live)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        place = self.postings[self.begin[rare][which] + nth] % (self.words + 1)
        return live, order, np.stack([which, place - order[which, 0]])

    def phrases(self, q: Queries) -> tuple[np.ndarray, np.ndarray]:
        """Exact matches ``(window, start)``."""
        live, order, (which, start) = self.seeds(q)
        for step in range(1, q.terms.shape[1]):
            offset = order[which, step]
            term = q.terms[live[which], offset]
            keep = (term < 0) | self.has(np.maximum(term, 0), start + offset)
            which, start = which[keep], start[keep]
        window = live[which]
        end = start + q.length[window] - 1
        ok = (start >= 0) & (end < self.words)
        window, start, end = window[ok], start[ok], end[ok]
        ok = self.doc[start] == self.doc[end]
        return window[ok], start[ok]

    def near(self, q: Queries, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Ordered matches ``(window, document)`` with at most ``slop`` words between."""
        live, _, (which, start) = self.seeds(q)
        which = np.repeat(which, slop + 1)
        start = (start[:, None] - np.arange(slop + 1)).ravel()
        window = live[which]
        ok = self.has(q.terms[window, 0], start)
        window, start = window[ok], start[ok]
        last = start.copy()
        for step in range(1, q.terms.shape[1]):
            term = q.terms[window, step]
            last = np.where(term >= 0, self.following(np.maximum(term, 0), last), last)
            ok = (last < self.words) & (last - start < q.length[window] + slop)
            window, start, last = window[ok], start[ok], last[ok]
        ok = self.doc[start] == self.doc[last]
        return window[ok], self.doc[start[ok]]


def _search(queries, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        for batch in batches:
            ids = batch.column("doc_id")
            keys = batch.column("text_key")
            for first, last, hashes, counts in word_hashes(batch.column("text"), BREAKS):
                n = last - first
                spans: list[list] = [[] for _ in range(n)]
                items: list[set] = [set() for _ in range(n)]
                near: list[set] = [set() for _ in range(n)]
                if len(hashes) and len(q.vocabulary):
                    shard = Shard(hashes, counts, q.vocabulary)
                    begin = np.cumsum(counts) - counts
                    window, start = shard.phrases(q)
                    for w, s in zip(window.tolist(), start.tolist()):
                        d = int(shard.doc[s])
                        spans[d].append((s - int(begin[d]), s - int(begin[d]) + int(q.length[w])))
                        items[d].update(q.items[w])
                    for w, d in zip(*(x.tolist() for x in shard.near(q, slop))):
                        near[d].update(q.items[w])
                spans = [_merged(s) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), keys.slice(first, n), pa.array(counts, pa.int64()),
                     pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
                     pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                     pa.array([sorted(x) for x in near], pa.list_(pa.string()))],
                    ["doc_id", "text_key", "n_words", "starts", "ends", "items", "near"])
    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from its rows of all blocks (a list each)."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            spans = _merged([(a, b) for p in r["parts"] for a, b in zip(p["starts"], p["ends"])])
            out.append({"doc_id": r["doc_id"], "text_key": r["text_key"], "n_words": r["n_words"],
                        "starts": [a for a, _ in spans], "ends": [b for _, b in spans],
                        "items": sorted({x for p in r["parts"] for x in p["items"]}),
                        "near": sorted({x for p in r["parts"] for x in p["near"]})})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()),
                 ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                 ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string()))]))


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int = SLOP,
                  windows: int = WINDOWS) -> DataFrame:
    """``(doc_id, n_words, starts, ends, items, near)`` for every row of ``docs``.

    ``starts``/``ends`` are the merged hit spans in words, ``items`` the benchmark items with
    an occurring window, ``near`` those with a proximity match.  Null and empty texts, and
    items without words, match nothing; items without an id are left out.  Repeated rows
    give one result row each; an empty benchmark leaves all documents clean; an empty
    document table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    found = cut_lineage(item_windows(benchmark, size))
    blocks = max(1, math.ceil(found.count() / windows))
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))
    parts = None
    for b in range(blocks):
        # a block holds about ``windows`` windows of ``size`` words: a few MB
        block = found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b).orderBy("window").collect()
        queries = spark.sparkContext.broadcast(Queries([(bytes(r["window"]), r["items"]) for r in block], size))
        part = rows.mapInArrow(_search(queries, slop), _RESULT)
        parts = part if parts is None else parts.unionByName(part)
    if blocks == 1:
        return parts.drop("text_key")
    keys = ["doc_id", "text_key"]
    one = parts.groupBy(*keys).agg(F.first("n_words").alias("n_words"), F.collect_list(
        F.struct("starts", "ends", "items", "near")).alias("parts")).mapInArrow(_combine, _RESULT)
    again = [rows[k].eqNullSafe(one[k]) for k in keys]
    return rows.select(*keys).join(one, again[0] & again[1]).select(
        rows["doc_id"], "n_words", "starts", "ends", "items", "near")


def decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, ..)`` per row of ``docs``."""
    found = find_passages(docs, benchmark, **options)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` without a hit; columns as they came.  Rows that share the id of a
    contaminated row (null is one such id) go with it."""
    found = decontamination(docs, benchmark, **options)
    bad = found.where("contaminated").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["__bad"]), "left_anti")
