"""Ranked lexical search by dense blocked matrix products.

Every document is scored for every item.  A tile of documents is a dense matrix of impacts
over the item terms that occur in it, a tile of items a dense matrix of weights over the
same terms; both hold whole numbers in float64 and BLAS multiplies them.  A product over
``term_tile`` terms stays below 2^53, so it is exact; the products are added in 64-bit
integers.  Each task keeps its best ``k`` documents per item, equal scores by ascending id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomkit.llm.words import word_hashes

TOP = 10
#: items, and characters of their texts, that one pass over the documents takes
ITEMS, ITEM_CHARS = 1024, 8_000_000
#: documents and terms of one product
DOC_TILE, TERM_TILE = 1024, 4096
#: an impact stays below this
TOP_IMPACT = 1_000_000
#: parts in which an item's candidates are ranked before they meet
PARTS = 32

_GAP = np.ones(256, dtype=bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Items:
    """A block of items: their terms as places in one sorted vocabulary of hashes."""

    def __init__(self, ids: list, texts: list[str | None], first_row: int):
        self.ids, self.first_row = ids, first_row
        hashes, counts = [], []
        for _, _, h, c in word_hashes(pa.array(texts, pa.string()), _GAP):
            hashes.append(h)
            counts.append(c)
        every, number = np.concatenate(hashes), np.concatenate(counts)
        self.vocabulary, place = np.unique(every, return_inverse=True)
        pairs = np.unique(np.repeat(np.arange(len(ids)), number) << 32 | place)
        self.item, self.place = pairs >> 32, pairs & 0xFFFFFFFF

    def occurrences(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, place, tf)`` of the item terms in texts of the given words."""
        at = np.searchsorted(self.vocabulary, hashes)
        found = at < len(self.vocabulary)
        found[found] = self.vocabulary[at[found]] == hashes[found]
        text = np.repeat(np.arange(len(counts)), counts)
        pairs, tf = np.unique(text[found] << 32 | at[found], return_counts=True)
        return pairs >> 32, pairs & 0xFFFFFFFF, tf


def _count(items: Items):
    """Per task: documents with a term (place -1), their terms (-2) and documents per item term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(items.vocabulary), dtype=np.int64)
        documents = terms = 0
        for batch in batches:
            for _, _, hashes, counts in word_hashes(batch.column("text"), _GAP):
                documents += int((counts > 0).sum())
                terms += len(hashes)
                np.add.at(held, items.occurrences(hashes, counts)[1], 1)
        place = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *place.tolist()], pa.int64()),
             pa.array([documents, terms, *held[place].tolist()], pa.int64())], ["place", "n"])
    return run


def length_norms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``100 - 90 + (90 n N) div L``; in Python integers, as the product may pass 64 bits."""
    distinct, place = np.unique(n, return_inverse=True)
    return np.array([10 + 90 * x * documents // terms for x in distinct.tolist()], dtype=np.int64)[place]


class Scorer:
    """Scores of document tiles for a block of items."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, terms: int, k: int):
        self.items, self.weight, self.documents, self.terms, self.k = items, weight, documents, terms, k
        top = int(weight.max()) if len(weight) else 0
        self.term_tile = max(1, min(TERM_TILE, (2**53 - 1) // max(1, top * TOP_IMPACT)))
        self.best = np.empty((0, 4), dtype=np.int64)   # item, score, id is null, id
        self.bar = np.zeros(len(items.ids), dtype=np.int64)

    def scores(self, size: int, doc: np.ndarray, place: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Items x documents, exact."""
        used, column = np.unique(place, return_inverse=True)
        where = np.full(len(self.weight), -1, dtype=np.int64)
        where[used] = np.arange(len(used))
        item_column = where[self.items.place]
        total = np.zeros((len(self.items.ids), size), dtype=np.int64)
        for low in range(0, len(used), self.term_tile):
            high = min(low + self.term_tile, len(used))
            left, right = np.zeros((len(total), high - low)), np.zeros((high - low, size))
            mine = (item_column >= low) & (item_column < high)
            left[self.items.item[mine], item_column[mine] - low] = self.weight[self.items.place[mine]]
            here = (column >= low) & (column < high)
            right[column[here] - low, doc[here]] = impact[here]
            total += (left @ right).astype(np.int64)
        return total

    def take(self, ids: list, counts: np.ndarray, hashes: np.ndarray) -> None:
        """Score a tile; what may be among an item's best joins the candidates."""
        doc, place, tf = self.items.occurrences(hashes, counts)
        if not len(doc):
            return
        norm = length_norms(counts, self.documents, self.terms)[doc]
        total = self.scores(len(counts), doc, place, (10**9 * tf) // (1000 * tf + 8 * norm))
        item, at = np.nonzero((total > 0) & (total >= self.bar[:, None]))
        missing = np.array([i is None for i in ids], dtype=np.int64)
        number = np.array([i or 0 for i in ids], dtype=np.int64)
        self.keep(np.column_stack([item, total[item, at], missing[at], number[at]]))

    def keep(self, rows: np.ndarray) -> None:
        rows = np.concatenate([self.best, rows])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        rank = np.arange(len(rows)) - first
        self.best = rows[rank < self.k]
        full = rows[rank == self.k - 1]
        self.bar[full[:, 0]] = full[:, 1]


def _search(items: Items, weight: np.ndarray, documents: int, terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(items, weight, documents, terms, k)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, last, hashes, counts in word_hashes(batch.column("text"), _GAP):
                ends = np.append(0, np.cumsum(counts))
                for a in range(0, last - first, DOC_TILE):
                    b = min(a + DOC_TILE, last - first)
                    scorer.take(ids[first + a:first + b], counts[a:b], hashes[ends[a]:ends[b]])
        best = scorer.best
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[:, 0] + items.first_row, pa.int64()),
             pa.array(best[:, 3], pa.int64(), mask=best[:, 2].astype(bool)),
             pa.array(best[:, 1], pa.int64())], ["item_row", "doc_id", "score"])
    return run


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list]]:
    """Items in blocks of a bounded size; equal rows stand in one block."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("c")).first()
    blocks = max(1, math.ceil(max(size["n"] / ITEMS, size["c"] / ITEM_CHARS)))
    for block in range(blocks):
        held = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = held.collect()
        if found:
            yield [r["item_id"] for r in found], [r["text"] for r in found]


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every row of ``items``.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
    Documents and items without a term get no rows.  Equal scores go by ascending id, a null id
    last; every document row counts, so a repeated one takes several ranks.  An item row
    is ranked by itself, also with a null or repeated id.  Empty tables give an empty
    result; other columns are ignored.  Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    found, names, row = None, [], 0
    for ids, texts in _item_blocks(items):
        block = Items(ids, texts, row)
        counted = {r["place"]: r["n"] for r in docs.select("text").mapInArrow(_count(block), "place long, n long")
                   .groupBy("place").agg(F.sum("n").alias("n")).collect()}
        documents, terms = counted.get(-1, 0), counted.get(-2, 0)
        held = np.array([counted.get(i, 0) for i in range(len(block.vocabulary))], dtype=np.int64)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in held.tolist()],
                          dtype=np.int64)
        some = docs.mapInArrow(_search(block, weight, documents, terms, k), "item_row long, doc_id long, score long")
        found = some if found is None else found.unionByName(some)
        names += [(row + i, item) for i, item in enumerate(ids)]
        row += len(ids)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["item_row", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))], ["item_row"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))) \
            .where(F.col("rank") <= k)
    named = spark.createDataFrame(names, f"item_row long, item_id {kind}")
    return found.join(named, "item_row").select("item_id", "rank", "doc_id", "score")
