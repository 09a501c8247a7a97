"""Alignment of two tokenizers' tokens by diagonal run skipping.

Tokens end at byte offsets.  While the end arrays are equal at the current index shift, an
exponential probe jumps over the stretch of one-to-one tokens; where they part, the
irregular group is followed to the next common end, which sets the new shift.

The corpus-wide counts of linked id pairs go through blocks of about BLOCK_BYTES of text:
a block lists its distinct pairs once with their documents, however often they occur, so a
pair that stands everywhere has one row per block.  Blocks are written once; the counts
come back to them by a join on the pair and a group per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from loomkit.llm import chunks, pieces
from loomkit.llm.chunks import Run, offsets_of, spans
from loomkit.session import cut_lineage

#: text of one block; a longer text is a block of its own
BLOCK_BYTES = 4 << 20
#: text aligned at once, and ids of each tokenizer that a worker keeps; two models share its memory
RUN_BYTES, KNOWN_IDS = 1 << 19, 3_000_000
#: characters handed to the byte-level tokenizer in one string
ENCODE_BYTES = 50_000


class ByteModel:
    """Byte-level merges read from a ``tokenizers`` file whose ids are in merge order."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel
        import public_tokenizers
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocab = said["model"]["vocab"]
        shape = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if said["normalizer"] or any(said["pre_tokenizer"].get(k) != v for k, v in shape.items()):
            raise ValueError("only plain byte-level models are read")
        merges = [m if isinstance(m, list) else m.split(" ") for m in said["model"]["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
            raise ValueError("the ids do not follow the merges")
        visible = _visible_bytes()
        if set(visible) != set(ByteLevel.alphabet()):
            raise ValueError("another byte alphabet")
        token = {i: bytes(visible[c] for c in t) for t, i in vocab.items()}
        self.library = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks={t: i for i, t in token.items()}, special_tokens={})
        self.size = max(token) + 1
        if self.size > 1 << 17:
            raise ValueError("more ids than a pair's key has room for")
        self.width = np.array([len(token.get(i, b"")) for i in range(self.size)], dtype=np.int64)
        self.known = chunks.Known(KNOWN_IDS)

    def _new_chunks(self, run: Run, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks put together are split as each alone, so they are encoded in long strings and cut apart."""
        raw, at = run.chunk_bytes(which), offsets_of(run.size[which])
        cuts = at[np.unique(np.append(np.searchsorted(at, np.arange(0, at[-1], ENCODE_BYTES)), len(at) - 1))].tolist()
        said = [np.array(self.library.encode_ordinary(raw[a:b].decode()), dtype=np.int32)
                for a, b in zip(cuts[:-1], cuts[1:])]
        ids = np.concatenate(said)
        ends = np.cumsum(self.width[ids])
        return np.diff(np.searchsorted(ends, at, "right")), ids

    def run_ids(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        return self.known.ids_of(run, self._new_chunks)


def _visible_bytes() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    table.update({chr(0x100 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


def align(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Group ends ``(i, j)``: after ``i`` and ``j`` tokens both end at the same offset.

    ``a`` and ``b`` are ascending end offsets with the same last one.
    """
    at_a, at_b, length = [], [], []
    i, j, n = 0, 0, len(a)
    while i < n:
        # irregular: go on in whichever array lies behind until both end together
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        # the shift j - i holds from here: probe on in doubling steps, then in halved ones
        at_a.append(i)
        at_b.append(j)
        start, step = i, 2
        i, j = i + 1, j + 1
        while i < n and a[i:i + step] == b[j:j + step]:
            i, j, step = i + step, j + step, 2 * step
        if i >= n:
            length.append(n - start)
            break
        while step > 1:
            step >>= 1
            if a[i:i + step] == b[j:j + step]:
                i, j = i + step, j + step
        length.append(min(i, n) - start)
    size = np.array(length, dtype=np.int64)
    return (spans(np.array(at_a, dtype=np.int64), size) + 1, spans(np.array(at_b, dtype=np.int64), size) + 1)


class Aligned:
    """Tokens, groups and links of the texts of one run.

    Texts that have no tokens by the contract count none: null, empty, or with tokens that
    do not give the text back (a text that holds the piece vocabulary's space mark).
    """

    def __init__(self, run: Run, first: ByteModel, second: pieces.PieceModel):
        a_of, a_ids = first.run_ids(run)
        b_of, b_ids = second.run_ids(run)
        same = self._same_bytes(run, a_of, a_ids, first.width) & self._same_bytes(run, b_of, b_ids, second.width)
        texts = len(run.per_text)
        of_text = np.repeat(np.arange(texts), run.per_text)
        kept = np.ones(texts, dtype=bool)
        kept[of_text[~same[run.chunk]]] = False
        held = kept[of_text]
        run = Run(run.first, run.last, run.data, run.texts, np.where(kept, run.per_text, 0), run.chunk[held],
                  run.hashes, run.begin, run.size)
        self.n_a, self.a = chunks.text_ids(run, a_of, a_ids)
        self.n_b, self.b = chunks.text_ids(run, b_of, b_ids)
        # offsets run on over the texts of the run, so a text's end is a common end
        self.end_a = np.cumsum(first.width[self.a])
        self.end_b = np.cumsum(second.width[self.b])
        self.group_a, self.group_b = align(self.end_a.tolist(), self.end_b.tolist())
        self.n_groups = np.diff(np.searchsorted(self.group_a, offsets_of(self.n_a), "right"))

    @staticmethod
    def _same_bytes(run: Run, counts: np.ndarray, ids: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Distinct chunks whose tokens are as long as they; a mark read as a space is shorter."""
        total = np.zeros(len(counts), dtype=np.int64)
        some = counts > 0
        if some.any():
            total[some] = np.add.reduceat(width[ids], offsets_of(counts)[:-1][some])
        return total == run.size

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(number per text, index in a, index in b)``: each stretch between two ends of either is one link."""
        size = int(self.end_a[-1]) if len(self.end_a) else 0
        ends_a, ends_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        ends_a[self.end_a - 1], ends_b[self.end_b - 1] = True, True
        ends = np.flatnonzero(ends_a | ends_b)
        a = np.cumsum(ends_a)[ends] - ends_a[ends]
        b = np.cumsum(ends_b)[ends] - ends_b[ends]
        return np.diff(np.searchsorted(a, offsets_of(self.n_a))), a, b

    def group_digests(self, table: chunks.Decimals) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` per text; an empty string without tokens."""
        if not len(self.a):
            return [""] * len(self.n_a)
        before_a, before_b = np.append(0, self.group_a[:-1]), np.append(0, self.group_b[:-1])
        per_a, per_b = self.group_a - before_a, self.group_b - before_b
        place_a = np.arange(len(self.a)) + np.repeat(before_b, per_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.group_a, per_b)
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int32)
        marks = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a[self.group_a - 1]] = ord("|")
        marks[place_b[self.group_b - 1]] = ord(";")
        data, at = table.write(ids, marks)
        ends = at[offsets_of(self.n_a + self.n_b)]
        view = memoryview(data)
        return [hashlib.sha256(view[x:y - 1]).hexdigest() if y > x else ""
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


_MODELS: dict[str, ByteModel] = {}


def _models(path_a: str, path_b: str) -> tuple[ByteModel, pieces.PieceModel, bool]:
    if path_a not in _MODELS:
        _MODELS[path_a] = ByteModel(path_a)
    second = pieces.model(path_b)
    second.known.limit = KNOWN_IDS
    return _MODELS[path_a], second, second.cut


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_ends, b_ends)``: the tokens and, per group, how many of each it ends after.

    One row per input row; texts without tokens (null, empty, not given back by their
    tokens) have empty lists.  Null ids and repeated rows stay; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, cut = _models(path_a, path_b)
        for batch in batches:
            doc = batch.column("doc_id")
            for part in chunks.runs(batch.column("text"), cut, RUN_BYTES):
                x = Aligned(part, first, second)
                per = x.n_groups
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(part.first, part.last - part.first), pieces.id_lists(x.n_a, x.a),
                     pieces.id_lists(x.n_b, x.b),
                     pieces.id_lists(per, x.group_a - np.repeat(offsets_of(x.n_a)[:-1], per)),
                     pieces.id_lists(per, x.group_b - np.repeat(offsets_of(x.n_b)[:-1], per))],
                    ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])
    return _input(docs).mapInArrow(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
         "n_links array<long>, groups_sha256 array<string>, n_kinds array<int>, kinds binary, times binary, "
         "pairs array<long>, n_docs array<long>")


class _Block:
    """Texts of one block: columns per text, and the distinct pairs of each as places in the block's list."""

    def __init__(self) -> None:
        self.bytes = 0
        self.columns: list[list] = [[] for _ in range(6)]
        self.keys: list[np.ndarray] = []   # distinct pairs per text, text after text
        self.times: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []

    def add(self, doc_ids: list, x: Aligned, digests: list[str], size_b: int) -> None:
        number, a, b = x.links()
        text = np.repeat(np.arange(len(number)), number)
        # ids stay below 2^17 and the texts of a run below 2^21
        spot, times = np.unique(text << 34 | x.a[a].astype(np.int64) << 17 | x.b[b], return_counts=True)
        self.keys.append(spot & ((1 << 34) - 1))
        self.times.append(times)
        self.kinds.append(np.bincount(spot >> 34, minlength=len(number)))
        for mine, new in zip(self.columns, (doc_ids, x.n_a.tolist(), x.n_b.tolist(), x.n_groups.tolist(),
                                            number.tolist(), digests)):
            mine.extend(new)
        self.bytes += size_b

    def row(self, block: int) -> pa.RecordBatch:
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        distinct, place, n_docs = np.unique(keys, return_inverse=True, return_counts=True)
        kinds = np.concatenate(self.kinds)
        # a text's places ascend, so their differences are small and pack well
        step = np.diff(place, prepend=0)
        step[offsets_of(kinds)[:-1][kinds > 0]] = place[offsets_of(kinds)[:-1][kinds > 0]]
        cells = [block, *self.columns, kinds.tolist(), _packed(step), _packed(times), distinct, n_docs]
        schema = _arrow_schema()
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, schema)], schema=schema)


def _arrow_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    kind = {"block": pa.int64(), "groups_sha256": pa.list_(pa.string()), "n_kinds": pa.list_(pa.int32()),
            "kinds": pa.binary(), "times": pa.binary()}
    return pa.schema([(f.split()[0], kind.get(f.split()[0], longs)) for f in BLOCK.split(", ")])


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.int64)
    return np.frombuffer(pa.decompress(raw, decompressed_size=4 * n, codec="zstd"), dtype="<u4").astype(np.int64)


def _blocks(path_a: str, path_b: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, cut = _models(path_a, path_b)
        table = chunks.Decimals(max(first.size, second.size))
        block, held = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            doc = batch.column("doc_id")
            for part in chunks.runs(batch.column("text"), cut, RUN_BYTES):
                x = Aligned(part, first, second)
                held.add(doc.slice(part.first, part.last - part.first).to_pylist(), x,
                         x.group_digests(table), len(part.data))
                if held.bytes >= block_bytes:
                    yield held.row(block)
                    block, held = block + 1, _Block()
        if held.keys:
            yield held.row(block)
    return run


_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")


def _score(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """Rows of one block's texts; ``counts`` has the count of each of its pairs and whether that is its id's highest."""
    out = []
    counts = counts.sort_by("place")
    count = counts["n"].to_numpy()
    best = counts["best"].to_numpy().astype(np.int64)
    for row in range(blocks.num_rows):
        cell = {name: blocks[name][row] for name in blocks.column_names}
        kinds = np.array(cell["n_kinds"].as_py(), dtype=np.int64)
        total = int(kinds.sum())
        step, times = _unpacked(cell["kinds"].as_py(), total), _unpacked(cell["times"].as_py(), total)
        run = np.cumsum(step)
        heads = offsets_of(kinds)[:-1][kinds > 0]
        place = run - np.repeat(run[heads] - step[heads], kinds[kinds > 0])
        at = offsets_of(kinds)
        n_best = np.diff(offsets_of(times * best[place])[at]) if total else np.zeros(len(kinds), dtype=np.int64)
        summed = np.diff(offsets_of(times * count[place])[at]) if total else np.zeros(len(kinds), dtype=np.int64)
        out.append(pa.table({"doc_id": cell["doc_id"].values, "n_a": cell["n_a"].values, "n_b": cell["n_b"].values,
                             "n_groups": cell["n_groups"].values, "n_links": cell["n_links"].values,
                             "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(summed, pa.int64()),
                             "groups_sha256": cell["groups_sha256"].values}))
    return pa.concat_tables(out)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked, and whether no other pair of its A id has more."""
    counts = (blocks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.n_docs").alias("n")))
    top = counts.groupBy(F.shiftright("pair", 17).alias("a")).agg(F.max("n").alias("top"))
    return (counts.withColumn("a", F.shiftright("pair", 17)).join(top, "a")
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    A is the byte-level model (``path_a``, of a space and the text), B the piece model
    (``path_b``, of the text).  Null and empty texts, and texts that their tokens do not
    give back, count zeros and have an empty digest.  Every row is a document, repeated
    ones too; null ids stay.  Ties for an id's highest count are all best.  An empty table
    gives an empty result; other columns are ignored.
    """
    blocks = cut_lineage(_input(docs).mapInArrow(_blocks(path_a, path_b, block_bytes), BLOCK))
    wanted = blocks.select(F.col("block").alias("home"), F.posexplode("pairs").alias("place", "pair"))
    found = wanted.join(cut_lineage(pair_counts(blocks)), "pair").select("home", "place", "n", "best")
    held = blocks.drop("pairs", "n_docs")
    # a block without a pair has no row in found; cogroup keeps it
    return held.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(_score, _OUT)
