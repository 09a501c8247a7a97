"""Encoding and decoding with merge-type piece vocabularies by a score-ordered agenda.

Every text is a row of symbols, at first its characters.  The agenda holds the adjacent
pairs whose text is a piece; the best-scored pair (the leftmost of equal ones) is merged,
its new neighbour pairs enter, and so on until the agenda is empty.  Characters that are no
piece are written as their UTF-8 bytes.  Chunks of a run are worked on together in numpy,
each taking its own best pair in every round; a chunk of many characters has a heap.
In every Arrow batch the distinct chunks are also encoded by the sentencepiece library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomkit.llm import chunks
from loomkit.llm.chunks import SPACE_MARK, Run, offsets_of, spans

#: characters of a chunk beyond which it has a heap of its own
LONG_CHUNK = 64
#: characters handed to the library in one string
CHECK_CHARS = 20_000
NO_RANK = np.int64(1) << 30
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PieceModel:
    """Tables of a merge-type model with byte fallback and no normaliser but the space mark.

    Symbols below ``size`` are pieces; ``size + c`` is the character ``c`` that is no piece.
    """

    def __init__(self, path: str):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(self.size)]
        special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i)}
        byte_ids = [i for i in range(self.size) if sp.is_byte(i)]
        if len(byte_ids) != 256 or any(sp.is_unused(i) for i in range(self.size)):
            raise ValueError("only models with byte fallback and without unused pieces are read")
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in byte_ids:
            self.byte_ids[int(self.text[i][1:-1], 16)] = i
        plain = {t: i for i, t in enumerate(self.text) if i not in special and not sp.is_byte(i)}
        self.first = (self.size + np.arange(0x110000)).astype(np.int32)
        for t, i in plain.items():
            if len(t) == 1:
                self.first[ord(t)] = i
        self.first[0x20] = self.first[ord(SPACE_MARK)]
        self._merges(plain, [sp.get_score(i) for i in range(self.size)])
        #: chunks may be cut only where no piece reaches over the cut
        self.cut = not any(a not in SPACE_MARK + " \t\n\v\f\r" and b in SPACE_MARK + " \t\n"
                           for t in plain for a, b in zip(t, t[1:]))
        surface = [b"" if i in special and not sp.is_unknown(i) else
                   bytes([int(t[1:-1], 16)]) if sp.is_byte(i) else
                   " ⁇ ".encode() if sp.is_unknown(i) else t.replace(SPACE_MARK, " ").encode()
                   for i, t in enumerate(self.text)]
        self.width = np.array([len(s) for s in surface], dtype=np.int64)
        self.surface_at = offsets_of(self.width)
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.silent = np.zeros(self.size, dtype=bool)
        self.silent[[i for i in special if not sp.is_unknown(i)]] = True
        self.is_byte = np.zeros(self.size, dtype=bool)
        self.is_byte[byte_ids] = True
        self.marked = np.array([t.startswith(SPACE_MARK) for t in self.text])
        self.known = chunks.Known()
        self.wrong: set[int] = set()   # hashes of chunks that the library encodes otherwise
        self.checked = False

    def _merges(self, plain: dict[str, int], score: list[float]) -> None:
        order = {s: r for r, s in enumerate(sorted(set(score[i] for i in plain.values()), reverse=True))}

        def symbol(t: str) -> int:
            return int(self.first[ord(t)]) if len(t) == 1 else plain.get(t, -1)
        found = []
        for t, i in plain.items():
            for k in range(1, len(t)):
                left, right = symbol(t[:k]), symbol(t[k:])
                if left >= 0 and right >= 0:
                    found.append((left, right, i, order[score[i]]))
        self.base = self.size + 0x110000
        bits = max(12, (4 * len(found)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.array([a * self.base + b for a, b, _, _ in found], dtype=np.int64)
        self.slots = np.full((1 << bits) + 64, -1, dtype=np.int64)
        self.rank = np.full(len(self.slots), NO_RANK, dtype=np.int64)
        self.made = np.full(len(self.slots), -1, dtype=np.int32)
        home = self._home(keys).tolist()
        for (_, _, made, rank), key, at in zip(found, keys.tolist(), home):
            while self.slots[at] != -1:
                at += 1
            self.slots[at], self.rank[at], self.made[at] = key, rank, made

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where the two make no piece."""
        keys = left.astype(np.int64) * self.base + right
        at = self._home(keys)
        held = self.slots[at]
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            at[open_] += 1
            held = self.slots[at[open_]]
            open_ = open_[(held != keys[open_]) & (held != -1)]
        return self.rank[at], self.made[at]

    def merge_together(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, symbols)`` of chunks of ``size`` symbols each, merged side by side."""
        chunk = np.arange(len(size))
        ends = np.cumsum(size)
        rank = np.full(len(sym), NO_RANK, dtype=np.int64)
        made = np.full(len(sym), -1, dtype=np.int32)
        rank[:-1], made[:-1] = self.pairs(sym[:-1], sym[1:]) if len(sym) > 1 else (rank[:-1], made[:-1])
        rank[ends - 1] = NO_RANK
        size = size.copy()
        done_chunk, done_size, done_sym = [], [], []
        while len(size):
            begin = offsets_of(size)[:-1]
            best = np.minimum.reduceat((rank << 32) | np.arange(len(sym)), begin)
            live = best < (NO_RANK << 32)
            if not live.all():
                held = np.repeat(live, size)
                done_chunk.append(chunk[~live])
                done_size.append(size[~live])
                done_sym.append(sym[~held])
                shift = np.cumsum(~held)
                chunk, size, sym, rank, made = chunk[live], size[live], sym[held], rank[held], made[held]
                at = best[live] & 0xFFFFFFFF
                at -= shift[at]
                begin = offsets_of(size)[:-1]
            else:
                at = best & 0xFFFFFFFF
            if not len(size):
                break
            sym[at] = made[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, rank, made = sym[keep], rank[keep], made[keep]
            gone = np.arange(len(size))
            at -= gone
            begin -= gone
            size -= 1
            inner = at > begin
            more = at < begin + size - 1
            rank[at[~more]] = NO_RANK
            spot = np.concatenate([at[inner] - 1, at[more]])
            rank[spot], made[spot] = self.pairs(sym[spot], sym[spot + 1])
        chunk, size = np.concatenate(done_chunk), np.concatenate(done_size)
        sym = np.concatenate(done_sym)
        order = np.argsort(chunk)
        return size[order], sym[spans(offsets_of(size)[:-1][order], size[order])]

    def merge_long(self, sym: np.ndarray) -> np.ndarray:
        """One chunk by a heap of ``(rank, place, left, right, merged)``."""
        rank, made = self.pairs(sym[:-1], sym[1:])
        row = sym.tolist()
        agenda = [(r, i, row[i], row[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), made.tolist()))
                  if r < NO_RANK]
        heapq.heapify(agenda)
        n = len(row)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def enter(i: int, j: int) -> None:
            if i >= 0 and j < n:
                r, m = self.pair(row[i], row[j])
                if r < NO_RANK:
                    heapq.heappush(agenda, (r, i, row[i], row[j], m))
        while agenda:
            _, i, left, right, m = heapq.heappop(agenda)
            j = after[i]
            if row[i] != left or j >= n or row[j] != right:
                continue  # one of the two has been merged since
            row[i], row[j] = m, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            enter(before[i], i)
            enter(i, after[i])
        return np.array([s for s in row if s >= 0], dtype=np.int32)

    def pair(self, left: int, right: int) -> tuple[int, int]:
        key = left * self.base + right
        at = (key * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        slots = self.slots
        while slots[at] != key:
            if slots[at] == -1:
                return int(NO_RANK), -1
            at += 1
        return int(self.rank[at]), int(self.made[at])

    def encode_chunks(self, raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, ids)`` of chunks of ``sizes`` bytes that follow each other in ``raw``."""
        data = np.frombuffer(raw, dtype=np.uint8)
        chars = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), offsets_of(sizes)[:-1])
        sym = self.first[np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)]
        at = offsets_of(chars)
        long = chars > LONG_CHUNK
        short = np.flatnonzero(~long)
        counts = np.zeros(len(sizes), dtype=np.int64)
        parts, order = [], []
        if len(short):
            counts[short], some = self.merge_together(sym[spans(at[short], chars[short])], chars[short])
            parts.append(some)
        for c in np.flatnonzero(long):
            some = self.merge_long(sym[at[c]:at[c + 1]])
            counts[c] = len(some)
            parts.append(some)
        order = np.concatenate([short, np.flatnonzero(long)])
        begin = np.empty(len(sizes), dtype=np.int64)
        begin[order] = offsets_of(counts[order])[:-1]
        return self._as_bytes(counts, np.concatenate(parts)[spans(begin, counts)])

    def _as_bytes(self, counts: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their bytes."""
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return counts, sym
        kinds, kind = np.unique(sym[odd], return_inverse=True)
        raw = [chr(c - self.size).encode() for c in kinds.tolist()]
        width = np.ones(len(sym), dtype=np.int64)
        width[odd] = np.array([len(r) for r in raw])[kind]
        table = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        table_at = offsets_of(np.array([len(r) for r in raw]))[:-1]
        at = offsets_of(width)
        out = np.empty(at[-1], dtype=np.int32)
        plain = sym < self.size
        out[at[:-1][plain]] = sym[plain]
        out[spans(at[odd], width[odd])] = table[spans(table_at[kind], width[odd])]
        return np.diff(at[offsets_of(counts)]), out

    def _new_chunks(self, run: Run, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, sizes = run.chunk_bytes(which), run.size[which]
        counts, ids = self.encode_chunks(raw, sizes)
        if self.checked:
            self.wrong.update(run.hashes[which[self.unlike_library(raw, sizes, counts, ids)]].tolist())
        return counts, ids

    def unlike_library(self, raw: bytes, sizes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of the chunks for which the library gives other ids."""
        at, ids_at = offsets_of(sizes), offsets_of(counts)
        cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, at[-1], CHECK_CHARS)), len(sizes)))
        bad = []
        groups = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        said = self._library([raw[at[a]:at[b]] for a, b in groups])
        for (a, b), ours in zip(groups, said):
            if not np.array_equal(ours, ids[ids_at[a]:ids_at[b]]):
                one = self._library([raw[at[c]:at[c + 1]] for c in range(a, b)])
                bad += [c for c, x in zip(range(a, b), one) if not np.array_equal(x, ids[ids_at[c]:ids_at[c + 1]])]
        return np.array(bad, dtype=np.int64)

    def _library(self, raws: list[bytes]) -> list[np.ndarray]:
        """The library's ids; the space that it puts before a text is the chunk's own or is taken off."""
        texts = [r.decode() for r in raws]
        spaced = [t.startswith(" ") for t in texts]
        out = self.library.encode([t[1:] if s else t for t, s in zip(texts, spaced)], num_threads=1)
        alone = self.encode_mark()
        return [np.array(o if s and t != " " else alone if t == " " else o[1:], dtype=np.int32)
                for o, s, t in zip(out, spaced, texts)]

    def encode_mark(self) -> list[int]:
        """Ids of a single space."""
        return self.encode_chunks(b" ", np.array([1]))[1].tolist()

    def run_ids(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, ids)`` of the run's distinct chunks."""
        return self.known.ids_of(run, self._new_chunks)

    def decode(self, counts: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of rows of ids: pieces with marks as spaces, bytes joined, one leading mark dropped.

        Bytes that are no UTF-8 become one U+FFFD each.
        """
        at = offsets_of(counts)
        width = self.width[ids]
        head = np.flatnonzero(counts > 0)
        lead = at[head]
        for _ in range(len(ids)):  # control pieces say nothing; the first piece that does may drop its mark
            quiet = self.silent[ids[lead]] & (lead + 1 < at[head + 1])
            if not quiet.any():
                break
            lead = np.where(quiet, lead + 1, lead)
        drop = lead[self.marked[ids[lead]]]
        begin = self.surface_at[ids]
        begin[drop] += 1
        width[drop] -= 1
        data = self.surface[spans(begin, width)]
        ends = offsets_of(width)[at]
        raw = data.tobytes()
        out = []
        quiet = np.zeros(len(counts), dtype=bool)  # a control piece parts the bytes around it
        quiet[np.searchsorted(at, np.flatnonzero(self.silent[ids]), "right") - 1] = True
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            try:
                out.append(None if quiet[i] else raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(None)
            if out[-1] is None:
                out[-1] = self._decode_loose(ids[at[i]:at[i + 1]].tolist(), raw[a:b], width[at[i]:at[i + 1]].tolist())
        return out

    def _decode_loose(self, ids: list[int], raw: bytes, width: list[int]) -> str:
        out, held, at = [], b"", 0
        for i, w in zip([*ids, -1], [*width, 0]):
            if i >= 0 and self.is_byte[i]:
                held += raw[at:at + w]
            else:
                while held:
                    for n in (1, 2, 3, 4):
                        try:
                            out.append(held[:n].decode())
                            break
                        except UnicodeDecodeError:
                            continue
                    else:
                        out.append("�")
                        n = 1
                    held = held[n:]
                out.append(raw[at:at + w].decode())
            at += w
        return "".join(out)


_MODELS: dict[tuple[str, bool], PieceModel] = {}


def model(path: str, checked: bool = False) -> PieceModel:
    """The worker's tables of a model."""
    if (path, checked) not in _MODELS:
        _MODELS[path, checked] = PieceModel(path)
        _MODELS[path, checked].checked = checked
    return _MODELS[path, checked]


def id_lists(counts: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets_of(counts), pa.int32()), pa.array(ids, pa.int32()))


def _encode(path: str, checked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, checked)
        for batch in batches:
            doc = batch.column("doc_id")
            for part in chunks.runs(batch.column("text"), m.cut):
                counts, ids = chunks.text_ids(part, *m.run_ids(part))
                agrees = np.ones(len(counts), dtype=bool)
                if m.wrong:
                    hit = np.isin(run_hashes(part), np.array(list(m.wrong), dtype=np.uint64))
                    agrees[np.repeat(np.arange(len(counts)), part.per_text)[hit]] = False
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(part.first, part.last - part.first), id_lists(counts, ids),
                     pa.array(m.decode(counts, ids), pa.string()), pa.array(agrees)],
                    ["doc_id", "ids", "decoded", "agrees"])
    return run


def run_hashes(part: Run) -> np.ndarray:
    return part.hashes[part.chunk]


def encode_pieces(docs: DataFrame, path: str, checked: bool = True) -> DataFrame:
    """``(doc_id, ids array<int>, decoded string, agrees boolean)``, one row per input row.

    ``decoded`` is the text that the ids decode to.  ``agrees`` says that the library gives
    the same ids for all of the text's chunks (always true with ``checked=False``).  Null
    and empty texts have no ids and decode to an empty text; repeated rows and null ids
    stay; an empty table gives an empty result; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_encode(path, checked), "doc_id long, ids array<int>, decoded string, agrees boolean")


def decode_pieces(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, decoded)`` of rows ``(doc_id, ids array<int>)``; a null list is an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            lists = batch.column("ids")
            counts = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()],
                              dtype=np.int64)
            flat = np.asarray(lists.flatten(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(m.decode(counts, flat), pa.string())],
                                             ["doc_id", "decoded"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")) \
        .mapInArrow(run, "doc_id long, decoded string")


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def report(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees)`` of ``encode_pieces``."""
    return encode_pieces(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
