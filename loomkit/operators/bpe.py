"""Byte-pair training with kept pair counts (T2) and encoding inside the row.

Training keeps, next to the distinct words, an index from each adjacent pair to the places
where it stands. A merge rewrites only those places and changes the counts by the signed
differences of the pairs beside them, so no round counts all pairs again. The words of a task
(and of the sample) lie in flat arrays, so a merge costs as much as it changes.

One Spark job carries many merges. A bounded sample of the most frequent words proposes
the next merges; every task applies them to its own words and logs, per step, how its pair
counts changed. The summed log gives the exact counts before each step, and the longest
start of the proposal in which each merge is the most frequent pair of the whole corpus is
accepted. The exact counts then correct the next proposal, and so do the exact changes of the
merges that were not accepted: a proposal that was out of order is put right by its own log. So
the merges are those of one exact merge after another, however the sample is drawn; it only
decides how many are accepted at once (all of them where it holds every word).
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomkit.session import cut_lineage

STEPS = 2000          # merges proposed per job
SAMPLE = 2_000_000    # most frequent words that propose
SAMPLE_SYMBOLS = 10_000_000  # symbols that they may hold together (about 45 bytes each while proposing)
TASK_SYMBOLS = 4_000_000     # symbols that a worker indexes at a time
MAX_LOGGED = 2_000_000  # rows of counts and changes that may reach the driver
CACHED_WORDS = 200_000  # encoded words a worker keeps, emptied when full
AT_ONCE = 1_000_000     # characters that a worker encodes at a time

Pair = tuple[str, str]


def merge_list(symbols: list[str], a: str, b: str) -> list[str]:
    """Every (a, b), left to right and non-overlapping, replaced by a||b."""
    out, i, n = [], 0, len(symbols)
    while i < n:
        if i + 1 < n and symbols[i] == a and symbols[i + 1] == b:
            out.append(a + b)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def _find(symbols: list[str], a: str, b: str) -> int:
    """Where (a, b) first stands, or -1."""
    i, last = -1, len(symbols) - 1
    while a in symbols[i + 1:last]:
        i = symbols.index(a, i + 1)
        if symbols[i + 1] == b:
            return i
    return -1


class PairIndex:
    """Words as symbol lists, with pair counts and the words of each pair kept up to date: the plain form
    of ``SymbolIndex``, which the tests hold it against."""

    def __init__(self, symbols: Iterable[list[str]], counts: Iterable[int]):
        self.symbols, self.counts = list(symbols), list(counts)
        self.total: Counter[Pair] = Counter()
        self.words: dict[Pair, set[int]] = defaultdict(set)
        for w, (s, n) in enumerate(zip(self.symbols, self.counts)):
            for pair in zip(s, s[1:]):
                self.total[pair] += n
                self.words[pair].add(w)

    def copy(self) -> PairIndex:
        """An index that merges on its own; symbol lists are replaced, never changed, so they are shared."""
        out = PairIndex((), ())
        out.symbols, out.counts, out.total = list(self.symbols), self.counts, self.total.copy()
        out.words = defaultdict(set, {pair: set(held) for pair, held in self.words.items()})
        return out

    def merge(self, a: str, b: str) -> dict[Pair, int]:
        """Apply one merge; the signed differences of the counts, zeros left out."""
        change: dict[Pair, int] = defaultdict(int)
        words, symbols, ab = self.words, self.symbols, a + b
        for w in words.pop((a, b), ()):
            old, n = symbols[w], self.counts[w]
            i, end = _find(old, a, b), len(old)
            if i < 0:
                continue
            if a in old[i + 2:]:
                new = symbols[w] = merge_list(old, a, b)
                before, after = list(zip(old, old[1:])), list(zip(new, new[1:]))
                for pair in before:
                    change[pair] -= n
                for pair in after:
                    change[pair] += n
                held = set(after)
                for pair in set(before) - held:
                    words[pair].discard(w)
                for pair in held:
                    words[pair].add(w)
                continue
            # the pair stands here alone, so only its neighbours change
            new = symbols[w] = [*old[:i], ab, *old[i + 2:]]
            change[a, b] -= n
            if i:
                left = old[i - 1]
                change[left, a] -= n
                change[left, ab] += n
                words[left, ab].add(w)
                if _find(new, left, a) < 0:
                    words[left, a].discard(w)
            if i + 2 < end:
                right = old[i + 2]
                change[b, right] -= n
                change[ab, right] += n
                words[ab, right].add(w)
                if _find(new, b, right) < 0:
                    words[b, right].discard(w)
        change = {pair: d for pair, d in change.items() if d}
        for pair, d in change.items():
            self.total[pair] += d
            if not self.total[pair]:
                del self.total[pair]
        return change


class SymbolIndex:
    """``PairIndex`` on flat arrays: the symbols of all words side by side, each with the places beside it.

    A pair at a place is never there twice, as symbols only grow. So the places of a pair are those found
    at the start or when one of its symbols was made, less those that were rewritten since.
    """

    def __init__(self, symbols: pa.Array, counts: np.ndarray):
        coded = symbols.flatten().dictionary_encode()
        self.names: list[str] = coded.dictionary.to_pylist()
        self.ids = {name: i for i, name in enumerate(self.names)}
        self.sym = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        size = pc.fill_null(pc.list_value_length(symbols), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(size)
        at = np.arange(len(self.sym), dtype=np.int32)
        self.right, self.left = at + 1, at - 1
        self.right[self.ends[size > 0] - 1] = -1
        self.left[(self.ends - size)[size > 0]] = -1
        self.weight = np.repeat(np.asarray(counts, dtype=np.int64), size)
        # the places found at the start, and those found when a symbol was made
        self.first = self._filed(np.flatnonzero(self.right >= 0).astype(np.int32))
        self.made: dict[int, list[tuple]] = {}

    def copy(self) -> SymbolIndex:
        out = object.__new__(SymbolIndex)
        out.names, out.ids, out.ends, out.weight, out.first = list(self.names), dict(self.ids), self.ends, self.weight, self.first
        out.sym, out.right, out.left = self.sym.copy(), self.right.copy(), self.left.copy()
        out.made = {s: list(filed) for s, filed in self.made.items()}
        return out

    def _keys(self, at: np.ndarray) -> np.ndarray:
        """The pair at each place, as one number."""
        return self.sym[at].astype(np.int64) << 32 | self.sym[self.right[at]]

    def _filed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places by pair: the pairs, where each begins, the places."""
        keys = self._keys(at)
        order = np.argsort(keys, kind="stable")
        keys, begin = _runs(keys[order])
        return keys, np.append(begin, len(at)), at[order]

    def places(self, a: int, b: int) -> np.ndarray:
        """Where (a, b) stands, in order."""
        key, found = a << 32 | b, []
        for keys, begin, at in (self.first, *self.made.get(a, ()), *(self.made.get(b, ()) if a != b else ())):
            i = int(np.searchsorted(keys, key))
            if i < len(keys) and keys[i] == key:
                found.append(at[begin[i]:begin[i + 1]])
        if not found:
            return np.empty(0, dtype=np.int32)
        at = np.concatenate(found)
        at = at[(self.sym[at] == a) & (self.right[at] >= 0)]
        at = at[self.sym[self.right[at]] == b]
        at.sort()
        return at

    def merge_ids(self, a: str, b: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Apply one merge: how often the pair stood there, the pairs whose count changed, and by how much."""
        none = np.empty(0, dtype=np.int64)
        if a not in self.ids or b not in self.ids:
            return 0, none, none
        at = self.places(self.ids[a], self.ids[b])
        if not len(at):
            return 0, none, none
        held = int(self.weight[at].sum())
        sym, left, right = self.sym, self.left, self.right
        if a == b:  # of a run of one symbol every second pair, from its left end
            n = np.arange(len(at))
            begins = np.concatenate([[True], right[at[:-1]] != at[1:]])
            at = at[(n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0]
        second, before = right[at], left[at]
        alone = before >= 0
        alone[1:] &= before[1:] != second[:-1]      # two merged pairs side by side have one place between
        beside = before[alone]
        old = np.concatenate([at, second[right[second] >= 0], beside])
        old_keys = self._keys(old)
        ab = self.ids.setdefault(a + b, len(self.names))
        if ab == len(self.names):
            self.names.append(a + b)
        after = right[second]
        sym[at], sym[second], right[at] = ab, -1, after
        left[after[after >= 0]] = at[after >= 0]
        new = np.concatenate([at[after >= 0], beside])
        filed = self._filed(new)
        self.made.setdefault(ab, []).append(filed)
        keys, change = _summed(np.concatenate([old_keys, self._keys(new)]),
                               np.concatenate([-self.weight[old], self.weight[new]]))
        return held, keys[change != 0], change[change != 0]

    def pair(self, key: int) -> Pair:
        return self.names[key >> 32], self.names[key & 0xffffffff]

    def merge(self, a: str, b: str) -> dict[Pair, int]:
        """``merge_ids`` as ``PairIndex`` gives it."""
        _, keys, change = self.merge_ids(a, b)
        return {self.pair(k): d for k, d in zip(keys.tolist(), change.tolist())}

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair and its count."""
        at = np.flatnonzero((self.sym >= 0) & (self.right >= 0))
        return _summed(self._keys(at), self.weight[at])

    def most_frequent(self, n: int) -> dict[Pair, int]:
        """The ``n`` most frequent pairs, and those as frequent as the last."""
        keys, count = self.counted()
        if len(count) > n:
            keep = count >= np.partition(count, len(count) - n)[len(count) - n]
            keys, count = keys[keep], count[keep]
        return {self.pair(k): c for k, c in zip(keys.tolist(), count.tolist())}

    def symbols(self) -> pa.Array:
        """The words as lists of symbols."""
        live = self.sym >= 0
        ends = np.concatenate([[0], np.cumsum(live)])[np.concatenate([[0], self.ends])]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.texts(self.sym[live]))

    def texts(self, ids: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(ids))


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of an ordered array and where each begins."""
    if not len(ordered):
        return ordered, np.empty(0, dtype=np.int64)
    begin = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    return ordered[begin], begin


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys, begin = _runs(keys[order])
    return keys, np.add.reduceat(values[order], begin) if len(keys) else values[:0]


class _Ranked:
    """The most frequent pair of changing counts, ties by (a, b)."""

    def __init__(self, counts: dict[Pair, int]):
        self.counts = dict(counts)
        self.heap = [(-c, *pair) for pair, c in self.counts.items() if c > 0]
        heapq.heapify(self.heap)

    def top(self) -> tuple[str, str, int] | None:
        while self.heap:
            c, a, b = self.heap[0]
            now = self.counts.get((a, b), 0)
            if now == -c:
                return a, b, now
            heapq.heappop(self.heap)
            if 0 < now < -c:  # it fell since; a rise is entered when it happens
                heapq.heappush(self.heap, (-now, a, b))
        return None

    def change(self, by: Iterable[tuple[Pair, int]]) -> None:
        for pair, d in by:
            c = self.counts[pair] = self.counts.get(pair, 0) + d
            if d > 0 and c > 0:
                heapq.heappush(self.heap, (-c, *pair))


class Learned:
    """What the last log says of merges that were not accepted: the exact changes of their counts,
    complete for the pairs ``sure``."""

    def __init__(self, sure: set[Pair] = frozenset(), changes: dict[Pair, list[tuple[Pair, int]]] | None = None):
        self.sure, self.changes = sure, changes or {}

    def correct(self, pair: Pair, guess: dict[Pair, int]) -> dict[Pair, int]:
        if pair not in self.changes:
            return guess
        return {p: d for p, d in guess.items() if p not in self.sure} | dict(self.changes[pair])


def propose(index: SymbolIndex, exact: dict[Pair, int], steps: int, learned: Learned | None = None) -> list[Pair]:
    """Likely next merges: exact counts where they are known, carried on with the last log's changes,
    and with the sample's for merges that it does not hold."""
    ranked, learned = _Ranked({**index.most_frequent(max(100_000, 8 * steps)), **exact}), learned or Learned()
    out = []
    for _ in range(steps):
        best = ranked.top()
        if best is None:
            break
        a, b, c = best
        out.append((a, b))
        # the sample's changes in the measure in which it holds the pair
        held, keys, change = index.merge_ids(a, b)
        if held and held != c:
            change = np.rint(change * (c / held)).astype(np.int64)
        guess = {index.pair(k): d for k, d in zip(keys.tolist(), change.tolist())}
        changes = learned.correct((a, b), guess)
        ranked.change([(pair, d) for pair, d in changes.items() if pair != (a, b)])
        ranked.counts[a, b] = 0
    return out


def _indexes(batches: Iterator[pa.RecordBatch], done: list[Pair]) -> Iterator[tuple[pa.Table, SymbolIndex]]:
    """Batches up to ``TASK_SYMBOLS`` symbols with the index of their words after the merges ``done``."""
    def indexed(held: list[pa.RecordBatch]) -> tuple[pa.Table, SymbolIndex]:
        table = pa.Table.from_batches(held).combine_chunks()
        index = SymbolIndex(_one(table.column("symbols")), _one(table.column("n")).to_numpy(zero_copy_only=False))
        for a, b in done:
            index.merge_ids(a, b)
        return table, index

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("symbols").flatten())
        if size >= TASK_SYMBOLS:
            yield indexed(held)
            held, size = [], 0
    if held:
        yield indexed(held)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else \
        pa.array([], column.type)


def _apply(merges: list[Pair]):
    """``(word, n, symbols)`` after the merges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, index in _indexes(batches, merges):
            yield pa.RecordBatch.from_arrays([_one(table.column("word")), _one(table.column("n")), index.symbols()],
                                             ["word", "n", "symbols"])
    return run


def _log(done: list[Pair], merges: list[Pair]):
    """``(step, a, b, d)``: a task's pair counts after ``done`` (step -1) and their change by each merge."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, index in _indexes(batches, done):
            parts = [(-1, *index.counted())]
            for step, (a, b) in enumerate(merges):
                parts.append((step, *index.merge_ids(a, b)[1:]))
            keys = np.concatenate([k for _, k, _ in parts])
            steps = np.repeat(np.array([i for i, _, _ in parts], dtype=np.int32), [len(k) for _, k, _ in parts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(steps), index.texts(keys >> 32), index.texts(keys & 0xffffffff),
                 pa.array(np.concatenate([d for _, _, d in parts]), pa.int64())], ["step", "a", "b", "d"])
    return run


_LOGGED = "step int, a string, b string, d bigint"


def accepted(merges: list[Pair], counts: dict[Pair, int], changes: dict[int, list[tuple[Pair, int]]],
             floor: int) -> tuple[list[tuple[str, str, int]], dict[Pair, int]]:
    """The longest start of ``merges`` in which each is the most frequent pair, with its count,
    and the exact counts behind it. ``counts`` and ``changes`` are complete for every pair that
    ever reaches ``floor``, so a step whose best pair lies below it is not decided."""
    ranked, out = _Ranked(counts), []
    for step, (a, b) in enumerate(merges):
        best = ranked.top()
        if best is None or best[2] < floor or best[:2] != (a, b):
            break
        out.append(best)
        ranked.change(changes.get(step, ()))
    return out, ranked.counts


def _verify(words: DataFrame, done: list[Pair],
            merges: list[Pair]) -> tuple[list[tuple[str, str, int]], dict[Pair, int], Learned]:
    """``accepted`` over the whole word table after ``done``, and what the log says of the rest."""
    log = words.select("symbols", "n").mapInArrow(_log(done, merges), _LOGGED)
    # one row per pair: its changes by step, and a bound of the count it ever reaches
    pairs = cut_lineage(log.repartition("a", "b").groupBy("step", "a", "b").agg(F.sum("d").alias("d"))
                        .groupBy("a", "b").agg(F.collect_list(F.struct("step", "d")).alias("series"),
                                               F.sum(F.greatest("d", F.lit(0))).alias("peak")))
    parts = ["a", "b", F.col("series.step").alias("step"), F.col("series.d").alias("d")]
    proposed = log.sparkSession.createDataFrame(list(dict.fromkeys(merges)), "a string, b string")
    mine = {(a, b): (steps, ds) for a, b, steps, ds in
            _tuples(pairs.join(F.broadcast(proposed), ["a", "b"], "left_semi").select(*parts))}
    # the count of each proposed merge before its step; the smallest is the floor
    reached = []
    for step, pair in enumerate(merges):
        c = sum(d for s, d in zip(*mine.get(pair, ((), ()))) if s < step)
        if c <= 0:
            break
        reached.append(c)
    floors = sorted(set(reached)) or [1]
    low, high = 0, len(floors) - 1
    while low < high:  # decide fewer steps rather than carry more rows
        middle = low if low == 0 and high == len(floors) - 1 else (low + high) // 2
        size = pairs.where(F.col("peak") >= floors[middle]).agg(F.sum(F.size("series"))).first()[0]
        if (size or 0) <= MAX_LOGGED:
            high = middle
        else:
            low = middle + 1
    floor = floors[low]
    counts, changes = {}, defaultdict(list)
    for a, b, steps, ds in _tuples(pairs.where(F.col("peak") >= floor).select(*parts)):
        for step, d in zip(steps, ds):
            if step < 0:
                counts[a, b] = d
            else:
                changes[step].append(((a, b), d))
    good, exact = accepted(merges, counts, changes, floor)
    rest = {}
    for step in range(len(good), len(merges)):
        rest.setdefault(merges[step], changes.get(step, []))
    return good, exact, Learned(set(exact), rest)


def _tuples(df: DataFrame) -> Iterator[tuple]:
    """The rows of a bounded result."""
    for batch in df.toArrow().to_batches():
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _sampled(words: DataFrame, sample: int) -> tuple[SymbolIndex, bool]:
    """The most frequent words that still have a pair, no more than ``sample`` and ``SAMPLE_SYMBOLS`` allow,
    and whether they are all of them."""
    paired = words.where(F.size("symbols") > 1)
    n, size = paired.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("symbols")), F.lit(0))).first()
    room = min(sample, n, n * SAMPLE_SYMBOLS // max(size, 1))
    top = paired if room == n else paired.orderBy(F.desc("n"), "word").limit(room)
    held = top.select("symbols", "n").toArrow().combine_chunks()
    return SymbolIndex(_one(held.column("symbols")), _one(held.column("n")).to_numpy(zero_copy_only=False)), room == n


def train(words: DataFrame, n_merges: int, known: set[str], room: int | None = None, steps: int = STEPS,
          sample: int = SAMPLE) -> tuple[list[tuple[str, str, int]], DataFrame]:
    """Merges ``(a, b, count)`` in order and the words after them.

    ``words(word, n, symbols)``. Ends after ``n_merges``, when no pair is left, or when the
    merges have given ``room`` texts that are not in ``known`` (a merge whose text exists
    already takes no room). The words are rewritten, and a sample that lacks words is drawn anew, once
    ``steps`` merges have been accepted; until then each job applies those to its words first.
    """
    def applied(done: list[Pair]) -> DataFrame:
        return cut_lineage(words.select("word", "n", "symbols").mapInArrow(
            _apply(done), "word string, n bigint, symbols array<string>"))

    # the work is in Python: as many even parts as there are cores, however small the table
    words = cut_lineage(words.repartition(2 * words.sparkSession.sparkContext.defaultParallelism, "word"))
    merges: list[tuple[str, str, int]] = []
    seen = set(known)
    exact: dict[Pair, int] = {}
    learned, done, held, whole, ahead = Learned(), [], None, False, steps
    while len(merges) < n_merges and (room is None or room > 0):
        if held is None:
            held, whole = _sampled(words, sample)
        if not exact and not whole:  # the first proposal knows the exact counts of the most frequent pairs
            exact = _top_counts(words, done, steps)
        most = min(ahead, n_merges - len(merges), room if room is not None else ahead)
        trial = held.copy()
        wanted = propose(trial, exact, most, learned)
        if not wanted:
            break
        good, exact, learned = _verify(words, done, wanted)
        taken = []
        for a, b, c in good:
            if room is not None and room <= 0:
                break
            if room is not None and a + b not in seen:
                room -= 1
            seen.add(a + b)
            taken.append((a, b, c))
        if len(taken) < len(good):
            exact, learned = {}, Learned()
        merges += taken
        done += [(a, b) for a, b, _ in taken]
        full = len(done) >= steps
        if len(taken) == len(wanted):
            held = trial
        elif whole or not full:
            for a, b, _ in taken:
                held.merge_ids(a, b)
        exact = {pair: c for pair, c in exact.items() if c > 0}
        if not whole and (not taken or not exact):
            exact = _top_counts(words, done, steps)
            if not exact:
                break
        # a log of merges that are not accepted is worth less than it costs
        ahead = min(steps, max(steps // 5, 4 * len(taken)))
        if full:
            words, done, held = applied(done), [], held if whole else None
    return merges, applied(done) if done else words


def _top_counts(words: DataFrame, done: list[Pair], n: int) -> dict[Pair, int]:
    log = words.select("symbols", "n").mapInArrow(_log(done, []), _LOGGED)
    best = log.groupBy("a", "b").agg(F.sum("d").alias("c")).orderBy(F.desc("c"), "a", "b").limit(n)
    return {(r["a"], r["b"]): r["c"] for r in best.collect()}


# ------------------------------------------------------------------ encoding

class WordEncoder:
    """Ids of a word: the lowest-ranked adjacent pair merged until none is left, then looked up."""

    def __init__(self, vocab: dict[str, int], ranks: dict[Pair, int], whole: set[str], unk_id: int):
        self.vocab, self.ranks, self.whole, self.unk_id = vocab, ranks, whole, unk_id
        self.cache: dict[str, np.ndarray] = {}

    def symbols(self, word: str) -> list[str]:
        if word in self.whole:
            return [word]
        out = list(word)
        while len(out) > 1:
            found = [(self.ranks[p], p) for p in zip(out, out[1:]) if p in self.ranks]
            if not found:
                break
            out = merge_list(out, *min(found)[1])
        return out

    def ids(self, word: str) -> np.ndarray:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            symbols = self.symbols(word) if self.ranks or word in self.whole else word
            got = self.cache[word] = np.array([self.vocab.get(s, self.unk_id) for s in symbols], dtype=np.int32)
        return got


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of rows with about ``AT_ONCE`` characters of words each (one row at least)."""
    lists = batch.column("words")
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.fill_null(pc.utf8_length(lists.flatten()), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(chars)])[np.cumsum(size)]
    at, n = 0, batch.num_rows
    while at < n:
        begin = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + AT_ONCE, "right")))
        yield batch.slice(at, to - at)
        at = to


def _encode(vocab: dict[str, int], ranks: dict[Pair, int], whole: set[str], unk_id: int, max_tokens: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocab, ranks, whole, unk_id)
        for batch in (part for whole_batch in batches for part in _slices(whole_batch)):
            lists = batch.column("words")
            per_doc = np.array([n or 0 for n in pc.list_value_length(lists).to_pylist()], dtype=np.int64)
            coded = lists.flatten().dictionary_encode()
            ids = [encoder.ids(w) for w in coded.dictionary.to_pylist()]
            size = np.array([len(x) for x in ids], dtype=np.int64)
            flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
            word = coded.indices.to_numpy(zero_copy_only=False)
            begin = np.cumsum(size) - size
            count = size[word]
            at = np.concatenate([[0], np.cumsum(count)])
            out = flat[np.repeat(begin[word] - at[:-1], count) + np.arange(at[-1])] if at[-1] else flat[:0]
            doc_at = at[np.concatenate([[0], np.cumsum(per_doc)])]
            n_ids = np.diff(doc_at)
            sums = np.concatenate([[0], np.cumsum(out, dtype=np.int64)])
            if max_tokens is not None:
                place = np.arange(len(out)) - np.repeat(doc_at[:-1], n_ids)
                out = out[place < max_tokens]
            held = n_ids if max_tokens is None else np.minimum(n_ids, max_tokens)
            arrays = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32()),
                                              pa.array(out, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), arrays, pa.array(n_ids, pa.int32()), pa.array(np.diff(sums[doc_at]), pa.int64())],
                ["key", "input_ids", "n_ids", "id_sum"])
    return run


def encode(docs: DataFrame, key: str, words: Column, vocab: dict[str, int], ranks: dict[Pair, int], whole: set[str],
           unk_id: int = 0, max_tokens: int | None = None) -> DataFrame:
    """``(key, input_ids, n_ids, id_sum)`` per row of ``docs``: no explode, no join, no shuffle.

    ``words`` gives a row's pre-tokens. Each distinct word of a batch is encoded once and
    its ids are copied to where it stands. ``n_ids`` and ``id_sum`` cover the whole text, also
    under ``max_tokens``.
    """
    kind = dict(docs.dtypes)[key]
    out = docs.select(F.col(key).alias("key"), words.alias("words")).mapInArrow(
        _encode(vocab, ranks, whole, unk_id, max_tokens),
        f"key {kind}, input_ids array<int>, n_ids int, id_sum bigint")
    return out.withColumnRenamed("key", key)
