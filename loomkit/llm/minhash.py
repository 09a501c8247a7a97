"""Near-duplicate documents by b-bit MinHash.

1. A document's distinct five-word shingles are hashed; documents with equal sets are one
   class, and its smallest id stands for it.
2. Of every class: band keys from the full minima and, packed, the low ``BITS`` bits of
   each minimum.
3. A bucket is a band key held by two classes or more.  Every member is paired with the
   bucket's smallest id first.  A pair whose collision-corrected estimate (XOR, fold, bit
   count on the packed signatures) is high enough is confirmed on the full shingle sets:
   of each member's pairs the closest first, then those between different components.
4. Buckets whose members are not all connected by then are compared in blocks of packed
   signatures: members outside the bucket's largest component against all members, pairs inside
   one component left out.  A bucket of up to ``SMALL`` members gives its close pairs.  In a
   larger one a member gives its closest partner in each other component for confirmation.
5. What is still close across components then meets in blocks that hold each document
   once, with its full set, and is confirmed in place, so that only links leave them.  So
   every pair that shares a bucket is either connected or was compared, and a group of many
   near copies never gives all its pairs.
6. Components of the confirmed links, carried back from classes to documents.

With 48 bands of 5 rows a pair at similarity 0.75 shares a bucket with probability
1 - 2e-6; the estimate's cut lies 4.5 standard deviations below the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomkit.llm.components import connected_components
from loomkit.llm.words import distinct_per_row, mix, shingles, word_hashes
from loomkit.session import cut_lineage

BANDS, ROWS, BITS = 48, 5, 4
#: members of a bucket that may give pairs, of a block of a larger one, and of a block with full sets
SMALL, BLOCK, WIDE = 64, 256, 1024
HASHES = BANDS * ROWS
_rng = np.random.default_rng(75)
_A = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


def minima(sets: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over each non-empty set: rows x HASHES."""
    out = np.zeros((len(number), HASHES), dtype=np.uint32)
    full = number > 0
    if full.any():
        starts = (np.cumsum(number) - number)[full]
        x = (sets >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat(x * _A[k] + _B[k], starts)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    keys = np.empty((len(m), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(m), b + 1, dtype=np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + m[:, k])
        keys[:, b] = key
    return keys.view(np.int64)


def pack(m: np.ndarray) -> np.ndarray:
    """Low BITS bits of each minimum, two to a byte."""
    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (low[:, 0::2] << 4) | low[:, 1::2]


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (uint64 lanes in the last axis), corrected for the
    chance 2**-BITS that two different minima share their low bits."""
    x = left ^ right
    x = x | (x >> np.uint64(2))
    x = (x | (x >> np.uint64(1))) & np.uint64(0x1111111111111111)
    same = 1.0 - np.bitwise_count(x).sum(axis=-1, dtype=np.int64) / HASHES
    chance = 2.0 ** -BITS
    return (same - chance) / (1.0 - chance)


def cut(threshold: float) -> float:
    chance = 2.0 ** -BITS
    p = threshold + (1 - threshold) * chance
    return threshold - 4.5 * math.sqrt(p * (1 - p) / HASHES) / (1 - chance)


def _lanes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, HASHES * BITS // 64)


def _rows(keys: np.ndarray) -> pa.Array:
    offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for first, last, hashes, counts in word_hashes(batch.column("text")):
        yield (first, last, *distinct_per_row(*shingles(hashes, counts)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, sets, number in _sets(batch):
            m = minima(sets, number)
            at = np.cumsum(number) - number
            weights = mix(np.arange(1, 1 + int(number.max(initial=0)), dtype=np.uint64))
            digests = []
            for a, n in zip(at, number):
                own = sets[a:a + n]
                digests.append(np.array([own.sum(dtype=np.uint64), (own * weights[:n]).sum(dtype=np.uint64)],
                                        dtype=np.uint64).tobytes() if n else None)
            packed = pack(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first), pa.array(number),
                 pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in packed], pa.binary()),
                 _rows(band_keys(m))],
                ["doc_id", "n_shingles", "digest", "sig", "keys"])


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, digest, sig, keys)``; digest is null for an empty set."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_signatures, "doc_id long, n_shingles long, digest binary, sig binary, keys array<long>")


def _near(threshold: float):
    low = cut(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                said = estimate(_lanes(batch.column("sig_a")), _lanes(batch.column("sig_b")))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(said)],
                                                 ["a", "b", "said"]).filter(pa.array(said >= low))
    return run


def _pairs(threshold: float):
    """Close pairs of a small bucket across its components."""
    low = cut(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column("members").to_pylist():
                ids = np.array([m["id"] for m in members])
                comp = np.array([m["comp"] for m in members])
                lanes = _lanes(pa.array([m["sig"] for m in members]))
                for i in range(len(members) - 1):
                    near = (comp[i + 1:] != comp[i]) & (estimate(lanes[i], lanes[i + 1:]) >= low)
                    hit = ids[i + 1:][near]
                    a.append(np.minimum(hit, ids[i]))
                    b.append(np.maximum(hit, ids[i]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
    return run


def similar(x: np.ndarray, y: np.ndarray, numerator: int, denominator: int) -> bool:
    """Similarity test on two sorted sets of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or denominator * len(x) < numerator * len(y):
        return False
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return denominator * shared >= numerator * (len(x) + len(y) - shared)


class _Members:
    """A column of blocks as numpy views: members of row ``r`` are ``at[r]:at[r + 1]``."""

    def __init__(self, column: pa.ListArray):
        self.at = column.offsets.to_numpy()
        rows = column.values
        self.id, self.comp = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "comp"))
        self.lanes = self._bytes(rows.field("sig"), 0, len(rows)).reshape(len(rows), -1)
        held = [f.name for f in rows.type]
        self.own = rows.field("own") if "own" in held else None
        self.wide = rows.field("wide").to_numpy(zero_copy_only=False) if "wide" in held else None

    @staticmethod
    def _bytes(column: pa.Array, first: int, last: int) -> np.ndarray:
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:]
        data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
        return np.frombuffer(data[offsets[first]:offsets[last]].tobytes(), dtype=np.uint64)

    def set(self, i: int) -> np.ndarray:
        return self._bytes(self.own, i, i + 1)


def _closest(threshold: float):
    """Each left member's closest right member of every other component: ``(a, b, member, comp, said)``."""
    low = cut(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _Members(batch.column("left")), _Members(batch.column("right"))
            out = []
            for row in range(batch.num_rows):
                them = slice(right.at[row], right.at[row + 1])
                ids, comp, lanes = right.id[them], right.comp[them], right.lanes[them]
                for i in range(left.at[row], left.at[row + 1]):
                    near = np.flatnonzero(comp != left.comp[i])
                    said = estimate(left.lanes[i], lanes[near])
                    near, said = near[said >= low], said[said >= low]
                    order = np.lexsort((ids[near], -said, comp[near]))
                    near, said = near[order], said[order]
                    _, head = np.unique(comp[near], return_index=True)
                    out += [(min(left.id[i], ids[j]), max(left.id[i], ids[j]), left.id[i], comp[j], x)
                            for j, x in zip(near[head].tolist(), said[head].tolist())]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.float64())],
                ["a", "b", "member", "comp", "said"])
    return run


def _close_blocks(threshold: float):
    """``(x, y)``: wide blocks that hold a close pair across components, each once per task."""
    low = cut(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for batch in batches:
            left, right = _Members(batch.column("left")), _Members(batch.column("right"))
            for row in range(batch.num_rows):
                them = slice(right.at[row], right.at[row + 1])
                comp, lanes, wide = right.comp[them], right.lanes[them], right.wide[them]
                for i in range(left.at[row], left.at[row + 1]):
                    near = np.flatnonzero(comp != left.comp[i])
                    near = near[estimate(left.lanes[i], lanes[near]) >= low]
                    own = int(left.wide[i])
                    found.update((min(own, w), max(own, w)) for w in np.unique(wide[near]).tolist())
        cols = list(zip(*sorted(found))) if found else [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["x", "y"])
    return run


def _links(numerator: int, denominator: int):
    """Links between two blocks of documents, confirmed on the full sets.

    Components joined by a link are one from then on inside the pair of blocks, so a link
    between them is not looked for again.
    """
    low = cut(numerator / denominator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _Members(batch.column("left")), _Members(batch.column("right"))
            for row in range(batch.num_rows):
                mine = range(left.at[row], left.at[row + 1])
                them = slice(right.at[row], right.at[row + 1])
                ids, lanes = right.id[them], right.lanes[them]
                joined = {c: c for c in {*left.comp[mine.start:mine.stop].tolist(), *right.comp[them].tolist()}}
                comp = right.comp[them].copy()
                a, b = [], []
                for i in mine:
                    own = joined[int(left.comp[i])]
                    near = np.flatnonzero(comp != own)
                    near = near[estimate(left.lanes[i], lanes[near]) >= low]
                    x = left.set(i) if len(near) else None
                    for j in near.tolist():
                        if comp[j] != own and similar(x, right.set(them.start + j), numerator, denominator):
                            a.append(min(left.id[i], ids[j]))
                            b.append(max(left.id[i], ids[j]))
                            was = int(comp[j])
                            comp[comp == was] = own
                            joined.update({c: own for c, now in joined.items() if now == was})
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _confirm(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                keep.append(similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64),
                                    numerator, denominator))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))
    return run


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, sets, number in _sets(batch):
            at = np.cumsum(number) - number
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first),
                 pa.array([sets[a:a + n].tobytes() for a, n in zip(at, number)], pa.binary())], ["id", "own"])


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, own)``: the sorted shingle hashes of the documents in ``ids(doc_id)``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_full_sets, "id long, own binary")


def confirmed(docs: DataFrame, pairs: DataFrame, numerator: int = 75, denominator: int = 100) -> DataFrame:
    """Of ``pairs(a, b)`` those whose full shingle sets reach the similarity."""
    full = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    return (pairs.join(full.select(F.col("id").alias("a"), F.col("own").alias("set_a")), "a")
            .join(full.select(F.col("id").alias("b"), F.col("own").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b").mapInArrow(_confirm(numerator, denominator), "a long, b long"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of ``pairs(a, b)`` those whose ends are not labelled alike."""
    la = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    return pairs.join(la, "a", "left").join(lb, "b", "left").where(
        F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members ``(key, id, comp, n, minors, minor)`` of buckets that hold more than one component;
    ``minor`` are those outside the largest."""
    placed = members.join(labels, "id", "left").select("key", "id", "n", F.coalesce("label", "id").alias("comp"))
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("major"), F.count("*").alias("comps")) \
        .where("comps > 1").select("key", F.col("major.comp").alias("major"), F.col("major.size").alias("major_size"))
    return placed.join(mixed, "key").select(
        "key", "id", "comp", "n", (F.col("n") - F.col("major_size")).alias("minors"),
        (F.col("comp") != F.col("major")).alias("minor"))


def _in_blocks(mixed: DataFrame, sig: DataFrame, wide: int = 1) -> DataFrame:
    """``(left, right)``: blocks of minor members against blocks of all members of their buckets."""
    rows = mixed.join(sig, "id").select(
        "key", "minor", F.struct("id", "comp", "sig", F.pmod(F.xxhash64("id"), F.lit(wide)).alias("wide")).alias("m"),
        F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).alias("block"),
        F.pmod(F.xxhash64("id"), F.ceil(F.col("minors") / BLOCK)).alias("from"))
    left = rows.where("minor").groupBy("key", "from").agg(F.collect_list("m").alias("left"))
    right = rows.groupBy("key", "block").agg(F.collect_list("m").alias("right"))
    return left.join(right, "key").select("left", "right")


def _closest_pairs(mixed: DataFrame, sig: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: of every minor member its closest partner in each other component that it
    shares a bucket with."""
    best = _in_blocks(mixed, sig).mapInArrow(_closest(threshold), "a long, b long, member long, comp long, said double")
    return best.groupBy("member", "comp").agg(F.max(F.struct("said", "a", "b")).alias("x")).select("x.a", "x.b").distinct()


def _confirmed_in_blocks(docs: DataFrame, mixed: DataFrame, labels: DataFrame, sig: DataFrame,
                         numerator: int, denominator: int) -> DataFrame:
    """Links among the members that are still close across components: each stands once, with its
    full set, in a block by its id, and blocks that share a close pair are compared."""
    mixed = cut_lineage(mixed)
    ids = cut_lineage(mixed.select("id").distinct())
    blocks = max(1, math.ceil(ids.count() / WIDE))
    close = cut_lineage(_in_blocks(mixed, sig, blocks).mapInArrow(
        _close_blocks(numerator / denominator), "x long, y long").distinct())
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    used = close.select(F.explode(F.array("x", "y")).alias("block")).distinct()
    ids = ids.select("id", block.alias("block")).join(used, "block", "left_semi")
    sets = full_sets(docs, ids.select(F.col("id").alias("doc_id")))
    rows = cut_lineage(sets.join(sig, "id").join(labels, "id", "left").select(
        block.alias("block"), F.struct("id", F.coalesce("label", "id").alias("comp"), "own", "sig").alias("m")))
    held = rows.groupBy("block").agg(F.collect_list("m").alias("m"))
    return (close.join(held.select(F.col("block").alias("x"), F.col("m").alias("left")), "x")
            .join(held.select(F.col("block").alias("y"), F.col("m").alias("right")), "y")
            .select("left", "right").mapInArrow(_links(numerator, denominator), "a long, b long"))


def near_duplicates(docs: DataFrame, numerator: int = 75, denominator: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text, ..)``.

    Null, empty and blank texts have an empty set: linked with nothing, kept.  Repeated
    rows of one doc_id give one result row each.  Equal similarities are all links; the
    smallest doc_id of a component is kept.  An empty table gives an empty result; other
    columns of ``docs`` are ignored, whatever their names.
    """
    threshold = numerator / denominator
    sigs = cut_lineage(signatures(docs))
    classes = sigs.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(classes)
    reps = cut_lineage(sigs.select(F.col("doc_id").alias("id"), "sig", "keys").join(
        classes.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"]))
    bands = reps.select("id", F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    members = cut_lineage(bands.join(buckets, "key").select("key", "id", "n", "first"))
    sig = reps.select("id", "sig")

    star = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    star = (star.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(_near(threshold), "a long, b long, said double"))
    star = cut_lineage(star)
    nearest = star.groupBy("b").agg(F.max(F.struct("said", "a")).alias("x")).select("x.a", "b")
    links = cut_lineage(confirmed(docs, nearest, numerator, denominator))
    labels = connected_components(links, rounds=1)

    rest = cut_lineage(_mixed(members.where("n > 2"), labels))
    small = rest.where(F.col("n") <= SMALL).join(sig, "id").groupBy("key").agg(
        F.collect_list(F.struct("id", "comp", "sig")).alias("members"))
    more = _apart(star, labels).unionByName(small.select("members").mapInArrow(_pairs(threshold), "a long, b long")) \
        .unionByName(_closest_pairs(rest.where(F.col("n") > SMALL), sig, threshold)).distinct()
    more = cut_lineage(more.join(nearest, ["a", "b"], "left_anti"))
    links = cut_lineage(links.unionByName(confirmed(docs, more, numerator, denominator)))
    labels = connected_components(links, rounds=1)
    rest = _mixed(rest.where(F.col("n") > SMALL).select("key", "id", "n"), labels)
    links = links.unionByName(_confirmed_in_blocks(docs, rest, labels, sig, numerator, denominator))
    of = connected_components(links)

    named = classes.join(of.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("component"))
    return sigs.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, numerator: int = 75, denominator: int = 100) -> DataFrame:
    """``docs`` with one document, the smallest id, of each component; columns as they came.

    Rows without an id cannot be named as a copy of another and all stay.  Rows that repeat a
    kept id stay, too.  Null and blank texts are linked with nothing and stay.
    """
    kept = near_duplicates(docs, numerator, denominator).where("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
