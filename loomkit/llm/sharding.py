"""Shards of near equal bytes by longest-processing-time scheduling.

Rows with equal texts are a group and stay together.  Groups go, largest first, to the
least loaded shard, kept in a heap.  A group below ``total / (shards * UNITS)`` bytes is
first gathered with others of its kind, by hash, into one of ``shards * UNITS`` bundles; the
schedule then has at most ``2 * shards * UNITS`` entries whatever the table holds, which
is what reaches the driver.  Bundles are about as large as the bound, so the last
placements, and with them the spread of the loads, stay near ``mean load / UNITS``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window as W, functions as F

from loomkit.session import cut_lineage

UNITS = 512
#: parts of one shard that are numbered independently
SLOTS = 64


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each ``(size, unit)``: largest first to the least loaded shard.

    Equal sizes go by unit, equal loads to the lowest shard number.
    """
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, unit in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def balanced_shards(docs: DataFrame, shards: int = 40, units: int = UNITS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row.

    Null and empty texts are one group of 16-byte rows.  Repeated rows are rows of their
    own; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("text_key")))
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    bound = total / (shards * units)
    # a group's unit: its own (negative hash) when large, else one of shards * units bundles
    bundle = F.pmod(F.xxhash64("text_key"), F.lit(shards * units))
    sized = groups.select("text_key", "bytes", F.when(F.col("bytes") >= bound, F.lit(None).cast("long"))
                          .otherwise(bundle).alias("bundle"))
    sized = cut_lineage(sized.select(
        "text_key", "bytes", F.coalesce("bundle", F.lit(-1) - F.pmod(F.xxhash64("text_key", "bytes"), F.lit(2**62)))
        .alias("unit")))
    # at most 2 * shards * units rows: large groups hold bound bytes each, bundles are counted
    loads = [(r["bytes"], r["unit"]) for r in sized.groupBy("unit").agg(F.sum("bytes").alias("bytes")).collect()]
    placed = schedule(loads, shards)
    table = docs.sparkSession.createDataFrame([(u, s) for u, s in placed.items()], "unit long, shard int")
    keyed = sized.join(F.broadcast(table), "unit").select("text_key", "shard")
    # AQE splits a hot text's partition here: every row only looks its shard up
    located = rows.join(keyed, "text_key").select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("part"))
    located = cut_lineage(located)
    counts = located.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n"))
                           .alias("before"))
    inside = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return (located.withColumn("inside", inside).join(F.broadcast(before), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
