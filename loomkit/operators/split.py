"""Train/test split, batching, truncation and padding.

Exact ranks over the whole table come from ``global_rank``: a range partitioning
on the order keys, a local position per partition and per-partition offsets (one
row per partition, so the offset table is bounded by the partition count). No
step funnels the table through one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.session import cut_lineage

# Test share, split heads and sequence caps per run mode.
TEST_SHARE = 0.05
HEAD_QUICK = {"train": 100, "test": 10}
HEAD_FAST = {"train": 2000}
MAX_LEN = {"colab_fast": 2048, "kaggle": 8192, "local": 16384}
PAD_LABEL = -100
EPOCHS = 3
# Run modes: batch size, gradient accumulation, configured max steps, logging steps.
MODES = {"colab_fast": (2, 8, 200, 1), "kaggle": (2, 4, 500, 10), "local": (1, 8, 500, 1)}


def hash_order(key: Column, seed: str = "loomkit") -> Column:
    """Repeatable pseudo-random order: first 32 bits of md5(seed || key)."""
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def global_rank(df: DataFrame, order_cols: list[str], name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Exact 1-based rank over a total order (the order columns must be unique).

    Range partitioning balances rows across tasks; ``monotonically_increasing_id``
    after a sort within partitions is the local position; a per-partition count
    gives the offsets. The ranked rows are checkpointed once so that counting and
    ranking read the same partitions even if an executor is lost in between.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)).drop("_mid")
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-task window over at most `n` rows.
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_local") + 1).drop("_pid", "_local", "_off")


def split_positions(keys: DataFrame, key: str, test_share: float = TEST_SHARE, seed: str = "loomkit") -> DataFrame:
    """W4 on keys alone: ``(key, h, split, pos)``. Only the key and its hash are ranked; they are kept
    first, as the ranges are drawn from one reading of the rows and filled by another."""
    narrow = cut_lineage(keys.select(key, hash_order(F.col(key), seed).alias("h")).repartition("h"))
    ranked = global_rank(narrow, ["h", key], "_rank")
    n_test = math.ceil(test_share * ranked.count())
    is_test = F.col("_rank") <= n_test
    return ranked.select(key, "h", F.when(is_test, "test").otherwise("train").alias("split"),
                         F.when(is_test, F.col("_rank")).otherwise(F.col("_rank") - n_test).alias("pos"))


def split_exact(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: str = "loomkit") -> DataFrame:
    """W4 + U4: exactly ``ceil(test_share * n)`` rows go to ``test`` (ceiling is our
    rule), the ones first in hash order; the rest is ``train``. Adds ``split``,
    ``h`` and the 1-based position ``pos`` inside the split. Keys are ranked without their
    rows, which meet their positions in one join."""
    places = split_positions(df, key, test_share, seed)
    return places if df.columns == [key] else df.join(places, key)


def split_head(split_df: DataFrame, heads: dict[str, int]) -> DataFrame:
    """L4: the first ``min(n, len)`` rows of each named split, in split order; other splits stay whole."""
    cond = ~F.col("split").isin(*heads)
    for name, n in heads.items():
        cond = cond | ((F.col("split") == name) & (F.col("pos") <= n))
    return split_df.where(cond)


def batch_ids(split_df: DataFrame, batch_size: int) -> DataFrame:
    """Consecutive rows of a split form a batch: ``(pos - 1) div batch_size``."""
    return split_df.withColumn("batch_id", F.floor((F.col("pos") - 1) / batch_size).cast("bigint"))


def truncate(ids: Column, max_len: int) -> tuple[Column, Column]:
    """T5: ``ids[:max_len]`` and whether anything was cut."""
    return F.slice(ids, 1, max_len), F.size(ids) > max_len


def pad_batches(df: DataFrame, ids_col: str = "input_ids", pad_id: int = 0,
                keys: tuple[str, ...] = ("split", "batch_id")) -> DataFrame:
    """Pad to the longest row of the batch; attention mask; labels = ids with
    padding masked as -100. A batch holds ``batch_size`` rows, so the window
    partition per batch is small."""
    w = Window.partitionBy(*keys)
    ids = F.col(ids_col)
    longest = F.max(F.size(ids)).over(w)
    n_pad = longest - F.size(ids)
    padded = F.concat(ids, F.array_repeat(F.lit(pad_id), n_pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), n_pad))
    labels = F.concat(ids, F.array_repeat(F.lit(PAD_LABEL), n_pad))
    return (df.withColumn("batch_len", longest).withColumn("input_ids_padded", padded)
            .withColumn("attention_mask", mask).withColumn("labels", labels))


def batch_plan(n_train: Column, batch_size: int | None = None, grad_accum: int | None = None,
               max_steps: int | None = None, logging_steps: int | None = None) -> list[Column]:
    """Per run mode, rows per optimizer step and the steps over three epochs. A value that is
    given replaces the mode's own.

    ``configured_max_steps`` is reported next to the computed steps because the
    configured value is never handed to the training run.
    """
    rows = []
    given = (batch_size, grad_accum, max_steps, logging_steps)
    for mode, own in MODES.items():
        bs, accum, configured, log_steps = (o if g is None else g for o, g in zip(own, given))
        per_step = bs * accum
        rows.append(F.struct(F.lit(mode).alias("mode"), F.lit(bs).alias("batch_size"),
                             F.lit(accum).alias("grad_accum"), F.lit(per_step).alias("rows_per_step"),
                             F.ceil(n_train / per_step).cast("bigint").alias("steps_per_epoch"),
                             (F.ceil(n_train / per_step) * EPOCHS).cast("bigint").alias("total_steps"),
                             F.lit(configured).alias("configured_max_steps"),
                             F.lit(log_steps).alias("logging_steps"),
                             F.lit(MAX_LEN[mode]).alias("max_len")))
    return rows
