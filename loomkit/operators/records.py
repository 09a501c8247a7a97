"""Record-level projections, filters, joins and counts (P1-P2, P6, F3-F8, F10,
J1, U1, L3, L5, A1, A11, K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loomkit.functions.text import py_strip

# Markup length cap (characters, strict) and the default byte budget.
MAX_SVG_CHARS = 64000
DEFAULT_TARGET_KB = 5.0

# Largest side (bytes, optimizer estimate) that is broadcast explicitly.
BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (file sizes for scans, propagated upward)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only behind a size check; beyond it Spark shuffles both sides."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a side whose row count is checked to be at most ``max_rows``;
    beyond it the join shuffles both sides (AQE splits skewed partitions).

    The side is checkpointed first, so the count and the join read the same
    materialised rows (no second evaluation of its lineage). For tables bounded by
    construction (a vocabulary, a class list) the optimizer's estimate is often
    far above the real size, which is why the rows are counted instead.
    """
    from loomkit.session import cut_lineage
    side = cut_lineage(df)
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def resolve_caption(rows: DataFrame, labels: DataFrame, label_col: str = "label",
                    out_col: str = "caption") -> DataFrame:
    """P1 + J1: integer label -> class name, else the number as text.

    ``labels`` is ``(label, name)``; a class table is small and its size is checked
    before it is broadcast. String labels (non-integer columns) pass through as text.
    """
    dtype = dict(rows.dtypes)[label_col]
    if dtype not in ("int", "bigint", "smallint", "tinyint"):
        return rows.withColumn(out_col, F.col(label_col).cast("string"))
    names = labels.select(F.col("label").alias("_label"), F.col("name").alias("_name"))
    joined = rows.join(small_side(names), rows[label_col] == F.col("_label"), "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("_name"), F.col(label_col).cast("string")))
            .drop("_label", "_name"))


def project_record(df: DataFrame, source_name: str, caption: str = "caption", svg: str = "svg") -> DataFrame:
    """``{caption, svg, source}`` with a constant source name."""
    return df.select(F.col(caption).alias("caption"), F.col(svg).alias("svg"), F.lit(source_name).alias("source"))


def has_key(col: Column) -> Column:
    """the key is present (a scanned field is NULL only when it is missing)."""
    return col.isNotNull()


def nonempty_after_strip(*cols: Column) -> Column:
    """every field non-empty after Python ``strip``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (py_strip(c) != "")
    return cond


def under_length_cap(svg: Column, cap: int = MAX_SVG_CHARS) -> Column:
    """``len(svg) < 64000`` in characters, strict."""
    return F.char_length(svg) < cap


def nonempty_svg(svg: Column) -> Column:
    """a failed trace yields "" and is dropped when ``require_svg`` is on."""
    return svg != ""


def corpus_filter(svg: Column, require_svg: bool = True, cap: int = MAX_SVG_CHARS) -> Column:
    """F5 + F6 as the corpus builder applies them."""
    cond = under_length_cap(svg, cap)
    return cond & nonempty_svg(svg) if require_svg else cond


def within_budget(size: Column, target_kb: float = DEFAULT_TARGET_KB) -> Column:
    """F8: ``size <= int(target_kb * 1024)``."""
    return size <= int(target_kb * 1024)


def foreground(alpha: Column) -> Column:
    """``alpha > 0``."""
    return alpha > 0


def union_corpora(*frames: DataFrame) -> DataFrame:
    """Bag union by column name (a second dataset appended to the first)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def first_surviving(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """L3: the first ``n`` rows *after* the filters, in a repeatable key order.

    ``limit`` over a sort is a distributed top-k (each task keeps ``n`` rows).
    """
    return df.orderBy(*order_by).limit(n)


def first_row(df: DataFrame, order_by: list[str]) -> DataFrame:
    """The first corpus row as a sample."""
    return df.orderBy(*order_by).limit(1)


def size_report(df: DataFrame, text_col: str, by: list[str]) -> DataFrame:
    """A11 + A1: rows, characters and bytes per group, partial-aggregated before the shuffle."""
    t = F.col(text_col)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.char_length(t)).cast("bigint").alias("total_chars"),
        F.sum(F.octet_length(t)).cast("bigint").alias("total_bytes"),
        F.max(F.char_length(t)).alias("max_chars"),
        F.min(F.char_length(t)).alias("min_chars"))


def observe_counts(df: DataFrame, name: str, reject_col: str = "reject") -> tuple[DataFrame, Observation]:
    """K6: kept / rejected counts gathered while the data is written, no second pass."""
    obs = Observation(name)
    out = df.observe(obs,
                     F.count(F.lit(1)).alias("rows"),
                     F.sum(F.when(F.col(reject_col).isNull(), 1).otherwise(0)).alias("kept"),
                     F.sum(F.when(F.col(reject_col).isNotNull(), 1).otherwise(0)).alias("rejected"))
    return out, obs


def rate_report(runs: DataFrame, by: list[str], tokens: Column, seconds: Column) -> DataFrame:
    """A10: tokens per second over a run log, per group (``sum(tokens) / sum(seconds)``).

    Seconds are summed as decimals so the total does not depend on the order in
    which partial sums meet; the ratio is taken once per group.
    """
    agg = runs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_runs"),
                                F.sum(tokens).cast("bigint").alias("tokens"),
                                F.sum(seconds.cast("decimal(18,2)")).alias("seconds"))
    rate = F.col("tokens").cast("double") / F.col("seconds").cast("double")
    return agg.select(*by, "n_runs", "tokens", F.col("seconds").cast("double").alias("seconds"),
                      F.round(F.when(F.col("seconds") > 0, rate), 6).alias("tokens_per_s"))
