"""Candidate selection under a byte budget.

Input: ``candidates(image_id, idx, size, score[, svg])``, one row per traced preset.
The walk over presets in ``idx`` order becomes running window sums per image; the
choice is one aggregate per image. Both run on the same hash partitioning by
``image_id`` (the aggregate reuses the window's exchange), and the fat ``svg``
column is joined back only for the winners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Tracing presets, tried in this order (idx = position).
# Colour presets: max_dim, blur, color_precision, layer_difference, filter_speckle,
# corner_threshold, length_threshold, splice_threshold, path_precision, mode.
COLOUR_PRESETS = (
    (1024, 0.0, 8, 4, 1, 25, 1.5, 15, 3, "spline"),
    (768, 0.0, 8, 6, 1, 30, 2.0, 20, 2, "spline"),
    (640, 0.0, 8, 8, 2, 35, 2.5, 25, 2, "spline"),
    (512, 0.0, 8, 8, 2, 40, 3.0, 30, 2, "spline"),
    (384, 0.3, 7, 10, 3, 45, 3.5, 35, 2, "spline"),
    (320, 0.5, 6, 12, 4, 50, 4.0, 40, 1, "spline"),
    (256, 0.6, 6, 14, 6, 55, 4.5, 45, 1, "spline"),
    (200, 0.6, 7, 24, 18, 70, 6.0, 50, 1, "spline"),
    (170, 0.7, 7, 36, 26, 78, 7.0, 55, 1, "spline"),
    (160, 0.8, 7, 40, 28, 80, 7.5, 58, 1, "spline"),
    (140, 0.8, 7, 40, 30, 82, 8.0, 60, 1, "spline"),
    (130, 0.8, 7, 42, 29, 80, 7.3, 58, 1, "spline"),
    (120, 0.9, 7, 48, 34, 88, 9.0, 65, 1, "spline"),
    (110, 1.0, 6, 44, 32, 85, 8.5, 62, 1, "spline"),
    (100, 1.1, 5, 36, 28, 85, 8.0, 65, 0, "polygon"),
    (90, 1.3, 4, 32, 24, 85, 8.0, 70, 0, "polygon"),
)
# Posterised (cut-out) presets: max_dim, filter_speckle, corner_threshold,
# length_threshold, splice_threshold, path_precision, mode. With posterising,
# color_precision 8 and layer_difference 4 are forced and blur defaults to 0.
POSTER_PRESETS = (
    (384, 2, 20, 1.5, 15, 2, "polygon"),
    (256, 2, 25, 2.0, 20, 2, "polygon"),
    (200, 3, 30, 2.0, 20, 1, "polygon"),
    (182, 4, 35, 2.5, 25, 1, "polygon"),
    (170, 6, 40, 3.0, 30, 1, "polygon"),
    (150, 8, 45, 3.5, 35, 1, "polygon"),
    (130, 10, 50, 4.0, 40, 1, "polygon"),
    (120, 12, 55, 4.5, 42, 1, "polygon"),
    (112, 18, 64, 5.8, 50, 1, "polygon"),
    (110, 14, 58, 5.0, 45, 1, "polygon"),
    (100, 16, 60, 5.5, 48, 1, "polygon"),
    (95, 18, 63, 6.0, 50, 0, "polygon"),
    (85, 20, 65, 6.5, 55, 0, "polygon"),
)
POSTER_COLOR_PRECISION = 8
POSTER_LAYER_DIFFERENCE = 4
MIN_CANDIDATES = 2
EARLY_STOP_SHARE = 0.5

PRESET_COLUMNS = ("idx", "max_dim", "blur", "color_precision", "layer_difference", "filter_speckle",
                  "corner_threshold", "length_threshold", "splice_threshold", "path_precision", "mode")


def preset_rows(posterize: bool) -> list[tuple]:
    """The preset table is chosen by the posterise flag (not by cut-out)."""
    if posterize:
        return [(i, p[0], 0.0, POSTER_COLOR_PRECISION, POSTER_LAYER_DIFFERENCE) + p[1:]
                for i, p in enumerate(POSTER_PRESETS)]
    return [(i,) + p for i, p in enumerate(COLOUR_PRESETS)]


def preset_struct_array(posterize: bool) -> Column:
    """The preset table as a literal array of structs (13 or 16 rows, a fixed bound)."""
    def st(row):
        vals = [F.lit(row[0]).cast("int"), F.lit(row[1]).cast("int"), F.lit(float(row[2])),
                F.lit(row[3]).cast("int"), F.lit(row[4]).cast("int"), F.lit(row[5]).cast("int"),
                F.lit(row[6]).cast("int"), F.lit(float(row[7])), F.lit(row[8]).cast("int"),
                F.lit(row[9]).cast("int"), F.lit(row[10])]
        return F.struct(*[v.alias(n) for v, n in zip(vals, PRESET_COLUMNS)])
    return F.array(*[st(r) for r in preset_rows(posterize)])


def with_presets(images: DataFrame, posterize: bool = True) -> DataFrame:
    """Every image paired with every preset of the chosen table.

    An ``explode`` of a fixed 13/16-element literal: no join and no exchange.
    """
    out = images.withColumn("_preset", F.explode(preset_struct_array(posterize)))
    return out.select(*images.columns, *[F.col("_preset")[c].alias(c) for c in PRESET_COLUMNS])


def target_bytes(target_kb: float) -> int:
    """``int(target_kb * 1024)``."""
    return int(target_kb * 1024)


def mark_walk(cands: DataFrame, budget: int, min_candidates: int = MIN_CANDIDATES,
              key: str = "image_id") -> DataFrame:
    """Which presets the early-stopping walk considers, and which of those fit.

    ``stop`` marks the preset after which the walk ends: it fits, at least
    ``min_candidates`` fitting presets have been seen, and it uses under half the
    budget. Presets after the first stop are never considered.
    """
    w = Window.partitionBy(key).orderBy("idx")
    fits = (F.col("size") <= budget)
    running = F.sum(fits.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stop = fits & (running >= min_candidates) & (F.col("size") < EARLY_STOP_SHARE * budget)
    out = cands.withColumn("fits", fits).withColumn("stop", stop)
    earlier_stop = F.max(F.col("stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("considered", F.coalesce(earlier_stop, F.lit(0)) == 0)


def choose(cands: DataFrame, budget: int, min_candidates: int = MIN_CANDIDATES,
           key: str = "image_id", with_svg: bool = True) -> DataFrame:
    """A3 + W2 + I13: the best considered fitting preset per image, else the last preset.

    Best = highest ``score`` (NULL scores count as 0.0), first preset wins ties.
    Ranking runs on the narrow columns; ``svg`` joins back for the winners only.
    """
    narrow = cands.select(key, "idx", "size", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    walked = mark_walk(narrow, budget, min_candidates, key)
    cand = F.col("considered") & F.col("fits")
    row = F.struct("idx", "size", "score")
    best = F.max_by(F.when(cand, row), F.when(cand, F.struct(F.col("score"), -F.col("idx"))))
    last = F.max_by(row, F.col("idx"))
    chosen = walked.groupBy(key).agg(
        best.alias("best"), last.alias("last"),
        F.sum(F.when(cand, 1).otherwise(0)).alias("n_candidates"),
        F.sum(F.col("considered").cast("int")).alias("n_considered"))
    fallback = F.col("best").isNull()
    pick = F.when(fallback, F.col("last")).otherwise(F.col("best"))
    out = chosen.select(key, pick["idx"].alias("idx"), pick["size"].alias("size"), pick["score"].alias("score"),
                        fallback.alias("fallback"), "n_candidates", "n_considered")
    if with_svg and "svg" in cands.columns:
        # Join on the image key alone so both sides share the image_id partitioning;
        # an image has at most one row per preset, so the filter keeps one row.
        fat = cands.select(key, F.col("idx").alias("_idx"), "svg")
        out = out.join(fat, key, "left").where(F.col("_idx").isNull() | (F.col("_idx") == F.col("idx"))).drop("_idx")
    return out
