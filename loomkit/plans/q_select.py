"""Queries over preset candidates: early stop, choice, fallback, preset grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.functions import markup
from loomkit.operators import select as S
from loomkit.plans.registry import register
from loomkit.sources import fixtures as FX
from loomkit.sources.tables import table

BUDGET = FX.CANDIDATE_BUDGET

_CANDS = f"""cands AS (
  SELECT l_orderkey AS image_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS idx,
    CAST(floor(l_extendedprice / 10) AS BIGINT) AS size, l_discount AS score
  FROM lineitem),
walk AS (
  SELECT *, size <= {BUDGET} AS fits,
    (size <= {BUDGET}) AND sum(CASE WHEN size <= {BUDGET} THEN 1 ELSE 0 END) OVER (PARTITION BY image_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) >= 2
      AND size < 0.5 * {BUDGET} AS stop
  FROM cands),
walked AS (
  SELECT *, coalesce(max(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY image_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS considered
  FROM walk)"""


def _cands(spark, sf):
    return FX.candidates(table(spark, sf, "lineitem"))


@register("preset_early_stop", "WITH " + _CANDS + "\nSELECT image_id, idx, fits FROM walked WHERE considered")
def preset_early_stop(spark, sf):
    """The presets the walk considers (later presets are never traced)."""
    w = S.mark_walk(_cands(spark, sf), BUDGET)
    return w.where("considered").select("image_id", "idx", "fits")


_CHOOSE_SQL = "WITH " + _CANDS + """,
best AS (
  SELECT image_id, idx, size, score,
    row_number() OVER (PARTITION BY image_id ORDER BY score DESC, idx) AS rn
  FROM walked WHERE considered AND fits),
last AS (
  SELECT image_id, idx, size, score, row_number() OVER (PARTITION BY image_id ORDER BY idx DESC) AS rn FROM cands),
counts AS (
  SELECT image_id, CAST(sum(CASE WHEN considered AND fits THEN 1 ELSE 0 END) AS BIGINT) AS n_candidates,
    CAST(sum(CASE WHEN considered THEN 1 ELSE 0 END) AS BIGINT) AS n_considered FROM walked GROUP BY image_id)
SELECT c.image_id, coalesce(b.idx, l.idx) AS idx, coalesce(b.size, l.size) AS size,
  CASE WHEN b.idx IS NULL THEN l.score ELSE b.score END AS score, b.idx IS NULL AS fallback,
  c.n_candidates, c.n_considered
FROM counts c LEFT JOIN best b ON b.image_id = c.image_id AND b.rn = 1
JOIN last l ON l.image_id = c.image_id AND l.rn = 1"""


@register("preset_choose", _CHOOSE_SQL)
def preset_choose(spark, sf):
    """A3 + W2: best score among considered fitting presets (lowest idx on ties),
    else the last preset. Narrow ranking; the markup is not carried."""
    return S.choose(_cands(spark, sf), BUDGET, with_svg=False)


_FALLBACK_SQL = "WITH " + _CANDS + """
SELECT image_id, max(idx) AS idx FROM walked GROUP BY image_id
HAVING sum(CASE WHEN considered AND fits THEN 1 ELSE 0 END) = 0"""


@register("preset_fallback", _FALLBACK_SQL)
def preset_fallback(spark, sf):
    """Images where nothing fits fall back to the last preset."""
    ch = S.choose(_cands(spark, sf), BUDGET, with_svg=False)
    return ch.where("fallback").select("image_id", "idx")


_WINNER_SQL = "WITH " + _CANDS + """,
best AS (SELECT image_id, idx, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, idx) AS rn
  FROM walked WHERE considered AND fits),
pick AS (
  SELECT w.image_id, coalesce(max(b.idx), max(w.idx)) AS idx FROM walked w
  LEFT JOIN best b ON b.image_id = w.image_id AND b.rn = 1 GROUP BY w.image_id),
li AS (SELECT l_orderkey, l_linenumber,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS idx
  FROM lineitem)
SELECT p.image_id, p.idx, '<svg id="' || CAST(p.image_id AS VARCHAR) || '-' || CAST(li.l_linenumber AS VARCHAR) || '"/>' AS svg
FROM pick p JOIN li ON li.l_orderkey = p.image_id AND li.idx = p.idx"""


@register("preset_winner_svg", _WINNER_SQL)
def preset_winner_svg(spark, sf):
    """A3 with the markup joined back for the winners only."""
    ch = S.choose(_cands(spark, sf), BUDGET, with_svg=True)
    return ch.select("image_id", "idx", "svg")


def _presets_sql(posterize: bool) -> str:
    rows = S.preset_rows(posterize)
    vals = ", ".join(f"({r[0]}, {r[1]}, {r[3]}, {r[4]}, {r[9]}, '{r[10]}')" for r in rows)
    return f"presets(idx, max_dim, color_precision, layer_difference, path_precision, mode) AS (VALUES {vals})"


_GRID_SQL = "WITH " + _presets_sql(True) + """
SELECT e.vec_id AS image_id, p.idx, p.max_dim, p.color_precision, p.layer_difference, p.path_precision, p.mode,
  CASE WHEN p.max_dim / 8.0 < 1 THEN greatest(1, CAST(round_even(8 * (p.max_dim / 8.0), 0) AS INTEGER)) ELSE 8 END AS width
FROM embeddings e, presets p"""


@register("preset_grid", _GRID_SQL)
def preset_grid(spark, sf):
    """J2 + I12 + X14: every 8x8 tile with every posterised preset, and the traced width."""
    imgs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"))
    grid = S.with_presets(imgs, posterize=True)
    w, _ = markup.scaled_size(F.lit(FX.TILE_SIDE), F.lit(FX.TILE_SIDE), F.col("max_dim"))
    return grid.select("image_id", "idx", "max_dim", "color_precision", "layer_difference", "path_precision",
                       "mode", w.alias("width"))
