"""Queries over 8x8 tiles derived from ``embeddings`` (pixel-table operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.operators import pixels as P
from loomkit.operators import select as S
from loomkit.plans.registry import register
from loomkit.sources import fixtures as FX
from loomkit.sources.tables import table

LEVELS = P.POSTERIZE_LEVELS
SMALL_DIM = 3
SIGMA = 1.0


def tiles(spark, sf):
    return FX.tiles(table(spark, sf, "embeddings"))


_TILES = """tiles AS (
  SELECT vec_id AS image_id, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x,
    CAST(least(greatest(floor((CAST(embedding[i + 1] AS DOUBLE) + 0.5) * 255), 0), 255) AS INTEGER) AS r,
    CAST(least(greatest(floor((CAST(embedding[(i + 1) % 64 + 1] AS DOUBLE) + 0.5) * 255), 0), 255) AS INTEGER) AS g,
    CAST(least(greatest(floor((CAST(embedding[(i + 2) % 64 + 1] AS DOUBLE) + 0.5) * 255), 0), 255) AS INTEGER) AS b,
    255 AS a
  FROM embeddings, range(0, 64) t(i))"""

_LUMA_EXPR = ("CAST(floor(CAST(CAST(0.299 AS FLOAT) * CAST(r AS FLOAT) + CAST(0.587 AS FLOAT) * CAST(g AS FLOAT)"
              " + CAST(0.114 AS FLOAT) * CAST(b AS FLOAT) AS FLOAT)) AS INTEGER)")
_LUMA = _TILES + f""",
luma AS (SELECT image_id, y, x, {_LUMA_EXPR} AS r, a FROM tiles)"""


@register("luma", "WITH " + _LUMA + "\nSELECT image_id, y, x, r AS gray FROM luma")
def luma_q(spark, sf):
    """Single-precision luma, truncated."""
    return P.luma(tiles(spark, sf)).select("image_id", "y", "x", F.col("r").alias("gray"))


@register("mean_gray", "WITH " + _TILES + "\nSELECT image_id, y, x, round((r + g + b) / 3.0, 6) AS mean_gray FROM tiles")
def mean_gray_q(spark, sf):
    """Mean of the three channels."""
    return P.mean_gray(tiles(spark, sf)).select("image_id", "y", "x", F.round("mean_gray", 6).alias("mean_gray"))


_POST = f"CAST(floor(round_even(r / 255.0 * {LEVELS - 1}, 0) / {LEVELS - 1} * 255) AS INTEGER)"


@register("posterize_uniform", "WITH " + _LUMA + f"\nSELECT image_id, y, x, {_POST} AS tone FROM luma")
def posterize_uniform_q(spark, sf):
    """I4: three evenly spaced gray levels."""
    px = P.luma(tiles(spark, sf))
    return px.select("image_id", "y", "x", P.posterize_uniform(F.col("r"), LEVELS).alias("tone"))


@register("gray_distinct", "WITH " + _LUMA + "\nSELECT image_id, count(DISTINCT r) AS n_distinct FROM luma WHERE a > 0 GROUP BY image_id")
def gray_distinct_q(spark, sf):
    """A6 + F10: distinct foreground gray values per image."""
    return P.gray_distinct(P.luma(tiles(spark, sf)))


_GRAY = ("CAST(CAST(CAST(0.299 AS FLOAT) * CAST(r AS FLOAT) + CAST(0.587 AS FLOAT) * CAST(r AS FLOAT)"
         " + CAST(0.114 AS FLOAT) * CAST(r AS FLOAT) AS FLOAT) AS DOUBLE)")
_NEAR = "list_position(list_transform(c, lambda lm_c: abs(lm_c - lm_h.v)), list_min(list_transform(c, lambda lm_c: abs(lm_c - lm_h.v))))"

_KMEANS_SQL = "WITH RECURSIVE " + _LUMA + f""",
px AS (SELECT image_id, y, x, a, {_GRAY} AS v FROM luma),
hist AS (SELECT image_id, v, count(*) AS n FROM px WHERE a > 0 GROUP BY image_id, v),
cum AS (SELECT image_id, v, n, sum(n) OVER (PARTITION BY image_id ORDER BY v) AS cn,
  sum(n) OVER (PARTITION BY image_id) AS total FROM hist),
per AS (SELECT image_id, count(*) AS nd, list({{'v': v, 'n': n}} ORDER BY v) AS h,
  [{", ".join(f"min(v) FILTER (cn > floor(({j} + 0.5) * total / {LEVELS}))" for j in range(LEVELS))}] AS c FROM cum GROUP BY image_id),
walk(image_id, h, c, was) AS (
  SELECT image_id, h, c, CAST(NULL AS DOUBLE[]) FROM per
  UNION ALL
  SELECT image_id, h, list_transform(range(1, {LEVELS + 1}), lambda lm_j: coalesce(
    list_sum(list_transform(list_filter(m, lambda lm_m: lm_m.k = lm_j), lambda lm_m: lm_m.v * lm_m.n))
      / list_sum(list_transform(list_filter(m, lambda lm_m: lm_m.k = lm_j), lambda lm_m: lm_m.n)), c[lm_j])), c
  FROM (SELECT image_id, h, c, list_transform(h, lambda lm_h: {{'v': lm_h.v, 'n': lm_h.n, 'k': {_NEAR}}}) AS m
        FROM walk WHERE was IS NULL OR was <> c)),
still AS (SELECT image_id, list_sort(c) AS c FROM walk WHERE was = c),
near AS (
  SELECT image_id, y, x, a, v, cc FROM (
    SELECT px.image_id, px.y, px.x, px.a, px.v, e.cc,
      row_number() OVER (PARTITION BY px.image_id, px.y, px.x ORDER BY abs(e.cc - px.v), e.cc) AS rk
    FROM px JOIN (SELECT image_id, unnest(c) AS cc FROM still) e ON e.image_id = px.image_id) WHERE rk = 1)
SELECT near.image_id, near.y, near.x,
  CAST(CASE WHEN per.nd > {LEVELS} AND near.a > 0 THEN floor(near.cc) WHEN per.nd > {LEVELS} THEN 0 ELSE floor(near.v) END AS INTEGER) AS tone
FROM near JOIN per ON per.image_id = near.image_id"""


@register("posterize_kmeans", _KMEANS_SQL)
def posterize_kmeans_q(spark, sf):
    """Per-image 1-D k-means (3 levels, quantile start, Lloyd rounds until nothing moves)."""
    px = P.luma(tiles(spark, sf))
    return P.posterize_kmeans(px, LEVELS).select("image_id", "y", "x", F.col("r").alias("tone"))


_CUTOUT_SQL = "WITH RECURSIVE " + _TILES + f""",
g AS (SELECT image_id, y, x, (r + g + b) / 3.0 AS v FROM tiles),
dims AS (SELECT image_id, max(y) AS ymax, max(x) AS xmax FROM g GROUP BY image_id),
corners AS (SELECT g.image_id, g.y * 2 + CASE WHEN g.x = 0 THEN 0 ELSE 1 END AS corner, g.y, g.x, g.v AS sv
  FROM g JOIN dims d ON d.image_id = g.image_id WHERE (g.y = 0 OR g.y = d.ymax) AND (g.x = 0 OR g.x = d.xmax)),
elig AS (SELECT g.image_id, c.corner, g.y, g.x FROM g JOIN corners c ON c.image_id = g.image_id WHERE abs(g.v - c.sv) <= {P.BG_TOLERANCE}),
reach(image_id, corner, y, x) AS (
  SELECT image_id, corner, y, x FROM corners
  UNION
  SELECT e.image_id, e.corner, e.y, e.x FROM reach r JOIN elig e
    ON e.image_id = r.image_id AND e.corner = r.corner AND abs(e.y - r.y) <= 1 AND abs(e.x - r.x) <= 1)
SELECT DISTINCT image_id, y, x FROM reach"""


@register("cutout_mask", _CUTOUT_SQL)
def cutout_mask_q(spark, sf):
    """I3 + U3: background pixels reachable from a corner within tolerance 18."""
    return P.cutout_mask(tiles(spark, sf))


_DOWN_SQL = "WITH " + _TILES + f""",
d AS (SELECT image_id, max(x) + 1 AS w, max(y) + 1 AS h FROM tiles GROUP BY image_id),
s AS (SELECT image_id, w, h,
  CASE WHEN {SMALL_DIM}.0 / greatest(w, h) < 1 THEN greatest(1, CAST(round_even(w * ({SMALL_DIM}.0 / greatest(w, h)), 0) AS INTEGER)) ELSE w END AS nw,
  CASE WHEN {SMALL_DIM}.0 / greatest(w, h) < 1 THEN greatest(1, CAST(round_even(h * ({SMALL_DIM}.0 / greatest(w, h)), 0) AS INTEGER)) ELSE h END AS nh
  FROM d)
SELECT t.image_id, CAST(floor(t.y * s.nh / s.h) AS INTEGER) AS y, CAST(floor(t.x * s.nw / s.w) AS INTEGER) AS x,
  CAST(floor(avg(t.r) + 0.5) AS INTEGER) AS r, CAST(floor(avg(t.g) + 0.5) AS INTEGER) AS g,
  CAST(floor(avg(t.b) + 0.5) AS INTEGER) AS b, CAST(floor(avg(t.a) + 0.5) AS INTEGER) AS a
FROM tiles t JOIN s ON s.image_id = t.image_id GROUP BY 1, 2, 3"""


@register("downscale_box", _DOWN_SQL)
def downscale_box_q(spark, sf):
    """I6 + X14: 8x8 tiles shrunk to at most 3 pixels per side by box averaging."""
    return P.downscale_box(tiles(spark, sf), SMALL_DIM)


_LANCZOS_SQL = "WITH " + _TILES + """,
s AS (SELECT image_id, 8 AS src, 3 AS dst FROM tiles GROUP BY image_id),
place AS (SELECT onto, pos, (pos + 0.5 - (onto + 0.5) * 8 / 3.0) / (8 / 3.0) AS z
  FROM range(3) o(onto), range(8) f(pos)
  WHERE pos >= floor((onto + 0.5) * 8 / 3.0 - 8 + 0.5) AND pos < floor((onto + 0.5) * 8 / 3.0 + 8 + 0.5)),
raw AS (SELECT onto, pos, CASE WHEN z = 0 THEN 1.0 WHEN z >= -3 AND z < 3
  THEN sin(pi() * z) / (pi() * z) * sin(pi() * z / 3) / (pi() * z / 3) ELSE 0.0 END AS v FROM place),
wt AS (SELECT onto, pos, CAST(round(v / sum(v) OVER (PARTITION BY onto) * 4194304) AS BIGINT) AS k FROM raw),
pm AS (SELECT image_id, y, x, b AS a, r * b + 128 AS r, g * b + 128 AS g, b * b + 128 AS b FROM tiles),
mul AS (SELECT image_id, y, x, a, ((r >> 8) + r) >> 8 AS r, ((g >> 8) + g) >> 8 AS g, ((b >> 8) + b) >> 8 AS b FROM pm),
hor AS (SELECT image_id, y, onto AS x, least(greatest((sum(r * k) + 2097152) >> 22, 0), 255) AS r,
  least(greatest((sum(g * k) + 2097152) >> 22, 0), 255) AS g, least(greatest((sum(b * k) + 2097152) >> 22, 0), 255) AS b,
  least(greatest((sum(a * k) + 2097152) >> 22, 0), 255) AS a
  FROM mul JOIN wt ON wt.pos = mul.x GROUP BY 1, 2, 3),
ver AS (SELECT image_id, onto AS y, x, least(greatest((sum(r * k) + 2097152) >> 22, 0), 255) AS r,
  least(greatest((sum(g * k) + 2097152) >> 22, 0), 255) AS g, least(greatest((sum(b * k) + 2097152) >> 22, 0), 255) AS b,
  least(greatest((sum(a * k) + 2097152) >> 22, 0), 255) AS a
  FROM hor JOIN wt ON wt.pos = hor.y GROUP BY 1, 2, 3)
SELECT image_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x,
  CAST(CASE WHEN a IN (0, 255) THEN r ELSE least(r * 255 // a, 255) END AS INTEGER) AS r,
  CAST(CASE WHEN a IN (0, 255) THEN g ELSE least(g * 255 // a, 255) END AS INTEGER) AS g,
  CAST(CASE WHEN a IN (0, 255) THEN b ELSE least(b * 255 // a, 255) END AS INTEGER) AS b, CAST(a AS INTEGER) AS a
FROM ver"""


@register("downscale_lanczos", _LANCZOS_SQL)
def downscale_lanczos_q(spark, sf):
    """8x8 tiles, their alpha taken from the blue channel, shrunk to 3 pixels per side by Lanczos weights."""
    return P.downscale_lanczos(tiles(spark, sf).withColumn("a", F.col("b")), SMALL_DIM)


def _blur_sql() -> str:
    ws = ", ".join(f"({d}, {w!r})" for d, w in P.gaussian_weights(SIGMA))
    return "WITH " + _TILES + f""",
wt(d, w) AS (VALUES {ws}),
hp AS (SELECT t.image_id, t.y, t.x + wt.d AS x, t.r, t.g, t.b, wt.w FROM tiles t, wt WHERE t.x + wt.d BETWEEN 0 AND 7),
h AS (SELECT image_id, y, x, sum(r * w) / sum(w) AS r, sum(g * w) / sum(w) AS g, sum(b * w) / sum(w) AS b FROM hp GROUP BY 1, 2, 3),
vp AS (SELECT h.image_id, h.y + wt.d AS y, h.x, h.r, h.g, h.b, wt.w FROM h, wt WHERE h.y + wt.d BETWEEN 0 AND 7)
SELECT image_id, y, x, round(sum(r * w) / sum(w), 6) AS r, round(sum(g * w) / sum(w), 6) AS g,
  round(sum(b * w) / sum(w), 6) AS b FROM vp GROUP BY 1, 2, 3"""


@register("blur_weights", _blur_sql())
def blur_q(spark, sf):
    """I7 + J6: separable Gaussian blur (sigma 1) with edge renormalisation."""
    out = P.blur(tiles(spark, sf), SIGMA)
    return out.select("image_id", "y", "x", *[F.round(c, 6).alias(c) for c in "rgb"])


def _ssim_sql() -> str:
    post = lambda c: f"CAST(floor(round_even({c} / 255.0 * {LEVELS - 1}, 0) / {LEVELS - 1} * 255) AS INTEGER)"
    chans = " UNION ALL ".join(
        f"SELECT image_id, y, x, '{c}' AS ch, CAST({c} AS DOUBLE) AS va, CAST({post(c)} AS DOUBLE) AS vb FROM tiles"
        for c in "rgb")
    return "WITH " + _TILES + f""",
l AS ({chans}),
p AS (SELECT *, va * va AS aa, vb * vb AS bb, va * vb AS ab FROM l),
rw AS (SELECT image_id, ch, y, x,
  sum(va) OVER w AS va, sum(vb) OVER w AS vb, sum(aa) OVER w AS aa, sum(bb) OVER w AS bb, sum(ab) OVER w AS ab, count(*) OVER w AS nx
  FROM p WINDOW w AS (PARTITION BY image_id, ch, y ORDER BY x ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
cw AS (SELECT image_id, ch, y, x,
  sum(va) OVER w AS va, sum(vb) OVER w AS vb, sum(aa) OVER w AS aa, sum(bb) OVER w AS bb, sum(ab) OVER w AS ab, sum(nx) OVER w AS np
  FROM rw WINDOW w AS (PARTITION BY image_id, ch, x ORDER BY y ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s AS (SELECT image_id, va / 49.0 AS ux, vb / 49.0 AS uy, aa, bb, ab FROM cw WHERE np = 49),
t AS (SELECT image_id, ux, uy, 49.0 / 48.0 * (aa / 49.0 - ux * ux) AS vx, 49.0 / 48.0 * (bb / 49.0 - uy * uy) AS vy,
  49.0 / 48.0 * (ab / 49.0 - ux * uy) AS vxy FROM s)
SELECT image_id, round(avg(((2 * ux * uy + {P.SSIM_C1!r}) * (2 * vxy + {P.SSIM_C2!r}))
  / ((ux * ux + uy * uy + {P.SSIM_C1!r}) * (vx + vy + {P.SSIM_C2!r}))), 6) AS ssim FROM t GROUP BY image_id"""


@register("ssim_tiles", _ssim_sql())
def ssim_q(spark, sf):
    """I8 (W3 + A8): SSIM of each tile against its 3-level posterised version."""
    t = tiles(spark, sf)
    post = t.select("image_id", "y", "x", *[P.posterize_uniform(F.col(c), LEVELS).alias(c) for c in "rgb"])
    out = P.ssim(t, post)
    return out.select("image_id", F.round("ssim", 6).alias("ssim"))


_RUNS_CTE = "WITH " + _LUMA + f""",
pt AS (SELECT image_id, y, x, {_POST} AS tone FROM luma WHERE a > 0),
st AS (SELECT *, CASE WHEN lag(x) OVER w IS NULL OR lag(x) OVER w <> x - 1 OR lag(tone) OVER w <> tone THEN 1 ELSE 0 END AS s
  FROM pt WINDOW w AS (PARTITION BY image_id, y ORDER BY x)),
gr AS (SELECT *, sum(s) OVER (PARTITION BY image_id, y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM st),
runs AS (SELECT image_id, y, run, min(tone) AS tone, min(x) AS x0, max(x) AS x1 FROM gr GROUP BY image_id, y, run)"""

_TRACE_SQL = _RUNS_CTE + """,
seg AS (SELECT image_id, tone, y, x0, 'M' || CAST(x0 AS VARCHAR) || ' ' || CAST(y AS VARCHAR) || 'h' || CAST(x1 - x0 + 1 AS VARCHAR)
  || 'v1h-' || CAST(x1 - x0 + 1 AS VARCHAR) || 'z' AS seg FROM runs),
pt2 AS (SELECT image_id, tone, string_agg(seg, '' ORDER BY y, x0) AS d, count(*) AS n FROM seg GROUP BY image_id, tone),
pth AS (SELECT image_id, tone, n, '<path fill="#' || lpad(lower(hex(tone)), 2, '0') || lpad(lower(hex(tone)), 2, '0')
  || lpad(lower(hex(tone)), 2, '0') || '" d="' || d || '"/>' AS p FROM pt2),
img AS (SELECT image_id, string_agg(p, '' ORDER BY tone) AS paths, sum(n) AS n_runs FROM pth GROUP BY image_id),
dims AS (SELECT image_id, max(x) + 1 AS w, max(y) + 1 AS h FROM luma GROUP BY image_id)
SELECT d.image_id, '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 ' || CAST(d.w AS VARCHAR) || ' ' || CAST(d.h AS VARCHAR)
  || '">' || coalesce(i.paths, '') || '</svg>' AS svg, CAST(coalesce(i.n_runs, 0) AS BIGINT) AS n_runs
FROM dims d LEFT JOIN img i ON i.image_id = d.image_id"""


def _posterized(spark, sf):
    px = P.luma(tiles(spark, sf))
    tone = P.posterize_uniform(F.col("r"), LEVELS)
    return px.select("image_id", "y", "x", tone.alias("r"), tone.alias("g"), tone.alias("b"), "a")


@register("trace_runs", _TRACE_SQL)
def trace_runs_q(spark, sf):
    """I9 (W6): posterised tiles traced into run-rectangle paths, one per tone."""
    return P.trace_runs(_posterized(spark, sf))


@register("rasterize_runs", _RUNS_CTE + """,
px AS (SELECT image_id, y, unnest(range(x0, x1 + 1)) AS x, tone FROM runs)
SELECT image_id, tone, count(*) AS n_pixels, CAST(sum(x + 8 * y) AS BIGINT) AS pos_sum FROM px GROUP BY image_id, tone""")
def rasterize_runs_q(spark, sf):
    """Runs back to pixels; per image and tone the pixel count and positions."""
    r = P.runs(_posterized(spark, sf))
    px = P.rasterize_runs(r)
    return px.groupBy("image_id", "tone").agg(F.count(F.lit(1)).alias("n_pixels"),
                                              F.sum(F.col("x") + 8 * F.col("y")).cast("bigint").alias("pos_sum"))


FINE = 16                # gray levels of the speckle query
_SPECKLE_SQL = "WITH RECURSIVE " + _LUMA + f""",
fine AS (SELECT image_id, y * 8 + x AS p, CAST(floor(round_even(r / 255.0 * {FINE - 1}, 0) / {FINE - 1} * 255) AS INTEGER) AS tone FROM luma),
reach(image_id, tone, s, p) AS (
  SELECT image_id, tone, p, p FROM fine
  UNION
  SELECT r.image_id, r.tone, r.s, f.p FROM reach r JOIN fine f ON f.image_id = r.image_id AND f.tone = r.tone
    AND (abs(f.p - r.p) = 8 OR (abs(f.p - r.p) = 1 AND f.p // 8 = r.p // 8))),
area AS (SELECT image_id, tone, s AS p, count(*) AS area FROM reach GROUP BY ALL),
bars(filter_speckle) AS (VALUES {", ".join(f"({b})" for b in sorted({p[1] for p in S.POSTER_PRESETS})[:4])})
SELECT image_id, filter_speckle, tone, count(*) AS n_pixels, CAST(sum(p) AS BIGINT) AS pos_sum
FROM area, bars WHERE area >= filter_speckle * filter_speckle GROUP BY ALL"""


@register("trace_speckle", _SPECKLE_SQL)
def trace_speckle(spark, sf):
    """What the speckle bounds of four presets leave of each tile at 16 gray levels."""
    px = P.luma(tiles(spark, sf))
    px = px.select("image_id", "y", "x", P.posterize_uniform(F.col("r"), FINE).alias("r"), "a")
    bars = sorted({p[1] for p in S.POSTER_PRESETS})[:4]
    px = px.withColumn("bar", F.explode(F.array(*[F.lit(b) for b in bars])))
    px = px.withColumn("image_id", F.col("image_id") * 64 + F.col("bar"))
    cells = P.rasterize_runs(P.speckled_runs(px, "r", "bar"))
    key = F.col("image_id")
    return cells.groupBy(F.floor(key / 64).alias("image_id"), (key % 64).cast("int").alias("filter_speckle"), "tone") \
        .agg(F.count(F.lit(1)).alias("n_pixels"), F.sum(F.col("x") + 8 * F.col("y")).cast("bigint").alias("pos_sum"))


@register("convert_mosaics")
def convert_mosaics(spark, sf):
    """I11 over images of 400 pixels, which the presets shrink: string ids, presets that differ in
    size and speckles, scores at the size of the source."""
    from loomkit.plans.convert import convert
    out = convert(FX.mosaics(table(spark, sf, "embeddings")), target_kb=20.0)
    return out.select("image_id", "idx", "size", F.round("score", 6).alias("score"), "fallback",
                      "n_candidates", "n_considered", "svg")


@register("convert_colours")
def convert_colours(spark, sf):
    """I11 + I12 with the colour presets (blur, colour precision) and without the cut-out."""
    from loomkit.plans.convert import convert
    out = convert(tiles(spark, sf), cutout=False, posterize=None)
    return out.select("image_id", "idx", "size", F.round("score", 6).alias("score"), "fallback",
                      "n_candidates", "n_considered", "svg")


@register("convert_tiles")
def convert_tiles(spark, sf):
    """Cut-out, 3-level posterising, tracing, minify and preset choice per tile."""
    from loomkit.plans.convert import convert
    out = convert(tiles(spark, sf))
    return out.select("image_id", "idx", "size", F.round("score", 6).alias("score"), "fallback",
                      "n_candidates", "n_considered", "svg")


@register("build_corpus")
def build_corpus_q(spark, sf):
    """Tiles -> markup -> class-name captions -> corpus rows (first 100 by id)."""
    from loomkit.plans.convert import build_corpus
    emb = table(spark, sf, "embeddings")
    return build_corpus(tiles(spark, sf), FX.labelled_rows(emb), FX.class_names(table(spark, sf, "nation")),
                        "tiles", 100)
