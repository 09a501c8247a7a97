"""Pixel-table operators.

Input: ``pixels(image_id, y, x, r, g, b, a)``, one row per pixel, integers 0-255.
Every operator runs over all images at once. Per-image work groups by
``image_id`` (plus row or column); once the table is hash-partitioned by
``image_id`` those groupings and windows reuse that partitioning. A single image
is bounded by its raster size, so no group grows with the number of images.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.functions.markup import scaled_size
from loomkit.operators import regions
from loomkit.operators.records import bounded_broadcast, small_side
from loomkit.session import cut_lineage

# Luma weights, cut-out tolerance, SSIM constants (7x7 windows,
# K1 = 0.01, K2 = 0.03 on the 0-255 range, sample covariance), default levels.
LUMA = (0.299, 0.587, 0.114)
BG_TOLERANCE = 18
SSIM_WIN = 7
SSIM_C1 = (0.01 * 255) ** 2
SSIM_C2 = (0.03 * 255) ** 2
POSTERIZE_LEVELS = 3
# Lanczos resampling: lobes of the kernel, and the fixed point that weights are rounded to.
LANCZOS_LOBES = 3
WEIGHT_ONE = 1 << 22

#: pixels of one task, where a stage holds them with their window sums
PART_PIXELS = 250_000

#: weights that are broadcast (about 30 MB); beyond it the join shuffles
MAX_WEIGHTS = 1_000_000


def spread(px: DataFrame, pixels: int | None, *keys: str) -> DataFrame:
    """``px`` by ``keys`` in parts of about ``PART_PIXELS``, so that a task's memory does not grow with the
    table. Few or unknown ``pixels`` are left to the engine, which then has a part per core at least."""
    parts = math.ceil((pixels or 0) / PART_PIXELS)
    if parts <= px.sparkSession.sparkContext.defaultParallelism:
        return px.repartition(*keys)
    return px.repartition(parts, *keys)


def luma(px: DataFrame) -> DataFrame:
    """gray = trunc(0.299 r + 0.587 g + 0.114 b) in single precision; alpha kept."""
    f = lambda c: F.col(c).cast("float")
    w = [F.lit(v).cast("float") for v in LUMA]
    g = (w[0] * f("r") + w[1] * f("g") + w[2] * f("b")).cast("float")
    gray = F.floor(g).cast("int")
    return px.withColumn("gray", gray).select("image_id", "y", "x", F.col("gray").alias("r"),
                                              F.col("gray").alias("g"), F.col("gray").alias("b"), "a")


def mean_gray(px: DataFrame) -> DataFrame:
    """(r + g + b) / 3 as a double."""
    return px.withColumn("mean_gray", (F.col("r") + F.col("g") + F.col("b")) / 3.0)


def posterize_uniform(v: Column, n: int) -> Column:
    """I4: round(v / 255 * (n-1)) / (n-1) * 255, half to even, truncated to an integer."""
    return F.floor(F.bround(v / 255.0 * (n - 1), 0) / (n - 1) * 255).cast("int")


def gray_distinct(px: DataFrame, gray_col: str = "r") -> DataFrame:
    """Distinct foreground gray values per image (compared with the level count)."""
    return (px.where(F.col("a") > 0).groupBy("image_id")
            .agg(F.countDistinct(gray_col).alias("n_distinct")))


def _nearest(centroids: Column, v: Column) -> Column:
    """Index (1-based) of the nearest centroid; ties go to the lower index."""
    scored = F.transform(centroids, lambda c, i: F.struct(F.abs(c - v).alias("d"), i.alias("i")))
    return F.array_min(scored)["i"] + 1


def lloyd(v: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Sorted 1-D centroids of the values ``v`` (ascending) with counts ``n``, moved until they stand still.

    Start: the weighted (j + 0.5)/k quantiles. A cluster is a stretch of the values, cut halfway
    between neighbouring centroids (the lower one takes a tie), so its mean is a difference of
    cumulative sums. Empty clusters keep their centroid.
    """
    count = np.concatenate([[0], np.cumsum(n)])
    total = np.concatenate([[0.0], np.cumsum(v * n)])
    cent = v[np.searchsorted(count[1:], np.floor((np.arange(k) + 0.5) * count[-1] / k), "right")]
    while True:
        gap = np.abs(v[:, None] - cent[None, :])
        near = gap.argmin(axis=1)
        cuts = np.searchsorted(near, np.arange(k + 1))
        size = np.diff(count[cuts])
        new = np.where(size > 0, np.diff(total[cuts]) / np.maximum(size, 1), cent)
        if (new == cent).all():
            return np.sort(cent)
        cent = new


def _centroids(k: int):
    def run(batches):
        for batch in batches:
            out = [lloyd(np.array([e["v"] for e in h], dtype=float), np.array([e["n"] for e in h], dtype=np.int64), k)
                   for h in batch.column("hist").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("image_id"), batch.column("n_distinct"),
                 pa.array([c.tolist() for c in out], pa.list_(pa.float64()))], ["image_id", "n_distinct", "centroids"])
    return run


def kmeans_centroids(px: DataFrame, k: int = POSTERIZE_LEVELS, gray_col: str = "gray") -> DataFrame:
    """Per-image 1-D k-means on the foreground gray histogram, to convergence.

    The histogram of one image has at most one entry per gray value, so it is a
    bounded array per image. ``(image_id, n_distinct, centroids)``, centroids sorted.
    """
    fg = px.where(F.col("a") > 0)
    hist = fg.groupBy("image_id", F.col(gray_col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    per = hist.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("hist"),
                                       F.count(F.lit(1)).alias("n_distinct"))
    kind = dict(px.dtypes)["image_id"]
    return per.mapInArrow(_centroids(k), f"image_id {kind}, n_distinct bigint, centroids array<double>")


def posterize_kmeans(px: DataFrame, k: int = POSTERIZE_LEVELS) -> DataFrame:
    """Every pixel takes its nearest centroid (truncated); background becomes 0.

    Images with at most ``k`` distinct foreground values keep their gray values.
    ``gray`` is the single-precision luma of the (already gray) pixel.
    """
    f = lambda c: F.col(c).cast("float")
    w = [F.lit(v).cast("float") for v in LUMA]
    g = (w[0] * f("r") + w[1] * f("g") + w[2] * f("b")).cast("double")
    base = px.withColumn("gray", g)
    cents = kmeans_centroids(base, k)
    joined = base.join(cents, "image_id", "left")
    clustered = F.col("n_distinct") > k
    near = F.element_at(F.col("centroids"), _nearest(F.col("centroids"), F.col("gray")))
    post = (F.when(clustered & (F.col("a") > 0), F.floor(near))
            .when(clustered, F.lit(0))
            .otherwise(F.floor(F.col("gray")))).cast("int")
    return joined.select("image_id", "y", "x", post.alias("r"), post.alias("g"), post.alias("b"), "a")


def corner_values(px: DataFrame) -> DataFrame:
    """``(image_id, seeds)``: mean gray and place of the up to four corner pixels, from one aggregation."""
    v = (F.col("r") + F.col("g") + F.col("b")) / 3.0
    left, top = F.when(F.col("x") == 0, F.struct("y", v.alias("v"))), F.when(F.col("y") == 0, F.struct("x", v.alias("v")))
    per = px.groupBy("image_id").agg(
        F.max("y").alias("ymax"), F.max("x").alias("xmax"),
        F.max(F.when((F.col("x") == 0) & (F.col("y") == 0), v)).alias("first"),
        F.max(top).alias("top"), F.max(left).alias("left"), F.max(F.struct("y", "x", v.alias("v"))).alias("last"))
    zero = F.lit(0)

    def seed(y: Column, x: Column, value: Column, there: Column) -> Column:
        return F.when(there, F.struct(y.cast("int").alias("y"), x.cast("int").alias("x"), value.alias("v")))
    seeds = F.array(
        seed(zero, zero, F.col("first"), F.col("first").isNotNull()),
        seed(zero, F.col("xmax"), F.col("top.v"), F.col("top.x") == F.col("xmax")),
        seed(F.col("ymax"), zero, F.col("left.v"), F.col("left.y") == F.col("ymax")),
        seed(F.col("ymax"), F.col("xmax"), F.col("last.v"),
             (F.col("last.y") == F.col("ymax")) & (F.col("last.x") == F.col("xmax"))))
    return per.select("image_id", "ymax", F.filter(seeds, lambda s: s.isNotNull()).alias("seeds"))


def cutout_runs(px: DataFrame, tolerance: int = BG_TOLERANCE, strip: int = regions.STRIP) -> DataFrame:
    """Runs ``(image_id, y, x0, x1)`` of the background, per seed value (runs of two values may overlap).

    The pixels within ``tolerance`` of a corner's mean gray are one layer per distinct value;
    a region of the layer is background when it holds a corner of that value.
    """
    corners = cut_lineage(corner_values(px))
    values = corners.select("image_id", F.array_distinct(F.transform("seeds", lambda s: s["v"])).alias("seed"))
    gray = px.select("image_id", "y", "x", ((F.col("r") + F.col("g") + F.col("b")) / 3.0).alias("v"))
    layer = (gray.join(small_side(values), "image_id").select("image_id", "y", "x", "v", F.explode("seed").alias("seed"))
             .where(F.abs(F.col("v") - F.col("seed")) <= tolerance).drop("v"))
    low = corners.agg(F.max("ymax")).first()[0]
    runs_of = cut_lineage(regions.label_regions(layer, ["image_id", "seed"], strip=strip,
                                                one_strip=low is None or low < strip))
    at = corners.select("image_id", F.explode("seeds").alias("s")).select(
        "image_id", F.col("s.v").alias("seed"), F.col("s.y").alias("y"), F.col("s.x").alias("_x"))
    held = runs_of.join(at, ["image_id", "seed", "y"]).where("_x BETWEEN x0 AND x1") \
        .select("image_id", "seed", "region").distinct()
    return runs_of.join(held, ["image_id", "seed", "region"], "left_semi").select("image_id", "y", "x0", "x1")


def cutout_mask(px: DataFrame, tolerance: int = BG_TOLERANCE, strip: int = regions.STRIP) -> DataFrame:
    """I3 + U3: pixels connected (8 neighbours) to any corner whose mean gray is
    within ``tolerance`` of *that corner's* value -> ``(image_id, y, x)``."""
    found = cutout_runs(px, tolerance, strip)
    return found.select("image_id", "y", F.explode(F.sequence("x0", "x1")).alias("x")).distinct()


def cutout(px: DataFrame, tolerance: int = BG_TOLERANCE) -> DataFrame:
    """Background (the mask) gets alpha 0, everything else alpha 255."""
    mask = cutout_mask(px, tolerance).withColumn("_bg", F.lit(True))
    out = px.join(mask, ["image_id", "y", "x"], "left")
    return out.select("image_id", "y", "x", "r", "g", "b",
                      F.when(F.col("_bg"), 0).otherwise(255).alias("a"))


def image_dims(px: DataFrame) -> DataFrame:
    return px.groupBy("image_id").agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"))


def downscale_box(px: DataFrame, max_dim: int) -> DataFrame:
    """I6 + X14: shrink only; each target pixel is the rounded mean of the source
    pixels that map onto it (``floor(x * w' / w)``), channel by channel."""
    d = image_dims(px)
    nw, nh = scaled_size(F.col("w"), F.col("h"), F.lit(max_dim))
    return downscale_to(px, d.select("image_id", "w", "h", nw.alias("nw"), nh.alias("nh")))


def downscale_to(px: DataFrame, sizes: DataFrame, out_id: str = "image_id") -> DataFrame:
    """``sizes(image_id, w, h, nw, nh[, out_id])`` names the size of each image, or several
    sizes under an ``out_id`` of their own."""
    j = px.select("image_id", "y", "x", "r", "g", "b", "a").join(small_side(sizes), "image_id")
    tx = F.floor(F.col("x") * F.col("nw") / F.col("w")).cast("int")
    ty = F.floor(F.col("y") * F.col("nh") / F.col("h")).cast("int")
    agg = j.groupBy(F.col(out_id).alias("image_id"), ty.alias("y"), tx.alias("x")).agg(
        *[F.floor(F.avg(c) + 0.5).cast("int").alias(c) for c in "rgba"])
    return agg.select("image_id", "y", "x", "r", "g", "b", "a")


def lanczos_weights(lengths: DataFrame) -> DataFrame:
    """``lengths(src, dst)`` -> ``(src, dst, at, onto, weight)``, the share of source place ``at``
    in target place ``onto`` along one axis, in units of 2^-22.

    A target place covers ``src / dst`` source places; its kernel spans three such lobes to each side
    of its centre and is normalised over the places that exist.
    """
    scale = F.col("src") / F.col("dst")
    wide = F.greatest(scale, F.lit(1.0))
    reach = wide * LANCZOS_LOBES
    centre = (F.col("onto") + 0.5) * scale
    first = F.greatest(F.floor(centre - reach + 0.5), F.lit(0)).cast("int")
    last = F.least(F.floor(centre + reach + 0.5).cast("int"), F.col("src")) - 1
    z = (F.col("at") + 0.5 - centre) / wide
    sinc = lambda v: F.sin(v * math.pi) / (v * math.pi)
    raw = F.when(z == 0, 1.0).when((z >= -LANCZOS_LOBES) & (z < LANCZOS_LOBES), sinc(z) * sinc(z / LANCZOS_LOBES)) \
        .otherwise(0.0)
    places = lengths.distinct().select("src", "dst", F.explode(F.sequence(F.lit(0), F.col("dst") - 1)).alias("onto")) \
        .select("*", F.explode(F.sequence(first, last)).alias("at")).withColumn("raw", raw)
    share = F.col("raw") / F.sum("raw").over(Window.partitionBy("src", "dst", "onto"))
    fixed = F.signum(share) * F.floor(F.abs(share) * WEIGHT_ONE + 0.5)
    return places.select("src", "dst", "at", "onto", fixed.cast("long").alias("weight")).where("weight <> 0")


def _byte(total: Column) -> Column:
    """A sum of weighted levels, rounded and held within 0-255."""
    return F.greatest(F.least(F.floor((total + WEIGHT_ONE // 2) / WEIGHT_ONE), F.lit(255)), F.lit(0)).cast("int")


def _times_alpha(c: str) -> Column:
    """c * a / 255, rounded in whole numbers."""
    v = F.col(c) * F.col("a") + 128
    return F.shiftright(F.shiftright(v, 8) + v, 8)


def resample_to(px: DataFrame, sizes: DataFrame, out_id: str = "image_id") -> DataFrame:
    """I6 with Lanczos weights; ``sizes(image_id, w, h, nw, nh[, out_id])`` as in :func:`downscale_to`.

    Colours are weighted by their alpha, the rows of pixels are shrunk first, then the columns, and
    each pass ends in levels 0-255. Weights are whole numbers, so a sum does not depend on the order
    of its terms. An image that keeps its size is not touched. Both passes read one partitioning.
    """
    chans = list("rgba")
    held = (F.col("nw") == F.col("w")) & (F.col("nh") == F.col("h"))
    sides = sizes.select(F.col("w").alias("src"), F.col("nw").alias("dst")).unionByName(
        sizes.select(F.col("h").alias("src"), F.col("nh").alias("dst")))
    weights = bounded_broadcast(lanczos_weights(sides), MAX_WEIGHTS)
    key = "_id"
    named = sizes.select("image_id", F.col(out_id).alias(key), "w", "h", "nw", "nh", held.alias("_held"))
    flat = px.select("image_id", "y", "x", *chans).join(small_side(named), "image_id").select(
        key, "h", "nh", "w", "nw", "_held", "y", "x", "a",
        *[F.when(F.col("_held"), F.col(c)).otherwise(_times_alpha(c)).alias(c) for c in "rgb"])

    def along(df: DataFrame, axis: str, src: str, dst: str, keep: list[str]) -> DataFrame:
        side = weights.select(F.col("src").alias(src), F.col("dst").alias(dst), F.col("at").alias(axis), "onto", "weight")
        sums = df.join(side, [src, dst, axis]).groupBy(key, *keep, "onto").agg(
            *[F.sum(F.col(c).cast("long") * F.col("weight")).alias(c) for c in chans])
        return sums.select(key, *keep, F.col("onto").alias(axis), *[_byte(F.col(c)).alias(c) for c in chans])

    pixels = sizes.agg(F.sum(F.col("w").cast("long") * F.col("h"))).first()[0]
    rows = along(spread(flat, pixels, key), "x", "w", "nw", ["h", "nh", "_held", "y"])
    cols = along(rows, "y", "h", "nh", ["_held", "x"])
    plain = F.col("_held") | F.col("a").isin(0, 255)
    colour = [F.when(plain, F.col(c)).otherwise(F.least(F.floor(F.col(c) * 255 / F.col("a")), F.lit(255))).cast("int")
              .alias(c) for c in "rgb"]
    return cols.select(F.col(key).alias("image_id"), "y", "x", *colour, "a")


def downscale_lanczos(px: DataFrame, max_dim: int) -> DataFrame:
    """I6 + X14: shrink only, by Lanczos weights."""
    d = image_dims(px)
    nw, nh = scaled_size(F.col("w"), F.col("h"), F.lit(max_dim))
    return resample_to(px, d.select("image_id", "w", "h", nw.alias("nw"), nh.alias("nh")))


def gaussian_weights(sigma: float) -> list[tuple[int, float]]:
    """J6 offset table: exp(-d^2 / 2 sigma^2) for |d| <= ceil(3 sigma), unnormalised."""
    r = max(1, math.ceil(3 * sigma))
    return [(d, math.exp(-(d * d) / (2 * sigma * sigma))) for d in range(-r, r + 1)]


def _blur_pass(px: DataFrame, weights: list[tuple[int, float]], axis: str, chans: list[str]) -> DataFrame:
    """One separable pass: every pixel gathers its neighbours along ``axis``, one range frame per
    offset; weights are renormalised over the neighbours that exist (edges)."""
    other = "y" if axis == "x" else "x"
    w = Window.partitionBy("image_id", other).orderBy(axis)
    seen = px.select("image_id", "y", "x", *chans, *[
        F.first(F.struct(*chans)).over(w.rangeBetween(d, d)).alias(f"_{i}") for i, (d, _) in enumerate(weights)])
    there = [F.when(F.col(f"_{i}").isNotNull(), v).otherwise(0.0) for i, (_, v) in enumerate(weights)]
    whole = reduce(lambda a, b: a + b, there)
    sums = [(reduce(lambda a, b: a + b, [F.coalesce(F.col(f"_{i}")[c] * v, F.lit(0.0))
                                         for i, (_, v) in enumerate(weights)]) / whole).alias(c) for c in chans]
    return seen.select("image_id", "y", "x", *sums)


def blur(px: DataFrame, sigma: float, chans: tuple[str, ...] = ("r", "g", "b"), pixels: int | None = None) -> DataFrame:
    """Separable Gaussian blur (our weights, not the resampler's box passes). Both passes
    read one partitioning by image, by the number of ``pixels`` if given."""
    w = gaussian_weights(sigma)
    own = spread(px.select("image_id", "y", "x", *chans), pixels, "image_id")
    return _blur_pass(_blur_pass(own, w, "x", list(chans)), w, "y", list(chans))


def ssim(a: DataFrame, b: DataFrame, chans: tuple[str, ...] = ("r", "g", "b"), win: int = SSIM_WIN,
         pixels: int | None = None) -> DataFrame:
    """I8 (W3 + A8): mean SSIM per image over channels and interior 7x7 windows.

    Channels are columns, and everything reads one partitioning by image: both rasters are
    brought together by an aggregation, the window sums are a row pass and a column pass.
    Only windows fully inside the image, with all their pixels in both rasters, are kept. ``pixels``
    of one raster, if known, decide the number of parts.
    """
    half = win // 2

    def tagged(px: DataFrame, side: str) -> DataFrame:
        return px.select("image_id", "y", "x", *[
            (F.col(c).cast("double") if s == side else F.lit(None).cast("double")).alias(f"{s}_{c}")
            for s in ("p", "q") for c in chans])
    both = spread(tagged(a, "p").unionByName(tagged(b, "q")), 2 * pixels if pixels else None, "image_id")
    pairs = both.groupBy("image_id", "y", "x").agg(*[F.max(f"{s}_{c}").alias(f"{s}_{c}") for s in ("p", "q") for c in chans])
    pairs = pairs.where(reduce(lambda m, n: m & n, [F.col(f"{s}_{c}").isNotNull() for s in ("p", "q") for c in chans]))
    moments = []
    for c in chans:
        p, q = F.col(f"p_{c}"), F.col(f"q_{c}")
        moments += [(f"p_{c}", p), (f"q_{c}", q), (f"pp_{c}", p * p), (f"qq_{c}", q * q), (f"pq_{c}", p * q)]
    names = [m for m, _ in moments]
    rows = Window.partitionBy("image_id", "y").orderBy("x").rangeBetween(-half, half)
    cols = Window.partitionBy("image_id", "x").orderBy("y").rangeBetween(-half, half)
    flat = pairs.select("image_id", "y", "x", *[e.alias(m) for m, e in moments])
    flat = flat.select("image_id", "y", "x", *[F.sum(m).over(rows).alias(m) for m in names],
                       F.count(F.lit(1)).over(rows).alias("held"))
    flat = flat.select("image_id", *[F.sum(m).over(cols).alias(m) for m in names], F.sum("held").over(cols).alias("held"))
    n, cov = float(win * win), win * win / (win * win - 1.0)

    def value(c: str) -> Column:
        ux, uy = F.col(f"p_{c}") / n, F.col(f"q_{c}") / n
        vx, vy = cov * (F.col(f"pp_{c}") / n - ux * ux), cov * (F.col(f"qq_{c}") / n - uy * uy)
        vxy = cov * (F.col(f"pq_{c}") / n - ux * uy)
        return ((2 * ux * uy + SSIM_C1) * (2 * vxy + SSIM_C2)) / ((ux * ux + uy * uy + SSIM_C1) * (vx + vy + SSIM_C2))
    per = reduce(lambda m, k: m + k, [value(c) for c in chans]) / len(chans)
    return flat.where(F.col("held") == win * win).groupBy("image_id").agg(F.avg(per).alias("ssim"))


def runs(px: DataFrame, tone_col: str = "r", min_run: int = 1) -> DataFrame:
    """Horizontal runs of equal tone over foreground pixels (gaps and islands).

    ``(image_id, y, tone, x0, x1)``; runs shorter than ``min_run`` are dropped.
    """
    fg = px.where(F.col("a") > 0).select("image_id", "y", "x", F.col(tone_col).alias("tone"))
    w = Window.partitionBy("image_id", "y").orderBy("x")
    prev_x, prev_t = F.lag("x").over(w), F.lag("tone").over(w)
    start = (prev_x.isNull() | (prev_x != F.col("x") - 1) | (prev_t != F.col("tone"))).cast("int")
    grp = fg.withColumn("s", start).withColumn("run", F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = grp.groupBy("image_id", "y", "run").agg(F.first("tone").alias("tone"), F.min("x").alias("x0"),
                                                  F.max("x").alias("x1"))
    return out.where(F.col("x1") - F.col("x0") + 1 >= min_run).drop("run")


def _hex2(v: Column) -> Column:
    return F.lpad(F.lower(F.hex(v)), 2, "0")


def rgb_tone(r: Column, g: Column, b: Column) -> Column:
    """One integer per colour (r << 16 | g << 8 | b), the key of a run."""
    return (r * 65536 + g * 256 + b).cast("int")


def speckled_runs(px: DataFrame, tone_col: str, speckle: str, strip: int = regions.STRIP,
                  one_strip: bool | None = None) -> DataFrame:
    """Runs ``(image_id, y, tone, x0, x1)`` of the foreground without the connected patches of
    one tone that hold fewer than ``speckle`` squared pixels (a column, one value per image)."""
    fg = px.where(F.col("a") > 0)
    found = regions.label_regions(fg.select("image_id", F.col(tone_col).alias("tone"), "y", "x"),
                                  ["image_id", "tone"], diagonal=False, strip=strip, one_strip=one_strip)
    least = fg.groupBy("image_id").agg((F.max(speckle) * F.max(speckle)).alias("least"))
    found = found.join(least, "image_id")
    return regions.drop_speckles(found, ["image_id", "tone"], "least").select("image_id", "y", "tone", "x0", "x1")


def trace_runs(px: DataFrame, tone_col: str = "r", min_run: int = 1, rgb: bool = False) -> DataFrame:
    """``runs_markup`` of all runs of the foreground."""
    if rgb:
        px = px.withColumn("_tone", rgb_tone(F.col("r"), F.col("g"), F.col("b")))
        tone_col = "_tone"
    return runs_markup(runs(px, tone_col, min_run), image_dims(px), rgb)


def runs_markup(r: DataFrame, dims: DataFrame, rgb: bool = False) -> DataFrame:
    """One ``<path>`` per tone, each run a rectangle ``M x y h n v1 h -n z``;
    tones ascending, runs by (y, x0). Returns ``(image_id, svg, n_runs)``.

    With ``rgb=True`` the tone is ``rgb_tone(r, g, b)`` and the fill its six hex
    digits; otherwise the gray tone is repeated three times. ``dims(image_id, w, h)``
    names every image, also those without a run.
    """
    seg = F.concat(F.lit("M"), F.col("x0").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit("h"),
                   (F.col("x1") - F.col("x0") + 1).cast("string"), F.lit("v1h-"),
                   (F.col("x1") - F.col("x0") + 1).cast("string"), F.lit("z"))
    per_tone = (r.withColumn("seg", seg).groupBy("image_id", "tone")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "x0", "seg"))),
                                              lambda s: s["seg"]), "").alias("d"),
                     F.count(F.lit(1)).alias("n")))
    t = F.col("tone")
    fill = (F.lpad(F.lower(F.hex(t)), 6, "0") if rgb else F.concat(_hex2(t), _hex2(t), _hex2(t)))
    path = F.concat(F.lit('<path fill="#'), fill, F.lit('" d="'), F.col("d"), F.lit('"/>'))
    per_img = (per_tone.groupBy("image_id")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tone", path.alias("p")))),
                                             lambda s: s["p"]), "").alias("paths"),
                    F.sum("n").alias("n_runs")))
    j = dims.join(per_img, "image_id", "left")
    svg = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 '), F.col("w").cast("string"),
                   F.lit(" "), F.col("h").cast("string"), F.lit('">'), F.coalesce(F.col("paths"), F.lit("")),
                   F.lit("</svg>"))
    return j.select("image_id", svg.alias("svg"), F.coalesce(F.col("n_runs"), F.lit(0)).cast("bigint").alias("n_runs"))


def quantize(px: DataFrame, bits: Column) -> DataFrame:
    """Keep the top ``bits`` bits of each channel (colour precision of a preset)."""
    shift = F.lit(8) - bits
    step = F.pow(F.lit(2.0), shift)

    def q(c: str) -> Column:
        return (F.floor(F.col(c) / step) * step).cast("int")
    return px.select("image_id", "y", "x", q("r").alias("r"), q("g").alias("g"), q("b").alias("b"), "a")


def rasterize_runs(rn: DataFrame) -> DataFrame:
    """Runs back to foreground pixels ``(image_id, y, x, tone)``."""
    return rn.select("image_id", "y", F.explode(F.sequence("x0", "x1")).alias("x"), "tone")
