"""Image -> markup conversion over pixel tables (I11) and the corpus build.

Per image: optional cut-out (I3), the reference raster (gray when posterising), and the
preset grid (J2, I12). Presets differ only in part: those that give an image the same
size, blur, colours and speckle bound share one raster, which is made, traced and scored
once. A raster is shrunk (I6), blurred (I7, colour presets), posterised (I5) or
quantised, and traced into runs without speckles (I9). Each preset's markup is minified at
its precision (X5) and sized (X6). The score (I8) compares the runs, drawn at the size
of the source image, with the reference (I10; I13 gives 0.0 when scoring is off). The choice is
W1 + A3 + W2 under ``int(target_kb * 1024)`` bytes.

Presets run in waves: the first ``first_wave`` presets for every image, the rest
only for images whose walk has not stopped yet (``left_anti``). Later presets of
a stopped image are never considered, so the waves save work and change nothing.

Image ids may be of any type; inside they go by a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.functions import markup
from loomkit.operators import pixels as P
from loomkit.operators import records as R
from loomkit.operators import select as S
from loomkit.session import cut_lineage
from loomkit.sources.jsonl import to_jsonl

KEY_SPAN = 64          # raster key = image number * 64 + the first preset that has it (idx < 16)
DEFAULT_TARGET_KB = 5.0
DEFAULT_LEVELS = 3
SHAPE = ("nw", "nh", "blur", "color_precision", "filter_speckle")


def preset_grid(images: DataFrame, posterize: bool) -> DataFrame:
    """``images(num, w, h)`` x presets with the size each gives and ``size_key`` / ``raster``, the keys
    of the shrunk and of the traced raster that it shares with other presets."""
    grid = S.with_presets(images, posterize=posterize)
    nw, nh = markup.scaled_size(F.col("w"), F.col("h"), F.col("max_dim"))
    grid = grid.withColumn("nw", nw).withColumn("nh", nh)
    # presets of one image: a window over at most 16 rows
    first = lambda *by: F.min("idx").over(Window.partitionBy("num", *by))
    return grid.withColumn("size_key", F.col("num") * KEY_SPAN + first("nw", "nh")) \
        .withColumn("raster", F.col("num") * KEY_SPAN + first(*SHAPE))


def _rasters(base: DataFrame, grid: DataFrame, posterize: int | None) -> DataFrame:
    """Toned pixels ``(image_id = raster, y, x, r, g, b, a, filter_speckle)`` of every raster in ``grid``."""
    sizes = grid.select(F.col("num").alias("image_id"), "w", "h", "nw", "nh", "size_key").distinct()
    small = P.resample_to(base, sizes, "size_key").withColumnRenamed("image_id", "size_key")
    shapes = grid.select("size_key", F.col("raster").alias("image_id"), "blur", "color_precision",
                         "filter_speckle").distinct()
    px = cut_lineage(small.join(R.small_side(shapes), "size_key").drop("size_key"))
    sigmas = [b for (b,) in shapes.select("blur").distinct().collect() if b and b > 0]
    if sigmas:
        pixels = px.count()
        parts = [px.where(F.col("blur") == 0)]
        for sigma in sigmas:
            own = px.where(F.col("blur") == sigma)
            soft = P.blur(own, sigma, pixels=pixels)
            parts.append(own.drop("r", "g", "b").join(soft, ["image_id", "y", "x"]).select(
                "image_id", "y", "x", *[F.floor(F.col(c) + 0.5).cast("int").alias(c) for c in "rgb"], "a",
                "blur", "color_precision", "filter_speckle"))
        px = R.union_corpora(*parts)
    speckle = shapes.select("image_id", "filter_speckle")
    toned = (P.posterize_kmeans(px, posterize) if posterize
             else P.quantize(px, F.col("color_precision")))
    return toned.join(R.small_side(speckle), "image_id")


def _traced(toned: DataFrame, posterize: int | None) -> tuple[DataFrame, DataFrame]:
    """``(runs, markup)`` of every raster."""
    tone = F.col("r") if posterize else P.rgb_tone(F.col("r"), F.col("g"), F.col("b"))
    runs = cut_lineage(P.speckled_runs(toned.withColumn("_tone", tone), "_tone", "filter_speckle"))
    return runs, P.runs_markup(runs, P.image_dims(toned), rgb=not posterize)


def _minified(traced: DataFrame) -> DataFrame:
    """X5 per preset at its path precision: one projection per precision value (at most
    four), unioned, so each row runs one rewrite."""
    precisions = sorted(int(p) for (p,) in traced.select("path_precision").distinct().collect())
    parts = [traced.where(F.col("path_precision") == p).withColumn("svg", markup.minify(F.col("svg"), p))
             for p in precisions]
    return R.union_corpora(*parts) if parts else traced


def drawn(runs: DataFrame, reference: DataFrame, grid: DataFrame, posterize: int | None) -> DataFrame:
    """The runs of each raster at the size of its source image, ``(raster, num, y, x)`` with the
    reference channels ``r g b a`` and the drawn ones ``dr dg db da`` (nothing drawn: all zero)."""
    sizes = grid.select("raster", F.col("num").alias("image_id"), "w", "h", "nw", "nh").distinct()
    px = reference.join(R.small_side(sizes), "image_id").select(
        "raster", F.col("image_id").alias("num"), "y", "x", "r", "g", "b", "a",
        F.floor(F.col("y") * F.col("nh") / F.col("h")).cast("int").alias("ty"),
        F.floor(F.col("x") * F.col("nw") / F.col("w")).cast("int").alias("tx"))
    cells = P.rasterize_runs(runs).select(F.col("image_id").alias("raster"), F.col("y").alias("ty"),
                                          F.col("x").alias("tx"), "tone")
    t = F.col("tone")
    bands = [t, t, t] if posterize else [F.shiftright(t, 16), F.shiftright(t, 8) % 256, t % 256]
    pixels = sizes.agg(F.sum(F.col("w").cast("long") * F.col("h"))).first()[0]
    at = ["raster", "ty", "tx"]
    out = P.spread(px, pixels, *at).join(P.spread(cells, pixels, *at), at, "left")
    return out.select("raster", "num", "y", "x", "r", "g", "b", "a",
                      *[F.coalesce(v, F.lit(0)).cast("int").alias(f"d{c}") for v, c in zip(bands, "rgb")],
                      F.when(t.isNull(), 0).otherwise(255).alias("da"))


def _score(runs: DataFrame, reference: DataFrame, grid: DataFrame, posterize: int | None) -> DataFrame:
    """``(raster, score)``: SSIM over r, g, b and alpha at the size of the source image. Rounded, so
    that rasters drawn alike tie exactly; ties then go to the lower preset."""
    both = cut_lineage(drawn(runs, reference, grid, posterize)).withColumnRenamed("raster", "image_id")
    pixels = both.count()
    drawn_px = both.select("image_id", "y", "x", *[F.col(f"d{c}").alias(c) for c in "rgba"])
    out = P.ssim(both, drawn_px, chans=("r", "g", "b", "a"), pixels=pixels)
    return out.select(F.col("image_id").alias("raster"), F.round("ssim", 9).alias("score"))


def convert(px: DataFrame, target_kb: float = DEFAULT_TARGET_KB, cutout: bool = True,
            posterize: int | None = DEFAULT_LEVELS, min_candidates: int = S.MIN_CANDIDATES,
            score: bool = True, first_wave: int = 4) -> DataFrame:
    """The chosen markup per image: ``(image_id, idx, size, score, fallback, svg)``."""
    budget = S.target_bytes(target_kb)
    numbers = cut_lineage(P.image_dims(px).withColumn("num", F.monotonically_increasing_id()))
    named = px.join(R.small_side(numbers.select("image_id", "num")), "image_id").drop("image_id") \
        .withColumnRenamed("num", "image_id")
    base = cut_lineage(P.cutout(named) if cutout else named)
    reference = P.luma(base) if posterize else base
    grid = cut_lineage(preset_grid(numbers.select("num", "w", "h"), bool(posterize)))

    def rasters(part: DataFrame) -> DataFrame:
        """``(raster, svg, score)`` of the rasters in ``part`` of the grid."""
        toned = cut_lineage(_rasters(base, part, posterize))
        runs, traced = _traced(toned, posterize)
        out = traced.select(F.col("image_id").alias("raster"), "svg")
        if score:
            return cut_lineage(out.join(_score(runs, reference, part, posterize), "raster", "left"))
        return cut_lineage(out.withColumn("score", F.lit(0.0)))

    def candidates(part: DataFrame, made: DataFrame) -> DataFrame:
        c = _minified(part.select("num", "idx", "raster", "path_precision").join(made, "raster"))
        return cut_lineage(c.select(F.col("num").alias("image_id"), "idx",
                                    markup.byte_size(F.col("svg")).alias("size"), "score", "svg"))

    early = grid.where(F.col("idx") < first_wave)
    made = rasters(early)
    cands = candidates(early, made)
    walked = S.mark_walk(cands.select("image_id", "idx", "size"), budget, min_candidates)
    stopped = walked.where(F.col("considered") & F.col("stop")).select(F.col("image_id").alias("num")).distinct()
    late = cut_lineage(grid.where(F.col("idx") >= first_wave).join(stopped, "num", "left_anti"))
    if not late.isEmpty():
        fresh = late.join(made.select("raster"), "raster", "left_anti")
        if not fresh.isEmpty():
            made = made.unionByName(rasters(fresh))
        cands = cands.unionByName(candidates(late, made))
    chosen = S.choose(cands, budget, min_candidates).withColumnRenamed("image_id", "num")
    rest = [c for c in chosen.columns if c != "num"]
    return chosen.join(R.small_side(numbers.select("image_id", "num")), "num").select("image_id", *rest)


def build_corpus(px: DataFrame, labels: DataFrame, class_names: DataFrame, source_name: str,
                 target_count: int, require_svg: bool = True, **convert_args) -> DataFrame:
    """Convert -> caption (P1) -> F5 / F6 -> ``{caption, svg, source}`` (P2) ->
    the first ``target_count`` surviving rows by image id (L3)."""
    chosen = convert(px, **convert_args)
    rows = R.resolve_caption(chosen.join(labels, "image_id"), class_names)
    rows = rows.where(R.corpus_filter(F.col("svg"), require_svg))
    rows = R.first_surviving(rows, target_count, ["image_id"])
    return rows.select("image_id", "caption", "svg", F.lit(source_name).alias("source"))


def corpus_lines(corpus: DataFrame) -> DataFrame:
    """K1: the corpus as JSONL lines."""
    return to_jsonl(corpus)
