"""Image conversion: ids of any type, sizes, speckles, scores at the source's size, PNG to JSONL."""

import json

import numpy as np
from pyspark.sql import functions as F

from loomkit.operators import pixels as P
from loomkit.operators import select as S
from loomkit.plans import convert as C
from loomkit.sources.images import image_pixels, read_images
from tests.test_pixels import ssim_model
from tests.test_sources import png


def picture(w=24, h=12):
    a = np.full((h, w, 3), 240)
    a[2:10, 3:11] = 40
    a[3:6, 14:20] = 130
    a[8, 16] = 40                     # a speckle of one pixel
    return a


def pixel_rows(spark, arrs, kind="string"):
    rows = [(i, y, x, *map(int, a[y, x]), 255) for i, a in arrs.items()
            for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, f"image_id {kind}, y int, x int, r int, g int, b int, a int")


def test_string_ids_and_speckles(spark):
    px = pixel_rows(spark, {"a/b 1.png": picture(), "c.png": picture()})
    out = C.convert(px).collect()
    assert sorted(r.image_id for r in out) == ["a/b 1.png", "c.png"]
    for r in out:
        # the ground is cut out, both rectangles are drawn, the one-pixel speckle is not
        assert (r.idx, r.fallback, r.svg.count("<path")) == (0, False, 2)
        assert "M3 2h8v1h-8z" in r.svg and "M14 3h6v1h-6z" in r.svg and "M16 8h1" not in r.svg


def test_presets_that_give_one_raster_share_it(spark):
    images = spark.createDataFrame([(0, 400, 80), (1, 8, 8)], "num long, w int, h int")
    grid = C.preset_grid(images, True).collect()
    small = {r.raster for r in grid if r.num == 1}
    large = {r.raster for r in grid if r.num == 0}
    assert len(small) == len({p[1] for p in S.POSTER_PRESETS})      # sizes are equal, speckle bounds differ
    assert len(large) == len(S.POSTER_PRESETS)                      # every preset has a size of its own
    assert {(r.nw, r.nh) for r in grid if r.num == 0 and r.idx == 0} == {(384, 77)}
    assert len({r.size_key for r in grid if r.num == 1}) == 1


def test_score_is_taken_at_the_size_of_the_source(spark):
    a = picture(24, 12)
    px = pixel_rows(spark, {5: a}, "long")
    grid = spark.createDataFrame([(5, 320, 24, 12, 12, 6)], "num long, raster long, w int, h int, nw int, nh int")
    tone = np.arange(72).reshape(6, 12) % 7 * 30
    runs = spark.createDataFrame([(320, y, int(tone[y, x]), x, x) for y in range(6) for x in range(12) if (x + y) % 5],
                                 "image_id long, y int, tone int, x0 int, x1 int")
    got = C._score(runs, px, grid, 3).collect()[0].score
    drawn = np.zeros((12, 24, 4))
    for y in range(12):
        for x in range(24):
            ty, tx = y // 2, x // 2
            if (tx + ty) % 5:
                drawn[y, x] = [tone[ty, tx]] * 3 + [255]
    source = np.dstack([a, np.full(a.shape[:2], 255)])
    assert abs(got - np.mean([ssim_model(source[:, :, c], drawn[:, :, c]) for c in range(4)])) < 1e-8


def test_colour_presets_and_missing_scores(spark):
    px = pixel_rows(spark, {7: picture()}, "long")
    out = C.convert(px, cutout=False, posterize=None).collect()
    assert len(out) == 1 and 0 < out[0].score <= 1 and out[0].svg.startswith("<svg ")
    plain = C.convert(px, cutout=False, posterize=None, score=False).collect()
    assert plain[0].score == 0.0 and plain[0].idx == 0
    cands = spark.createDataFrame([(1, 0, 10, None, "a"), (1, 1, 9000, 0.9, "b")],
                                  "image_id int, idx int, size long, score double, svg string")
    assert S.choose(cands, 5120).first().score == 0.0


def test_png_files_become_corpus_lines(spark, tmp_path):
    a = picture()
    for name in ("one", "two"):
        png(tmp_path / f"{name}.png", 24, 12, 3, a.ravel().tolist())
    px = image_pixels(read_images(spark, str(tmp_path)))
    ids = px.select("image_id").distinct()
    labels = ids.select("image_id", F.when(F.col("image_id").endswith("one.png"), 3).otherwise(9).alias("label"))
    names = spark.createDataFrame([(3, "a flag")], "label int, name string")
    corpus = C.build_corpus(px, labels, names, "pictures", 10)
    lines = [json.loads(r[0]) for r in C.corpus_lines(corpus).collect()]
    assert sorted((r["caption"], r["source"]) for r in lines) == [("9", "pictures"), ("a flag", "pictures")]
    assert all("M3 2h8v1h-8z" in r["svg"] for r in lines)
