"""Image files (tiny PNGs written with zlib), file sink and source fallback."""

import os
import struct
import zlib

from pyspark.sql import functions as F

from loomkit.sources.images import first_readable, image_pixels, read_images
from loomkit.sources.sinks import write_files


def png(path, w, h, channels, pixels):
    def chunk(kind, data):
        c = struct.pack(">I", len(data)) + kind + data
        return c + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)
    color = {3: 2, 4: 6}[channels]
    raw = b"".join(b"\x00" + bytes(pixels[y * w * channels:(y + 1) * w * channels]) for y in range(h))
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    with open(path, "wb") as fh:
        fh.write(data)


def test_image_source_to_pixels(spark, tmp_path):
    rgb = [10, 20, 30] * 8
    rgb[3:6] = [200, 100, 50]
    png(tmp_path / "a.png", 4, 2, 3, rgb)
    png(tmp_path / "b.png", 2, 2, 4, [1, 2, 3, 0, 4, 5, 6, 255] * 2)
    (tmp_path / "c.png").write_bytes(b"not an image")
    imgs = read_images(spark, str(tmp_path))
    assert imgs.count() == 2
    px = image_pixels(imgs)
    a = {(r.y, r.x): (r.r, r.g, r.b, r.a) for r in px.where(F.col("image_id").endswith("a.png")).collect()}
    assert a[(0, 0)] == (10, 20, 30, 255) and a[(0, 1)] == (200, 100, 50, 255) and len(a) == 8
    b = {(r.y, r.x): (r.r, r.g, r.b, r.a) for r in px.where(F.col("image_id").endswith("b.png")).collect()}
    assert b[(0, 0)] == (1, 2, 3, 0) and b[(1, 1)] == (4, 5, 6, 255)


def test_first_readable(spark, tmp_path):
    good = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(good)
    df = first_readable([lambda: spark.read.parquet(str(tmp_path / "missing")), lambda: spark.read.parquet(good)])
    assert df.count() == 3


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([("a_cat.svg", "<svg/>"), ("b.svg", "<svg>x</svg>")], "file_name string, svg string")
    write_files(df, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["a_cat.svg", "b.svg"]
    assert (tmp_path / "out" / "b.svg").read_text() == "<svg>x</svg>"


def test_write_files_to_a_uri_with_long_and_repeated_names(spark, tmp_path):
    long = "a red cat " * 40
    rows = [(1, long + "1.svg", "<svg>1</svg>"), (2, long + "2.svg", "<svg>2</svg>"), (3, "é" * 200 + ".svg", "é"),
            (1, "same.svg", "old"), (9, "same.svg", "new"), (5, "same.svg", "mid"), (4, "x/../up.svg", "u"),
            (6, "..", "dots"), (7, "none.svg", None)]
    for turn in (1, 4):
        df = spark.createDataFrame(rows, "k int, file_name string, svg string").repartition(turn)
        folder = tmp_path / f"out {turn}"
        write_files(df, folder.as_uri(), key_col="k")
        names = sorted(os.listdir(folder))
        assert len(names) == 6 and all(len(n.encode()) <= 255 for n in names)
        assert {(folder / n).read_text() for n in names} == {"<svg>1</svg>", "<svg>2</svg>", "é", "new", "u", "dots"}
        assert (folder / "same.svg").read_text() == "new" and (folder / "up.svg").read_text() == "u"


def test_gray_images_and_wide_rows(spark, tmp_path):
    w, h = 300, 3
    png(tmp_path / "w.png", w, h, 3, [(7 * i) % 256 for i in range(w * h * 3)])
    px = image_pixels(read_images(spark, str(tmp_path)))
    got = {(r.y, r.x): (r.r, r.g, r.b, r.a) for r in px.collect()}
    assert got == {(y, x): tuple((7 * (3 * (y * w + x) + k)) % 256 for k in range(3)) + (255,)
                   for y in range(h) for x in range(w)}
