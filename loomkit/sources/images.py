"""Image sources (S2, S3, S4, S5): image files -> pixel table.

Spark's ``image`` data source decodes the files on the executors; a broken file
is dropped (``dropInvalid``). Its rows carry the raw bytes in B, G, R(, A)
order; the pixel table is ``(image_id, y, x, r, g, b, a)`` with alpha 255 when
the file has none (mode normalisation: palette and RGBA -> RGBA, the rest RGB).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row per decodable image file; invalid files are skipped."""
    reader = spark.read.format("image").option("dropInvalid", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path)


def image_pixels(images: DataFrame, id_col: str | None = None) -> DataFrame:
    """Image rows -> pixel table. ``image_id`` is ``id_col`` or the file path.

    An image is cut into its pixel rows first, one binary slice each, and a pixel is one
    number read from its place in that row, so no pixel row carries the whole image.
    """
    img = F.col("image")
    key = F.col(id_col) if id_col else img["origin"]
    base = images.select(key.alias("image_id"), img["height"].alias("h"), img["width"].alias("w"),
                         img["nChannels"].alias("c"), img["data"].alias("data"))
    rows = base.select("image_id", "w", "c", "data", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("y"))
    wide = F.col("w") * F.col("c")
    rows = rows.select("image_id", "w", "c", "y", F.hex(F.substring("data", F.col("y") * wide + 1, wide)).alias("row"))
    px = rows.select("image_id", "c", "y", "row", F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("x"))
    digits = F.col("c") * 2
    bits = F.conv(F.substring("row", F.col("x") * digits + 1, digits), 16, 10).cast("bigint")
    px = px.select("image_id", "c", "y", "x", bits.alias("bits"))

    def byte(n: int) -> Column:
        """Byte ``n`` of the pixel; the first stands highest."""
        return F.call_function("shiftright", F.col("bits"), 8 * (F.col("c") - 1 - n)).bitwiseAND(F.lit(255)).cast("int")
    colour = F.col("c") >= 3
    return px.select("image_id", "y", "x", F.when(colour, byte(2)).otherwise(byte(0)).alias("r"),
                     F.when(colour, byte(1)).otherwise(byte(0)).alias("g"), byte(0).alias("b"),
                     F.when(F.col("c") == 4, byte(3)).otherwise(F.lit(255)).alias("a"))


def first_readable(loaders: list[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that can be opened (driver-side choice of a plan;
    each loader returns a DataFrame projected to the same columns)."""
    errors = []
    for load in loaders:
        try:
            df = load()
            df.schema  # forces analysis: a missing path fails here
            return df
        except Exception as exc:  # try the next source
            errors.append(exc)
    raise RuntimeError(f"no readable source: {errors}")
