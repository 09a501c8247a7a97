"""Inputs derived from the driver tables with Spark (FIXTURES.md, part C).

Every derivation is a narrow projection or a join on an even key over whole tables and
whole texts, so the derived inputs scale with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.operators.records import BROADCAST_LIMIT

# Fixed values of the derived fixtures (FIXTURES.md C).
CUT_AT = 20                  # damaged line: cut after 20 characters
DAMAGE_ORDER = ((11, "blank"), (13, "cut"), (17, "caption_null"), (19, "no_svg"), (23, "numeric_svg"))
CANDIDATE_BUDGET = 5120      # 5 KB byte budget of the candidate fixture
TILE_SIDE = 8                # an embedding of 64 values seen as an 8x8 tile
LABEL_SHIFT = 20             # labelled rows: label + 20 joined to nation keys
MARKUP_BYTES = 256           # a markup string with its key as a row in memory

_NO_NULL_DROP = {"ignoreNullFields": "false"}


def svg_markup(part: DataFrame) -> DataFrame:
    """``(p_partkey, svg)``: one R2 markup string per part row."""
    price = F.col("p_retailprice").cast("decimal(12,4)").cast("string")
    size = F.col("p_size").cast("string")
    svg = F.concat(
        F.lit('<svg width="'), size, F.lit('" id="p'), F.col("p_partkey").cast("string"),
        F.lit('" viewBox="0 0 '), size, F.lit(" "), size,
        F.lit('"><path fill="#1e5f5f" d="M'), price,
        F.lit('-0.001 2.675"  stroke="#000000"/></svg>'))
    return part.select("p_partkey", svg.alias("svg"))


def with_markup(docs: DataFrame, part: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``docs`` with the markup of part ``doc_id % count(part)``; every part row is used and no key is hot.

    The markup is built from columns a tenth its size, compressed on disk, so its bytes are told from the
    number of parts. Up to ``limit`` it is broadcast; beyond, both sides shuffle on the key.
    """
    n_parts = max(part.count(), 1)
    svgs = svg_markup(part).withColumnRenamed("p_partkey", "svg_key")
    side = F.broadcast(svgs) if n_parts * MARKUP_BYTES <= limit else svgs.hint("merge")
    return docs.withColumn("svg_key", F.col("doc_id") % n_parts).join(side, "svg_key", "left")


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), _NO_NULL_DROP)


def record_lines(documents: DataFrame, part: DataFrame) -> DataFrame:
    """``(doc_id, line)``: corpus JSONL lines (R1) with the damaged-line rules applied.

    The caption is the whole document text, the markup a part's (``with_markup``).
    """
    joined = with_markup(documents.select("doc_id", F.col("text").alias("caption"), "source"), part)
    caption, svg, source = F.col("caption"), F.col("svg"), F.col("source")
    full = _json(caption.alias("caption"), svg.alias("svg"), source.alias("source"))
    d = F.col("doc_id")
    line = (F.when(d % 11 == 0, F.lit(""))
            .when(d % 13 == 0, F.substring(full, 1, CUT_AT))
            .when(d % 17 == 0, _json(F.lit(None).cast("string").alias("caption"), svg.alias("svg"),
                                     source.alias("source")))
            .when(d % 19 == 0, _json(caption.alias("caption"), source.alias("source")))
            .when(d % 23 == 0, _json(caption.alias("caption"), d.alias("svg"), source.alias("source")))
            .otherwise(full))
    return joined.select("doc_id", line.alias("line"))


def odd_lines(documents: DataFrame, part: DataFrame) -> DataFrame:
    """``(doc_id, line)``: records in nine forms by ``doc_id % 9`` that only a reader of whole
    lines gets right (FIXTURES.md C)."""
    joined = with_markup(documents.select("doc_id", "text"), part)

    def said(c: str) -> Column:
        raw = _json(F.col(c).alias("v"))
        return F.substring(raw, F.lit(6), F.length(raw) - 6)
    text, svg, d = said("text"), said("svg"), F.col("doc_id").cast("string")
    forms = [F.concat(F.lit('{"id":'), d, F.lit(', "svg" :'), svg, F.lit(',"tags":["a","svg"],"caption":'), text, F.lit("}")),
             F.concat(F.lit(" ["), text, F.lit(', ["s\\u0076g"] ,1.50 ]')),
             F.concat(F.lit('[1, "s\\u0076g", '), text, F.lit("]")),
             text,
             F.concat(F.lit('{"nested":{"svg":"1.256","n":1e5},"s\\u0076g":'), svg, F.lit(',"m":NaN}')),
             d,
             F.concat(F.lit('{"caption":'), text, F.lit(',"svg":'), svg, F.lit(",}")),
             F.concat(F.lit('{"caption":{"a":[1,2,null]},\t"svg":'), svg, F.lit(',"source":null }')),
             F.concat(F.lit('{ "caption" : '), text, F.lit(' , "svg" : '), svg, F.lit(' , "source" : "\\u0073" }'))]
    line = F.element_at(F.array(*forms), (F.col("doc_id") % 9 + 1).cast("int"))
    return joined.select("doc_id", line.alias("line"))


def candidates(lineitem: DataFrame) -> DataFrame:
    """``(image_id, idx, size, score, svg)`` from ``lineitem``.

    ``idx`` is the 0-based rank of (l_linenumber, l_partkey, l_suppkey,
    l_extendedprice) inside an order. The window partitions by order key; an
    order has a bounded number of lines, like an image has a bounded preset grid.
    """
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_extendedprice")
    return lineitem.select(
        F.col("l_orderkey").alias("image_id"),
        (F.row_number().over(w) - 1).cast("int").alias("idx"),
        F.floor(F.col("l_extendedprice") / 10).cast("bigint").alias("size"),
        F.col("l_discount").alias("score"),
        F.concat(F.lit('<svg id="'), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string"), F.lit('"/>')).alias("svg"))


def tiles(embeddings: DataFrame) -> DataFrame:
    """Pixel table ``(image_id, y, x, r, g, b, a)`` of 8x8 tiles.

    ``g`` = clamp(floor((e + 0.5) * 255), 0, 255); r, g and b read the vector
    shifted by 0, 1 and 2 places (wrapping); alpha is 255.
    """
    n = TILE_SIDE * TILE_SIDE

    def level(v: Column) -> Column:
        return F.least(F.greatest(F.floor((v.cast("double") + 0.5) * 255), F.lit(0)), F.lit(255)).cast("int")

    e = F.col("embedding")
    px = embeddings.select(F.col("vec_id").alias("image_id"), e.alias("e"),
                           F.posexplode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i", "_p"))
    i = F.col("i")
    return px.select(
        "image_id",
        F.floor(i / TILE_SIDE).cast("int").alias("y"),
        (i % TILE_SIDE).cast("int").alias("x"),
        level(F.element_at("e", i + 1)).alias("r"),
        level(F.element_at("e", (i + 1) % n + 1)).alias("g"),
        level(F.element_at("e", (i + 2) % n + 1)).alias("b"),
        F.lit(255).alias("a"))


def mosaics(embeddings: DataFrame) -> DataFrame:
    """Pixel table of images ``mosaic/<n>.png``, 400 x 80: 50 x 10 tiles by ``vec_id``, each value of
    a tile in eight-fold contrast (the last image may be lower)."""
    wide, per = 50, 500
    nth = F.col("vec_id") % per
    px = embeddings.select(
        F.concat(F.lit("mosaic/"), F.floor(F.col("vec_id") / per).cast("string"), F.lit(".png")).alias("image_id"),
        (F.floor(nth / wide) * TILE_SIDE).cast("int").alias("top"), (nth % wide * TILE_SIDE).cast("int").alias("left"),
        F.posexplode("embedding").alias("i", "e"))
    level = F.least(F.greatest(F.floor((F.col("e").cast("double") * 8 + 0.5) * 255), F.lit(0)), F.lit(255)).cast("int")
    return px.select("image_id", (F.col("top") + F.floor(F.col("i") / TILE_SIDE)).cast("int").alias("y"),
                     (F.col("left") + F.col("i") % TILE_SIDE).cast("int").alias("x"),
                     level.alias("r"), (F.lit(255) - level).alias("g"), (level % 128).alias("b"), F.lit(255).alias("a"))


def completions(documents: DataFrame) -> DataFrame:
    """``(doc_id, prompt, response)`` model-output shapes (R9), chosen by ``doc_id % 5``."""
    prompt = F.col("text")
    body = F.concat(F.lit('<svg viewBox="0 0 8 8"><path d="M'), F.col("n_chars").cast("string"),
                    F.lit(' 1"/>'))
    k = F.col("doc_id") % 5
    response = (F.when(k == 0, F.concat(body, F.lit("</svg>")))
                .when(k == 1, F.concat(F.lit("```svg\n"), body, F.lit("</svg>\n```")))
                .when(k == 2, F.concat(F.lit("Here you go: "), body, F.lit("</svg>")))
                .when(k == 3, body)
                .otherwise(F.concat(body, F.lit("</svg></svg>"))))
    return documents.select("doc_id", prompt.alias("prompt"), response.alias("response"))


def labelled_rows(embeddings: DataFrame) -> DataFrame:
    """``(image_id, label)``: integer labels, shifted so that some miss the class table."""
    return embeddings.select(F.col("vec_id").alias("image_id"),
                             (F.col("label") + LABEL_SHIFT).alias("label"))


def class_names(nation: DataFrame) -> DataFrame:
    """``(label, name)`` class table (R11) from ``nation``."""
    return nation.select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name"))
