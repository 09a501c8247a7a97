"""Queries over markup strings: number rounding, attribute order, whitespace."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.functions import markup
from loomkit.plans import duck as D
from loomkit.plans.registry import register
from loomkit.sources import fixtures as FX
from loomkit.sources.tables import table


def svgs(spark, sf):
    return FX.svg_markup(table(spark, sf, "part"))


@register("round_numbers", "WITH " + D.SVGS + f"\nSELECT svg_key AS p_partkey, {D.round_numbers('svg')} AS svg FROM svgs")
def round_numbers_q(spark, sf):
    """X1 (faithful mode, binary rounding) over every part's markup."""
    return svgs(spark, sf).select("p_partkey", markup.round_numbers(F.col("svg")).alias("svg"))


@register("round_decimals", "WITH " + D.SVGS + f"\nSELECT svg_key AS p_partkey, {D.round_decimals('svg', 1)} AS svg FROM svgs")
def round_decimals_q(spark, sf):
    """X2 at one decimal: only ``-?\\d+\\.\\d+`` literals change."""
    return svgs(spark, sf).select("p_partkey", markup.round_decimals(F.col("svg"), 1).alias("svg"))


@register("sort_attributes", "WITH " + D.SVGS + f"\nSELECT svg_key AS p_partkey, {D.sort_attributes('svg')} AS svg FROM svgs")
def sort_attributes_q(spark, sf):
    """Attributes ordered id, d, fill, stroke, transform, viewBox, then by name."""
    return svgs(spark, sf).select("p_partkey", markup.sort_attributes(F.col("svg")).alias("svg"))


_MINIFY_SQL = "WITH " + D.SVGS + f""",
m1 AS (SELECT svg_key, {D.collapse_blanks(D.round_decimals(D.collapse_between_tags('svg'), 2))} AS s FROM svgs)
SELECT svg_key AS p_partkey, {D.sort_attributes('s')} AS svg FROM m1"""


@register("minify_markup", _MINIFY_SQL)
def minify_markup_q(spark, sf):
    """X5 (= X4a, X2, X4b, X3) at precision 2."""
    return svgs(spark, sf).select("p_partkey", markup.minify(F.col("svg"), 2).alias("svg"))


_PAGES_SQL = f"""SELECT page_id, {D.collapse_blanks(D.collapse_between_tags('html'))} AS html FROM pages"""


@register("collapse_markup_space", _PAGES_SQL)
def collapse_markup_space_q(spark, sf):
    """X4 over raw web pages."""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", markup.collapse_markup_space(F.col("html")).alias("html"))
