"""A capture log derived from ``pages``, for the revisit query: one full response per page
and one not-modified answer per page, under another spelling of the URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """Records of ``loomkit.llm.warc.RECORD``; page_id decides times and validators."""
    i = F.col("page_id")
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    stamp = F.concat(F.lit("t"), (i % 97).cast("string"))
    head = lambda *pairs: F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs]),
        lambda e: e["value"].isNotNull()))
    response = pages.select(
        (2 * i).alias("record_id"), "url", (i * 60).alias("ts"), F.lit("response").alias("kind"),
        F.when(i % 11 == 0, 404).otherwise(200).alias("status"),
        head(("ETag", F.when(i % 5 != 0, F.concat(F.lit('"'), digest, F.lit('"')))),
             ("Last-Modified", stamp), ("Content-Type", F.lit("text/html")), ("Date", i)).alias("headers"),
        digest.alias("digest"), F.length(F.coalesce("html", F.lit(""))).cast("long").alias("length"))
    again = F.when(i % 2 == 0, F.concat(F.col("url"), F.lit("#again"))).otherwise(F.col("url"))
    revisit = pages.select(
        (2 * i + 1).alias("record_id"), again.alias("url"),
        (i * 60 + F.when(i % 13 == 0, -DAY).otherwise(DAY)).alias("ts"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        head(("ETag", F.when(i % 7 == 0, F.lit('"stale"')).when(i % 3 != 0, F.concat(F.lit('W/"'), digest, F.lit('"')))),
             ("Last-Modified", F.when(i % 4 != 0, stamp)), ("Date", i + 1), ("Content-Length", F.lit("0")),
             ("Expires", F.lit("never"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("length"))
    return response.unionByName(revisit)
