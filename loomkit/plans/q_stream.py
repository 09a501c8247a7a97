"""Streaming queries: batch = stream, checked with the batch readers' SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.operators import records as R
from loomkit.plans import duck as D
from loomkit.plans.q_records import _CLEANER_SQL, record_lines
from loomkit.plans.registry import register
from loomkit.sources.jsonl import kept, read_jsonl
from loomkit.streaming import jobs as Z

_CLEAN_SQL = "SELECT record FROM (" + _CLEANER_SQL + ")"


@register("stream_clean", _CLEAN_SQL)
def stream_clean(spark, sf):
    """Z1 + Z3: the cleaner as a stream over two arrivals; its lines equal the batch records."""
    out, _ = Z.run_in_two_arrivals(spark, record_lines(spark, sf), "doc_id", Z.clean_stream, "clean")
    return spark.read.text(out).select(F.col("value").alias("record"))


_CHAT_SQL = "WITH " + D.TRAINER + f"\nSELECT {D.chat_text('caption', 'svg')} AS text FROM trainer"


@register("stream_chat_text", _CHAT_SQL)
def stream_chat_text(spark, sf):
    """Z2 + Z3: chat text as a stream over two arrivals; equals the batch rows."""
    out, _ = Z.run_in_two_arrivals(spark, record_lines(spark, sf), "doc_id", Z.chat_stream, "chat")
    return spark.read.schema(Z.CHAT_SCHEMA).json(out)


_COUNTS_SQL = "WITH " + D.LINES + ",\n" + D.parsed_cte() + f""",
r1 AS (SELECT *, CASE WHEN kind = 'object' AND svg_type <> 'missing' THEN {D.round_numbers('j_svg')} END AS svg1 FROM parsed),
k AS (SELECT CASE WHEN valid AND kind IN ('object', 'array', 'string')
  AND NOT (kind = 'object' AND svg_type <> 'missing' AND (svg_type <> 'string' OR svg1 IS NULL)) THEN 1 ELSE 0 END AS ok FROM r1)
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(ok) AS BIGINT) AS kept, CAST(count(*) - sum(ok) AS BIGINT) AS rejected FROM k"""


@register("stream_counts", _COUNTS_SQL)
def stream_counts(spark, sf):
    """Kept / rejected counts of the running stream (both arrivals), added up by the listener."""
    _, counts = Z.run_in_two_arrivals(spark, record_lines(spark, sf), "doc_id", Z.clean_stream, "counts")
    t = counts.totals
    return spark.createDataFrame([(t["rows"], t["kept"], t["rejected"])], "rows bigint, kept bigint, rejected bigint")


@register("batch_counts", _COUNTS_SQL)
def batch_counts(spark, sf):
    """K6: the same counts observed on a batch run of the cleaner, beside its own output."""
    scanned, seen = R.observe_counts(read_jsonl(record_lines(spark, sf), "cleaner"), "cleaner")
    kept(scanned).write.format("noop").mode("overwrite").save()
    t = seen.get
    return spark.createDataFrame([(t["rows"], t["kept"], t["rejected"])], "rows bigint, kept bigint, rejected bigint")
