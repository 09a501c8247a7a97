"""Batch = stream, a resumed stream adds no duplicates, and no batch's counts are lost."""

import os

from pyspark.sql import functions as F

from loomkit.sources.jsonl import kept, read_jsonl
from loomkit.streaming import jobs as Z


def test_stream_equals_batch_and_resumes(spark):
    lines = spark.createDataFrame(
        [(i, f'{{"n": {i}, "caption": "c{i}é", "svg": "<path d=\\"M{i}.456 1\\" fill=\\"#fff\\"/>", "tags": ["s"]}}')
         for i in range(40)] + [(40, ""), (41, "{broken")], "doc_id int, line string")
    out, counts = Z.run_in_two_arrivals(spark, lines, "doc_id", Z.clean_stream, "t")
    batch = kept(read_jsonl(lines, "cleaner")).select("record")
    assert sorted(r[0] for r in spark.read.text(out).collect()) == sorted(r[0] for r in batch.collect())
    assert counts.totals == {"rows": 41, "kept": 40, "rejected": 1}
    # a third run over the same input reads nothing new
    folder = os.path.dirname(out)
    q = Z.clean_stream(spark, os.path.join(folder, "input"), out, os.path.join(folder, "checkpoint"))
    q.awaitTermination()
    back = spark.read.text(out)
    assert back.count() == 40
    assert back.where(F.col("value") == '{"n": 7, "caption": "c7\\u00e9", "svg": '
                      '"<path d=\\"M7.46 1\\" fill=\\"#fff\\"/>", "tags": ["s"]}').count() == 1


def test_counts_outlive_a_short_progress_history(spark):
    lines = spark.createDataFrame([(i, f'{{"svg": "<g x=\\"{i}\\"/>"}}' if i % 4 else "[") for i in range(60)],
                                  "doc_id int, line string").repartition(6)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        _, counts = Z.run_in_two_arrivals(spark, lines, "doc_id", Z.clean_stream, "h", max_files=1)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        else:
            spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert counts.batches > 6
    assert counts.totals == {"rows": 60, "kept": 45, "rejected": 15}
