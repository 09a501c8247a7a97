"""Structured Streaming versions of the cleaning and chat-text jobs.

Both jobs are stateless projections over ``readStream.text``: the same column
functions as the batch readers, an append sink, and a checkpoint location so a
second run resumes after the files already processed (exactly-once file sink).
Counts ride along with ``observe``; a listener adds them up batch by batch, so the
session's bounded progress history loses none.
"""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from loomkit.functions.chat import chat_text
from loomkit.session import checkpoint_dir
from loomkit.sources.jsonl import kept, read_jsonl

CHAT_SCHEMA = "text string"


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def stage_lines(lines: DataFrame, folder: str, line_col: str = "line") -> None:
    """Land a batch of JSONL lines as text files (one arrival of the stream)."""
    lines.select(F.col(line_col).alias("value")).write.mode("append").text(folder)


def _source(spark: SparkSession, folder: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(F.col("value").alias("line"))


def _counts(df: DataFrame, name: str) -> DataFrame:
    """Rows / kept / rejected per micro-batch, reported in the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.sum(F.when(F.col("reject").isNull(), 1).otherwise(0)).alias("kept"),
                      F.sum(F.when(F.col("reject").isNotNull(), 1).otherwise(0)).alias("rejected"))


def clean_stream(spark: SparkSession, in_folder: str, out_folder: str, chk_folder: str,
                 max_files: int | None = None) -> StreamingQuery:
    """JSONL files arrive -> cleaner policy (X1 then X3) -> whole records as JSONL files, appended."""
    scanned = _counts(read_jsonl(_source(spark, in_folder, max_files), "cleaner"), "clean_counts")
    out = kept(scanned).select(F.col("record").alias("value"))
    return (out.writeStream.format("text").option("path", out_folder)
            .option("checkpointLocation", chk_folder).outputMode("append")
            .trigger(availableNow=True).start())


def chat_stream(spark: SparkSession, in_folder: str, out_folder: str, chk_folder: str,
                max_files: int | None = None) -> StreamingQuery:
    """JSONL files arrive -> trainer policy -> chat text -> JSON files, appended."""
    scanned = _counts(read_jsonl(_source(spark, in_folder, max_files), "trainer"), "chat_counts")
    out = kept(scanned).select(chat_text(F.col("caption"), F.col("svg")).alias("text"))
    return (out.writeStream.format("json").option("path", out_folder)
            .option("checkpointLocation", chk_folder).outputMode("append")
            .trigger(availableNow=True).start())


class CountListener(StreamingQueryListener):
    """Observed counts of every micro-batch, added up as the batches end."""

    def __init__(self, name: str):
        self.name = name
        self.totals = {"rows": 0, "kept": 0, "rejected": 0}
        self.batches = 0
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(self.name)
        if counts is not None:
            self.batches += 1
            for k in self.totals:
                self.totals[k] += int(counts[k] or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Events come in order, so after a query's last one all its batches are counted."""
        if not self._event(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of query {query.runId}")


def run_in_two_arrivals(spark: SparkSession, lines: DataFrame, split_col: str, job, name: str,
                        max_files: int | None = None) -> tuple[str, CountListener]:
    """Stage half of the lines, run to completion, stage the rest, run again (Z3).

    The second run resumes from the checkpoint: files of the first arrival are not
    read again, so the output folder, returned with the counts of both runs, holds every
    kept row exactly once.
    """
    folder = run_folder(spark, name)
    src, out, chk = (os.path.join(folder, p) for p in ("input", "output", "checkpoint"))
    counts = CountListener("chat_counts" if job is chat_stream else "clean_counts")
    spark.streams.addListener(counts)
    try:
        for part in (0, 1):
            stage_lines(lines.where(F.col(split_col) % 2 == part), src)
            q = job(spark, src, out, chk, max_files)
            q.awaitTermination()
            counts.wait(q)
    finally:
        spark.streams.removeListener(counts)
    return out, counts
