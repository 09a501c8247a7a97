"""WARC records and not-modified revisits.

A revisit that says "not modified" is resolved by an as-of join: the latest full response
of the same canonical URL before it.  Its validators must agree with that response's;
then the headers a 304 answer may renew are merged over the stored ones.

The as-of join range-partitions the narrow records by (URL, time), so a URL that holds
much of the archive is spread over tasks; what a task needs from those before it is the
last response of one URL per task, a table with one row per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from loomkit.session import cut_lineage

# Headers that a 304 answer carries for the stored response (RFC 9110, 15.4.5).
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: query parameters that do not name another resource
TRACKING = r"utm_[a-z]+|gclid|fbclid|ref"
RECORD = ("record_id long, url string, ts long, kind string, status int, "
          "headers map<string,string>, digest string, length long")


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, no scheme, no fragment, no
    tracking parameters, parameters in order, no slash at the end.  Null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(head, r":(?:80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~p.rlike(f"^(?:{TRACKING})(?:=|$)")))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.concat(host, path, asked)


def _tag(value: Column) -> Column:
    """Weak comparison of entity tags: the ``W/`` mark does not count."""
    return F.regexp_replace(F.trim(value), r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` (columns RECORD and any others) with its response:
    ``(record_id, canonical, ts, response_id, outcome, headers, digest, length)``.

    ``kind`` is ``response`` (full when its status is 200 and it has a digest) or
    ``revisit``.  Earlier means a smaller ``(ts, record_id)``.  ``outcome``: ``missing``
    without an earlier response, ``mismatch`` when a validator differs, ``unchecked`` when
    both sides share no validator, else ``resolved``.  Validators in order: ETag,
    Last-Modified, payload digest.  A null URL or time is ``missing``; null headers count
    as none; header names compare in lower case (of equal names the first one counts);
    repeated rows give one result row each; an empty table gives an empty result.
    """
    spark = records.sparkSession
    lower = F.map_from_entries(F.coalesce(F.aggregate(
        F.map_entries("headers"),
        F.expr("cast(array() as array<struct<key:string,value:string>>)"),
        lambda acc, e: F.when(F.exists(acc, lambda a: a["key"] == F.lower(e["key"])), acc).otherwise(
            F.concat(acc, F.array(F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))))),
        F.expr("cast(array() as array<struct<key:string,value:string>>)")))
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canonical"),
        F.col("ts").cast("long").alias("ts"), "kind", F.col("status").cast("int").alias("status"),
        lower.alias("headers"), "digest", F.col("length").cast("long").alias("length")) \
        .where(F.col("kind").isin("response", "revisit"))
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("digest").isNotNull() & F.col("ts").isNotNull()
    rows = rows.withColumn("full", F.when(full, F.struct("record_id", "headers", "digest", "length")))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["canonical", "ts", "record_id"]
    placed = cut_lineage(rows.repartitionByRange(n, *order).withColumn("task", F.spark_partition_id()))
    before = W.partitionBy("task", "canonical").orderBy("ts", "record_id").rowsBetween(W.unboundedPreceding, -1)
    here = placed.withColumn("found", F.last("full", ignorenulls=True).over(before))
    # one row per task: the last response of the task's last URL, kept while that URL goes on
    ends = placed.where("canonical IS NOT NULL").groupBy("task").agg(
        F.min("canonical").alias("first_url"), F.max("canonical").alias("last_url"))
    last = placed.where("full IS NOT NULL AND canonical IS NOT NULL").groupBy("task", "canonical").agg(
        F.max_by("full", F.struct("ts", "record_id")).alias("full"))
    tails = ends.join(last, (ends["task"] == last["task"]) & (ends["last_url"] == last["canonical"]), "left").select(
        ends["task"], "first_url", "last_url", "full")
    earlier = W.partitionBy("last_url").orderBy("task")
    tails = tails.withColumn("so_far", F.last("full", ignorenulls=True).over(earlier))
    carried = ends.select("task", "first_url").alias("e").join(
        tails.alias("t"), (F.col("e.first_url") == F.col("t.last_url")) & (F.col("t.task") < F.col("e.task"))) \
        .groupBy(F.col("e.task").alias("at"), F.col("e.first_url").alias("for_url")).agg(
            F.max_by("so_far", F.col("t.task")).alias("carry"))
    joined = here.join(F.broadcast(carried), (F.col("task") == F.col("at")) & (F.col("canonical") == F.col("for_url")),
                       "left")
    out = joined.where(F.col("kind") == "revisit").select(
        "record_id", "canonical", "ts", "headers", "digest",
        F.when(F.col("ts").isNotNull() & F.col("canonical").isNotNull(), F.coalesce("found", "carry")).alias("old"))

    mine, old = F.col("headers"), F.col("old.headers")

    def agree(a: Column, b: Column, rest: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, "resolved").otherwise("mismatch")).otherwise(rest)

    outcome = F.when(F.col("old").isNull(), "missing").otherwise(agree(
        _tag(F.try_element_at(mine, F.lit("etag"))), _tag(F.try_element_at(old, F.lit("etag"))), agree(
            F.try_element_at(mine, F.lit("last-modified")), F.try_element_at(old, F.lit("last-modified")), agree(
                F.col("digest"), F.col("old.digest"), F.lit("unchecked")))))
    renewed = F.map_filter(mine, lambda k, _: k.isin(*RENEWED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(renewed), k)), renewed)
    ok = F.col("outcome").isin("resolved", "unchecked")
    return out.withColumn("outcome", outcome).select(
        "record_id", "canonical", "ts", F.col("old.record_id").alias("response_id"), "outcome",
        F.when(ok, merged).alias("headers"), F.when(ok, F.col("old.digest")).alias("digest"),
        F.when(ok, F.col("old.length")).alias("length"))


def with_payload(resolved: DataFrame, responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Resolved revisits with the stored response's payload column, joined by record id."""
    stored = responses.select(F.col("record_id").alias("__id"), F.col(payload).alias("payload"))
    return resolved.join(stored, F.col("response_id") == F.col("__id"), "left").drop("__id")


_HEAD = re.compile(rb"WARC/\d\.\d\r?\n")


def format_record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC/1.1 record; Content-Length is set from the block."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if k.lower() != "content-length")
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields in lower case, block)`` of each record; a damaged one is skipped to the
    next version line, a cut last one is left out."""
    at = 0
    while (m := _HEAD.search(data, at)) is not None:
        end = data.find(b"\r\n\r\n", m.end())
        if end < 0:
            return
        fields: dict[str, str] = {}
        for line in data[m.end():end].decode("utf-8", "replace").split("\r\n"):
            name, colon, value = line.partition(":")
            if colon:
                fields.setdefault(name.strip().lower(), value.strip())
        size = fields.get("content-length", "")
        if not size.isdigit():
            at = m.end()
            continue
        if end + 4 + int(size) > len(data):
            return
        yield fields, data[end + 4:end + 4 + int(size)]
        at = end + 4 + int(size)


def parse_http(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, headers and body of a stored HTTP answer."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    m = re.match(r"HTTP/\S+ (\d{3})", lines[0])
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            headers.setdefault(name.strip().lower(), value.strip())
    return (int(m[1]) if m else None), headers, body


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records of WARC files, plain or gzip, one file a row of the scan
    (files of an archive are cut to about a GB): RECORD columns and ``payload``."""
    import gzip
    import hashlib
    import zlib
    from datetime import datetime, timezone

    import pyarrow as pa
    names = ["file", "url", "ts", "kind", "status", "headers", "digest", "length", "payload"]
    schema = pa.schema([("file", pa.string()), ("url", pa.string()), ("ts", pa.int64()), ("kind", pa.string()),
                        ("status", pa.int32()), ("headers", pa.map_(pa.string(), pa.string())),
                        ("digest", pa.string()), ("length", pa.int64()), ("payload", pa.binary())])

    def rows(name: str, data: bytes) -> Iterator[dict]:
        if data[:2] == b"\x1f\x8b":
            try:
                data = gzip.decompress(data)
            except (OSError, EOFError, zlib.error):
                return
        for fields, block in parse_records(data):
            kind = fields.get("warc-type")
            if kind not in ("response", "revisit"):
                continue
            status, headers, body = parse_http(block)
            try:
                ts = int(datetime.strptime(fields.get("warc-date", ""), "%Y-%m-%dT%H:%M:%SZ")
                         .replace(tzinfo=timezone.utc).timestamp())
            except ValueError:
                ts = None
            digest = fields.get("warc-payload-digest") or (
                "md5:" + hashlib.md5(body).hexdigest() if kind == "response" else None)
            yield dict(zip(names, (name, fields.get("warc-target-uri"), ts, kind, status, list(headers.items()),
                                   digest, len(body), body)))

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                chunk, size = [], 0
                for row in rows(name, data):
                    chunk.append(row)
                    size += row["length"]
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(chunk, schema=schema)
                        chunk, size = [], 0
                if chunk:
                    yield pa.RecordBatch.from_pylist(chunk, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(run, "file string, url string, ts long, kind string, status int, "
                                  "headers map<string,string>, digest string, length long, payload binary")
    return found.withColumn("record_id", F.xxhash64("file", "url", "ts", "kind", "digest"))
