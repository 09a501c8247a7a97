"""Sinks: one file per row (K4) and the tokenised training dataset (K5).

K1 / K2 (JSONL) and K3 (vocabulary JSON) live in ``loomkit.sources.jsonl``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_NAME_BYTES = 255     # what file systems take for one name
_DIGEST = 16


def legal_name(name: Column) -> Column:
    """A name without folders, cut to ``MAX_NAME_BYTES`` bytes; a cut one keeps its ending and
    carries a digest of the whole, so different long names stay different."""
    base = F.regexp_replace(F.element_at(F.split(name, "/"), -1), "\\x00", "")
    ending = F.regexp_extract(base, r"(\.[A-Za-z0-9]{1,8})$", 1)
    # a character has at most four bytes
    head = F.substring(base, 1, (MAX_NAME_BYTES - _DIGEST - 10) // 4)
    cut = F.concat(head, F.lit("-"), F.substring(F.sha2(base, 256), 1, _DIGEST), ending)
    return F.when(base.isin("", ".", "..") | base.isNull(), F.lit("_")).when(
        F.octet_length(base) > MAX_NAME_BYTES, cut).otherwise(base)


def file_rows(df: DataFrame, name_col: str = "file_name", content_col: str = "svg",
              key_col: str | None = None) -> DataFrame:
    """``(name, content)``, one row per legal name: the one with the highest ``key_col`` (the last prompt
    of a name), then the greatest content, whatever the order of the rows."""
    order = F.struct(F.col(key_col), F.col(content_col)) if key_col else F.col(content_col)
    rows = df.where(F.col(content_col).isNotNull())
    return rows.groupBy(legal_name(F.col(name_col)).alias("name")).agg(F.max_by(content_col, order).alias("content"))


def write_files(df: DataFrame, folder: str, name_col: str = "file_name", content_col: str = "svg",
                key_col: str | None = None) -> None:
    """K4: each name becomes ``folder/<name>``, written by the executors.

    ``folder`` is a path or URI on storage that all executors reach (file, hdfs, s3, ..). A
    file is written beside its place and moved there, so a task that is run twice leaves
    whole files only.
    """
    def write_partition(rows):
        import uuid

        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        made = False
        for row in rows:
            if not made:
                store.create_dir(root, recursive=True)
                made = True
            part = f"{root}/.{uuid.uuid4().hex}.part"
            with store.open_output_stream(part) as out:
                out.write(row["content"].encode())
            store.move(part, f"{root}/{row['name']}")

    file_rows(df, name_col, content_col, key_col).foreachPartition(write_partition)


def write_tokenised(df: DataFrame, path: str, cols=("input_ids", "attention_mask"),
                    split_col: str = "split") -> None:
    """K5: the tokenised rows, text column removed (P6), one folder per split."""
    keep = [F.col(c) for c in cols if c in df.columns]
    df.select(split_col, *keep).write.mode("overwrite").partitionBy(split_col).parquet(path)
