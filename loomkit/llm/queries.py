"""Registered queries of the training-data operators, with DuckDB SQL where it can say the same.

Every query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomkit.llm import (alignment, captures, decontaminate, licenses, lines, minhash, packing, pages, personal, pieces,
                         quality, search, sharding, warc)
from loomkit.llm.oracle import ORACLE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


@_query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(_table(spark, sf_dir, "pages"))


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(captures.captures(_table(spark, sf_dir, "pages")))
    said = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return resolved.select("record_id", "canonical", "ts", "response_id", "outcome", said.alias("headers"),
                           "digest", "length")


@_query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), wrapped=True).drop("blocks")


@_query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"))


@_query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(_table(spark, sf_dir, "documents"))


@_query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                  tokenizer_path("piece_bpe_32k.model"))


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


ORACLE: dict[str, str] = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
