"""
with the DuckDB SQL that the correctness check runs against the same tables.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables
(or over data that Spark derives from them). Column names match the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: adds a query and, when SQL can express it, its oracle."""
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from loomkit.plans import q_records, q_markup, q_split, q_tokens, q_select, q_pixels, q_stream  # noqa: F401
