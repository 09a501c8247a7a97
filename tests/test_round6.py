"""Findings of the round: texts are not walked to be stripped, and markup of many parts is not broadcast."""

from pyspark.sql import functions as F

from loomkit.functions import json_text as J
from loomkit.functions.text import PY_SPACES, py_strip
from loomkit.sources import fixtures as FX


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_with_escapes_are_found_by_bytes(spark):
    keys = ["svg", "é", "\U0001f600"]
    escaped = ["\\u0073\\u0076\\u0067", "\\u00e9", "\\ud83d\\ude00"]
    for key, said in zip(keys, escaped):
        for name in (key, said):
            df = spark.createDataFrame([(f'{{"x":"y","{name}":"z"}}',)], "line string")
            at = J.members(J.strings(F.col("line")), J.pieces(F.col("line")), F.lit("object"), keys)
            assert df.select(at.alias("m")).first().m[key] == 3


def test_strip_trims_the_right_end_only_where_there_is_space(spark):
    texts = ["", "a", " a", "a ", "　a　", "é\u0085", " ", "a​", "a à", " x y ", None]
    texts += [f"{c}a{c}b{c}" for c in PY_SPACES]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", py_strip(F.col("t")).alias("s"))
    for r in out.collect():
        assert r.s == (None if r.t is None else r.t.strip())
    assert "endswith" in _plan(out).lower()


def test_markup_of_many_parts_is_not_broadcast(spark):
    part = spark.range(300_000).select(F.col("id").alias("p_partkey"), F.lit(3).alias("p_size"), F.lit(1.5).alias("p_retailprice"))
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.lit("web").alias("source"))
    few = part.where("p_partkey < 1000")
    for lines in (FX.record_lines, FX.odd_lines):
        assert "SortMergeJoin" in lines(docs, part)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in lines(docs, few)._jdf.queryExecution().executedPlan().toString()


def test_markup_is_the_same_by_either_join(spark):
    part = spark.createDataFrame([(0, 1, 1.5), (1, 2, 2.5), (1, 3, 3.5), (None, 4, 4.5), (3, None, None)],
                                 "p_partkey long, p_size int, p_retailprice double")
    docs = spark.createDataFrame([(0,), (1,), (4,), (6,), (8,), (8,), (None,)], "doc_id long")
    a, b = (sorted(map(str, FX.with_markup(docs, part, limit).collect())) for limit in (0, 1 << 20))
    assert a == b and len(a) == 9
