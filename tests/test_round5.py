"""Findings of the round: training on flat arrays, samples of many words."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomkit.operators import bpe
from loomkit.operators import tokens as T


@pytest.mark.parametrize("seed", range(60))
def test_flat_arrays_merge_as_lists_do(seed):
    draw = random.Random(seed)
    letters = "abcdef"[:draw.randint(1, 6)]
    words = [[draw.choice(letters) for _ in range(draw.randint(0, 12))] for _ in range(draw.randint(0, 30))]
    counts = [draw.randint(1, 5) for _ in words]
    plain = bpe.PairIndex(words, counts)
    index = bpe.SymbolIndex(pa.array(words, pa.list_(pa.string())), np.array(counts, dtype=np.int64))
    for _ in range(20):
        total = {pair: c for pair, c in plain.total.items() if c}
        assert index.most_frequent(1000) == total
        if not total:
            break
        a, b = draw.choice(sorted(total)) if draw.random() < .9 else (draw.choice(letters), draw.choice(letters))
        assert index.copy().merge_ids(a, b)[0] == total.get((a, b), 0)
        assert index.merge(a, b) == plain.merge(a, b)
        assert index.symbols().to_pylist() == plain.symbols


def _jobs(monkeypatch):
    jobs, verify = [], bpe._verify
    monkeypatch.setattr(bpe, "_verify", lambda *a: jobs.append(1) or verify(*a))
    return jobs


def test_many_rare_words_take_one_job(spark, monkeypatch):
    """Keys and numbers of a large table: every word stands once."""
    jobs = _jobs(monkeypatch)
    hist = spark.range(320_000).select(F.concat(F.lit("p"), (F.col("id") * 7919).cast("string")).alias("word"),
                                       F.lit(1).cast("bigint").alias("n"))
    merges, _ = T.train_bpe(hist, 40, steps=40)
    assert merges.count() == 40 and len(jobs) == 1


def test_a_sample_is_bounded_in_symbols(spark, monkeypatch):
    draw = random.Random(8)
    rows = {"".join(draw.choices("abcd", k=draw.randint(1, 8))): draw.randint(1, 9) for _ in range(80)}
    words = T.initial_words(spark.createDataFrame(sorted(rows.items()), "word string, n bigint"))
    index, whole = bpe._sampled(words, 1000)
    assert whole and len(index.sym) == sum(map(len, rows)) - sum(len(w) == 1 for w in rows)
    want = bpe.train(words, 10, set())[0]
    monkeypatch.setattr(bpe, "SAMPLE_SYMBOLS", 60)
    index, whole = bpe._sampled(words, 1000)
    assert not whole and 0 < len(index.sym) < 120
    assert bpe.train(words, 10, set())[0] == want


def test_special_tokens_are_cut_from_distinct_stretches(spark):
    """The same words and counts as one text after another; a repeated stretch is cut once."""
    texts = ['<svg d="M1 2"/> <path d= fill=x</svg>\u3000<|im_start|>user\nM1 M1', "", None, "stroke=\u00a0cat cat\tcat", "é_ñ ... z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "i int, text string")
    words = df.select(F.explode(T.pretokenize_with_specials(F.col("text"), T.BPE_SPECIALS)).alias("word"))
    want = dict(words.groupBy("word").count().collect())
    hist = T.word_histogram(df, "text", T.BPE_SPECIALS)
    assert dict(hist.collect()) == want and dict(hist.dtypes) == {"word": "string", "n": "bigint"}
    plan = hist._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "im_start" not in plan.split("Aggregate")[-1]
    spaced = T.word_histogram(df, "text", ["cat cat", "<svg"])
    words = df.select(F.explode(T.pretokenize_with_specials(F.col("text"), ["cat cat", "<svg"])).alias("word"))
    assert dict(spaced.collect()) == dict(words.groupBy("word").count().collect())
