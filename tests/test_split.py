"""Exact split, heads, batches, truncation and padding."""

from pyspark.sql import functions as F

from loomkit.operators import split as SP


def test_split_sizes_disjoint_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s = SP.split_exact(df, "k").cache()
    counts = dict((r.split, r["count"]) for r in s.groupBy("split").count().collect())
    assert counts == {"train": 950, "test": 50}
    assert s.select("k").distinct().count() == 1000
    test = s.where("split = 'test'")
    assert test.join(s.where("split = 'train'"), "k", "left_semi").count() == 0
    assert sorted(r.pos for r in test.collect()) == list(range(1, 51))
    heads = SP.split_head(s, {"train": 100, "test": 10})
    assert dict((r.split, r["count"]) for r in heads.groupBy("split").count().collect()) == {"train": 100, "test": 10}


def test_global_rank_is_exact(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.col("id").alias("k"))
    r = SP.global_rank(df, ["v", "k"], "rank", partitions=7)
    got = [(x.v, x.k) for x in r.orderBy("rank").collect()]
    assert got == sorted((x.v, x.k) for x in df.collect())
    assert [x["rank"] for x in r.orderBy("rank").collect()] == list(range(1, 5001))


def test_truncate_and_pad(spark):
    df = spark.createDataFrame([("train", 1, 0, [5, 6, 7]), ("train", 2, 0, [8]), ("train", 3, 1, [1, 2, 3, 4, 5])],
                               "split string, pos long, batch_id long, input_ids array<int>")
    cut, flag = SP.truncate(F.col("input_ids"), 4)
    t = [tuple(r) for r in df.select(cut, flag).collect()]
    assert t == [([5, 6, 7], False), ([8], False), ([1, 2, 3, 4], True)]
    p = {r.pos: r for r in SP.pad_batches(df).collect()}
    assert p[2].input_ids_padded == [8, 0, 0] and p[2].attention_mask == [1, 0, 0]
    assert p[2].labels == [8, -100, -100] and p[1].labels == [5, 6, 7]
    for r in p.values():  # padding never changes real ids
        assert r.input_ids_padded[:len(r.input_ids)] == r.input_ids


def test_batch_plan(spark):
    df = spark.createDataFrame([(95,)], "n long")
    out = {r.mode: r for r in df.select(F.explode(F.array(*SP.batch_plan(F.col("n")))).alias("m")).select("m.*").collect()}
    assert out["colab_fast"].total_steps == 18 and out["colab_fast"].configured_max_steps == 200
    assert out["local"].steps_per_epoch == 12


def test_write_tokenised(spark, tmp_path):
    from loomkit.sources.sinks import write_tokenised
    df = spark.createDataFrame([("train", "t1", [1, 2], [1, 1]), ("test", "t2", [3], [1])],
                               "split string, text string, input_ids array<int>, attention_mask array<int>")
    out = str(tmp_path / "tok")
    write_tokenised(df, out)
    back = spark.read.parquet(out)
    assert "text" not in back.columns and sorted(r.split for r in back.collect()) == ["test", "train"]
