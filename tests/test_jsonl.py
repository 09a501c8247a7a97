"""Tolerant JSONL scan: the four reader policies on hand-made lines."""

from pyspark.sql import functions as F

from loomkit.sources.jsonl import kept, read_jsonl, read_vocab_json, rejected, vocab_json, write_jsonl

LINES = [
    (1, ""),                                              # blank
    (2, "   \t"),                                         # blank
    (3, '{"caption": "a"'),                               # invalid
    (4, '{"caption": " cat ", "svg": " <svg x=\\"1.256\\"/> ", "source": "s"}'),
    (5, '{"caption": "a", "source": "s"}'),               # no svg key
    (6, '{"caption": "a", "svg": 5}'),                    # svg not a string
    (7, '{"caption": null, "svg": "<g/>"}'),              # caption null
    (8, '{"caption": "  ", "svg": "<g/>"}'),              # caption blank
    (9, '["a", "svg"]'),                                  # list with "svg"
    (10, '["a"]'),                                        # list without
    (11, '"has svg"'),                                    # string containing svg
    (12, '"plain"'),                                      # string without
    (13, "42"),                                           # number
    (14, "null"),
    (15, '{"caption": "b", "svg": "<p d=\\"1e999\\"/>"}'),  # overflow in rounding
]


def scan(spark, policy):
    df = spark.createDataFrame(LINES, "id int, line string")
    return read_jsonl(df, policy)


def test_cleaner_policy(spark):
    s = scan(spark, "cleaner")
    ok = {r.id: r for r in kept(s).collect()}
    assert sorted(ok) == [4, 5, 7, 8, 10, 12]
    assert ok[4].svg == ' <svg x="1.26"/> '
    assert ok[5].svg is None and ok[5].caption == "a"
    bad = {r.id: r.reject for r in rejected(s).collect()}
    assert bad == {3: "invalid_json", 6: "svg_not_string", 9: "svg_index_on_list", 11: "svg_index_on_string",
                   13: "not_a_container", 14: "not_a_container", 15: "number_overflow"}


def test_trainer_policy(spark):
    s = scan(spark, "trainer")
    ok = {r.id: (r.caption, r.svg) for r in kept(s).collect()}
    assert ok == {4: ("cat", '<svg x="1.256"/>'), 15: ("b", '<p d="1e999"/>')}
    bad = dict((r.id, r.reject) for r in rejected(s).collect())
    assert bad[5] == "empty_after_strip" and bad[6] == "svg_not_string"
    assert bad[7] == "caption_not_string" and bad[8] == "empty_after_strip" and bad[9] == "not_an_object"


def test_bpe_and_tokens_policies(spark):
    b = {r.id: (r.caption, r.svg) for r in kept(scan(spark, "bpe")).collect()}
    assert b[5] == ("a", "") and b[6] == ("a", "5") and b[7] == ("None", "<g/>")
    assert 9 not in b and 13 not in b
    t = {r.id: r.svg for r in kept(scan(spark, "tokens")).collect()}
    assert sorted(t) == [4, 6, 7, 8, 15] and t[6] == "5"


def test_jsonl_sink_append_and_vocab_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", "<g/>", "x")], "caption string, svg string, source string")
    out = str(tmp_path / "corpus")
    write_jsonl(df, out)
    write_jsonl(df.withColumn("source", F.lit("y")), out, mode="append")
    back = spark.read.json(out)
    assert sorted(r.source for r in back.collect()) == ["x", "y"]
    vocab = spark.createDataFrame([(1, "ab"), (0, "<unk>"), (2, "c\"d")], "id int, token string")
    text = vocab_json(vocab).first()["value"]
    p = tmp_path / "tokens.json"
    p.write_text(text)
    assert [tuple(r) for r in read_vocab_json(spark, str(p)).orderBy("id").collect()] == [
        (0, "<unk>"), (1, "ab"), (2, 'c"d')]
