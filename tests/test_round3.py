"""What the third round's findings changed: strips of many layers at once, proposals put right by
their log, bounded slices of a batch, special tokens in one pass, stripping by characters, rejects."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomkit.functions.text import PY_SPACE, is_blank, py_strip
from loomkit.operators import bpe, pixels as P, regions
from loomkit.operators import tokens as T
from loomkit.sources.jsonl import kept, read_jsonl, reject_reasons


@pytest.mark.parametrize("at_once", [1, 7, 10_000])
@pytest.mark.parametrize("reach", [0, 1])
def test_strips_of_many_layers_are_labelled_at_once(monkeypatch, at_once, reach):
    monkeypatch.setattr(regions, "AT_ONCE", at_once)
    rng = random.Random(at_once + reach)
    cells = sorted({(rng.choice("ab"), rng.randrange(3), rng.randrange(12), rng.randrange(8)) for _ in range(300)},
                   key=lambda c: (c[0], c[1], c[2] // 4, rng.random()))
    table = pa.table({"image_id": [c[0] for c in cells], "tone": [c[1] for c in cells],
                      "y": pa.array([c[2] for c in cells], pa.int32()), "x": pa.array([c[3] for c in cells], pa.int32()),
                      "_strip": [c[2] // 4 for c in cells]})
    out = regions._strip_regions(["image_id", "tone"], reach, 4)(iter(table.to_batches(max_chunksize=5)))
    label = {(r["image_id"], r["tone"], r["y"], x): r["region"] for b in out for r in b.to_pylist()
             for x in range(r["x0"], r["x1"] + 1)}
    assert set(label) == set(cells)
    for i, t, y, x in cells:  # the smallest place that a walk inside the strip reaches, a run counted by its start
        seen, todo = {(y, x)}, [(y, x)]
        while todo:
            v, u = todo.pop()
            for n in [(v + dv, u + du) for dv in (-1, 0, 1) for du in (-1, 0, 1) if reach or not (dv and du)]:
                if n not in seen and n[0] // 4 == y // 4 and (i, t, *n) in label:
                    seen.add(n)
                    todo.append(n)
        assert label[i, t, y, x] == min(v * regions._SPAN + u for v, u in seen)


def test_proposals_are_put_right_by_their_log(spark, monkeypatch):
    """A sample of a few words finds the merges of the whole table in few jobs."""
    rng = random.Random(5)
    counts = {"".join(rng.choices("abcdefgh", weights=range(1, 9), k=rng.randint(2, 8))): rng.randint(1, 9) for _ in range(900)}
    hist = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    jobs, verify = [], bpe._verify
    monkeypatch.setattr(bpe, "_verify", lambda *a: jobs.append(1) or verify(*a))
    merges, _ = T.train_bpe(hist, 60, steps=60, sample=60)
    index, want = bpe.PairIndex([list(w) for w in counts], counts.values()), []
    for _ in range(60):
        (a, b), c = min(index.total.items(), key=lambda e: (-e[1], e[0]))
        want.append((a, b, c))
        index.merge(a, b)
    assert [(r.a, r.b, r.c) for r in merges.orderBy("rank").collect()] == want
    assert len(jobs) <= 14


def test_a_batch_is_encoded_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 10)
    words = [["abc"], None, [], ["abcdefghijklmnop"], ["ab", "cd", "ef"], ["g"] * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(words, pa.list_(pa.string()))], ["key", "words"])
    parts = list(bpe._slices(batch))
    assert [r for p in parts for r in p.column("words").to_pylist()] == words
    assert all(p.num_rows == 1 or sum(len(w) for r in p.column("words").to_pylist() for w in r or []) <= 10 for p in parts)
    got = [r for b in bpe._encode({c: i for i, c in enumerate("abcdefg", 1)}, {}, set(), 0, 4)(iter([batch])) for r in b.to_pylist()]
    assert [(r["key"], r["n_ids"], r["input_ids"]) for r in got] == [
        (0, 3, [1, 2, 3]), (1, 0, []), (2, 0, []), (3, 16, [1, 2, 3, 4]), (4, 6, [1, 2, 3, 4]), (5, 9, [7, 7, 7, 7])]


def test_special_tokens_in_one_pass(spark):
    rng = random.Random(2)
    bits = [*T.BPE_SPECIALS, "d", "fil", "<", "/", "é", "😀", " ", "\n", " ", "x1_", "=\"", "stroke", ".", "\u0000"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(300)]
    alt = "|".join(re.escape(s) for s in sorted(T.BPE_SPECIALS, key=lambda s: (-len(s), s)))
    df = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string")
    plain = spark.createDataFrame(
        [(i, k, p, k % 2 == 1) for i, t in enumerate(texts) for k, p in enumerate(re.split(f"({alt})", t)) if p],
        "i int, k int, p string, special boolean")
    want = {r.i: r.w for r in plain.groupBy("i").agg(F.array_sort(F.collect_list(F.struct(
        "k", "special", "p", F.when(F.col("special"), F.array("p")).otherwise(T.pretokenize(F.col("p"))).alias("w")))).alias("w")).collect()}
    got = df.select("i", T.special_split(F.col("t"), T.BPE_SPECIALS).alias("s"),
                    T.pretokenize_with_specials(F.col("t"), T.BPE_SPECIALS).alias("w")).collect()
    for r in got:
        if r.i == len(texts):
            assert r.s is None and r.w is None
            continue
        rows = want.get(r.i, [])
        assert [(p.special, p.piece) for p in r.s] == [(p.special, p.p) for p in rows]
        assert r.w == [w for p in rows for w in p.w]
    assert T._one_special(T.BPE_SPECIALS).startswith("(?=[")


def test_strip_reads_only_the_ends(spark):
    texts = [chr(c) + "a" + chr(c) + "b" + chr(c) * 2 for c in range(1, 0x3100) if not 0xd800 <= c < 0xe000] + ["", " \n\t", "　", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    col = F.col("t")
    for r in df.select("t", py_strip(col).alias("s"), is_blank(col).alias("b")).collect():
        assert r.s == r.t.strip() and r.b == (not r.t.strip())
    assert PY_SPACE not in df.select(py_strip(col))._jdf.queryExecution().optimizedPlan().toString()


def test_rejects_name_values_that_no_token_trainer_takes(spark):
    lines = [(1, '{"svg": 5}'), (2, '{"svg": null, "caption": "a"}'), (3, '{"caption": "a"}'), (4, '{"svg": "<g/>", "caption": "a"}'),
             (5, "[1]"), (6, "{")]
    df = spark.createDataFrame(lines, "i int, line string")
    got = {r.i: r.reject for r in reject_reasons(df).where("policy = 'tokens'").collect()}
    assert got == {1: "svg_not_string", 2: "svg_not_string", 3: "no_svg_key", 5: "not_an_object", 6: "invalid_json"}
    assert {r.i for r in kept(read_jsonl(df, "tokens")).collect()} == {1, 2, 4}  # the reader hands them on


def test_large_rasters_go_to_many_parts(spark):
    px = spark.range(10).select(F.col("id").alias("image_id"))
    many = P.PART_PIXELS * (spark.sparkContext.defaultParallelism + 3)
    assert P.spread(px, many, "image_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism + 3


def test_alignment_decides_what_stands_beside_an_article(spark):
    from loomkit.llm import pages

    def page(own, said):
        return (f"<body><div>Site motto of the house</div><div>{own}</div><article><p>{said}</p><p>A sentence of many "
                "articles.</p></article><div>All rights are with the house</div><nav>home</nav></body>")
    rows = [(1, "http://h/a", page("Own words of the first page", "about rivers and hills")),
            (2, "http://h/b", page("Quite other words on the second", "about towns and roads")),
            (3, "http://alone/", page("Nobody to compare with", "about seas"))]
    got = {r["page_id"]: r["text"] for r in pages.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Own words of the first page\nabout rivers and hills\nA sentence of many articles.",
                   2: "Quite other words on the second\nabout towns and roads\nA sentence of many articles.",
                   3: "about seas\nA sentence of many articles."}
