"""JSON as text against Python's reader and writer on random lines."""

import json
import random

from pyspark.sql import functions as F

from loomkit.functions import json_text as J
from loomkit.sources.jsonl import kept, read_jsonl, rejected, to_jsonl, write_records

NUMBERS = ["0", "-0", "12", "1.0", "-1.50", "1e5", "1E-7", "123456789012345678901234567890", "0.1", "1e400", "-1e-400",
           "1.7976931348623157e308", "123456.789e3", "1e16", "1e15", "0.0001", "0.00001", "9007199254740993.0", "2e-3"]
NAMES = ['"a"', '"svg"', '"caption"', '"s\\u0076g"', '"source"', '"b:c"']
ESCAPED = ['"svg"', '"s\\u0076g"', '"a\\/b"', '"\\u00E9\\u0041\\u000a\\ud83d\\ude00"']
KINDS = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object",
         type(None): "null"}


def value(r, depth=0):
    kind = r.randint(0, 9 if depth < 3 else 6)
    space = lambda: r.choice(["", "", " ", "\t", "\r "])
    if kind == 0:
        text = "".join(r.choice('ab"\\/\n\té日😀\x7f\x01{}[]:,svg') for _ in range(r.randint(0, 8)))
        return json.dumps(text, ensure_ascii=r.random() < .5)
    if kind < 4:
        return r.choice((NUMBERS, ["true", "false", "null", "NaN", "Infinity", "-Infinity"], ESCAPED)[kind - 1])
    if kind in (4, 5, 7):
        inner = ("," + space()).join(r.choice(NAMES) + space() + ":" + space() + value(r, depth + 1) + space()
                                     for _ in range(r.randint(0, 4)))
        return "{" + space() + inner + "}"
    return "[" + space() + ("," + space()).join(value(r, depth + 1) + space() for _ in range(r.randint(0, 4))) + "]"


def random_lines():
    r = random.Random(5)
    out = []
    for _ in range(1200):
        line = r.choice(["", " ", "\t"]) + value(r) + r.choice(["", " "])
        if r.random() < .3:
            at = r.randrange(len(line))
            line = line[:at] + r.choice(['"', ",", "}", "x", " ", "\x01", "0"]) + line[at + 1:]
        out.append(line)
    return out + ["{} x", "01", '"a" "b"', "[1,]", '{"a":1,}', "﻿{}", "1" * 4301, "[1" + "0" * 4400 + ".5]", "[-]",
                  "-NaN", "+1", '"\t"', '{"a" "b"}', "[[[[]]]]", '"' + "x" * 200_000 + "\\n" * 3000 + '"', "nul",
                  "tr ue", "{1:2}", "'a'", "", "[" * 300 + "]" * 300]


def loads(line):
    repeated = []

    def pairs(ps):
        repeated.append(len({k for k, _ in ps}) < len(ps))
        return dict(ps)
    try:
        return True, json.loads(line, object_pairs_hook=pairs), any(repeated)
    except Exception:
        return False, None, False


def test_lines_read_and_written_as_python_does(spark):
    lines = random_lines()
    line, s, p = F.col("line"), F.col("s"), F.col("p")
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    out = df.select("i", "line", J.is_valid(line).alias("ok"), J.strings(line).alias("s"), J.pieces(line).alias("p"),
                    J.kind(line).alias("kind"))
    out = out.select("*", J.members(s, p, F.col("kind"), ["svg", "caption"]).alias("m"), J.dumps(s, p).alias("dumps"))
    out = out.select("i", "ok", "kind", "m", "dumps", *[e for k in ("svg", "caption") for e in (
        J.member_type(p, F.col(f"m.{k}")).alias(f"{k}_type"), J.member_text(line, s, p, F.col(f"m.{k}"), k).alias(k))])
    n = 0
    for row in out.collect():
        ok, v, repeated = loads(lines[row["i"]])
        assert row["ok"] == ok, lines[row["i"]][:200]
        if not ok:
            continue
        n += 1
        assert row["kind"] == KINDS[type(v)]
        said = json.dumps(v)
        assert (json.dumps(json.loads(row["dumps"])) if repeated else row["dumps"]) == said
        if isinstance(v, dict):
            for k in ("svg", "caption"):
                kind = "missing" if k not in v else KINDS[type(v[k])]
                assert row[f"{k}_type"] == kind
                if kind == "string":
                    assert row[k] == v[k]
        if isinstance(v, list):
            assert row["m"]["element"] == ("svg" in v)
    assert n > 800


def test_splice_replaces_the_last_top_level_value(spark):
    lines = ['{"a": {"svg": "1.256"}, "svg" : "x 1.256 é", "n": [1, "svg"], "z": NaN}',
             '{"svg": "9.999", "s\\u0076g": "<g y=\\"1.001\\" id=\\"q\\"/>"}', '["a", {"svg": "1.256"}]', '"plain\\/"',
             '{"svg": 5}', '["s\\u0076g"]', '{"svg": "1e999"}']
    scan = read_jsonl(spark.createDataFrame(list(enumerate(lines)), "i int, line string"), "cleaner")
    got = {r["i"]: r["record"] for r in kept(scan).collect()}
    assert got == {0: '{"a": {"svg": "1.256"}, "svg": "x 1.26 \\u00e9", "n": [1, "svg"], "z": NaN}',
                   1: '{"svg": "9.999", "svg": "<g id=\\"q\\" y=\\"1\\"/>"}', 2: '["a", {"svg": "1.256"}]', 3: '"plain/"'}
    assert {r["i"]: r["reject"] for r in rejected(scan).collect()} == {
        4: "svg_not_string", 5: "svg_index_on_list", 6: "number_overflow"}


def test_other_values_as_python_text(spark):
    values = ['5', '-0', '1.50', '1e5', 'NaN', '-Infinity', 'true', 'null', '[1, "a\'b", "q\\"", null, {"k": [true, 1e-7]}]',
              '{"x": "é\\n\\t\\\\\\u0001"}', '[]']
    lines = [(i, f'{{"caption": {v}, "svg": "s"}}') for i, v in enumerate(values)]
    got = dict(kept(read_jsonl(spark.createDataFrame(lines, "i int, line string"), "bpe")).select("i", "caption").collect())
    assert [got[i] for i in range(len(values))] == [f"{json.loads(v)}" for v in values]


def test_tokens_policy_keeps_any_value(spark):
    lines = [(0, '{"svg": 5}'), (1, '{"svg": null}'), (2, '{"svg": [1, 2]}'), (3, '{"x": 1}'), (4, '{"svg": "a"}')]
    got = dict(kept(read_jsonl(spark.createDataFrame(lines, "i int, line string"), "tokens")).select("i", "svg").collect())
    assert got == {0: "5", 1: None, 2: "[1,2]", 4: "a"}


def test_record_sink_appends_whole_lines(spark, tmp_path):
    lines = spark.createDataFrame([(1, '{"svg":"<g/>","id":7}'), (2, "")], "i int, line string")
    path = str(tmp_path / "out")
    write_records(kept(read_jsonl(lines, "cleaner")), path)
    write_records(kept(read_jsonl(lines, "cleaner")), path, mode="append")
    assert [r[0] for r in spark.read.text(path).collect()] == ['{"svg": "<g/>", "id": 7}'] * 2
    df = spark.createDataFrame([("é\"", None, "s")], "caption string, svg string, source string")
    assert to_jsonl(df).first()[0] == json.dumps({"caption": "é\"", "svg": None, "source": "s"})
