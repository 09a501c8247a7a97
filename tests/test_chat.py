"""Chat text, prompts, completion repair and file names."""

from pyspark.sql import functions as F

from loomkit.functions import chat as C


def out(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def test_extract_svg_golden(spark):
    assert out(spark, C.extract_svg, ["<svg a></svg>tail", "Hi <svg></svg>", "<svg x",
                                      "```svg\n<svg/></svg>\n```"]) == [
        "<svg a></svg>", "<svg Hi <svg></svg>", "<svg x\n</svg>", "<svg/></svg>"]
    assert out(spark, lambda c: C.extract_svg(c, "safe"), ["Hi <svg></svg>", "x y"]) == [
        "<svg></svg>", "<svg x y\n</svg>"]


def test_file_names(spark):
    assert out(spark, C.file_name, ["a red cat"]) == ["a_red_cat.svg"]
    assert out(spark, C.preview_name, ["out/cat.svg", "plain", "a.b/c"]) == [
        "out/cat_preview.png", "plain_preview.png", "a.b/c_preview.png"]


def test_chat_and_prompt_text(spark):
    df = spark.createDataFrame([("a cat", "<svg/>")], "c string, s string")
    r = df.select(C.chat_text(F.col("c"), F.col("s")).alias("t"), C.prompt_text(F.col("c")).alias("p"),
                  C.prompt_text(F.col("c"), primer=True).alias("q")).first()
    assert r.t == ("<|im_start|>user\nGenerate an SVG for: a cat<|im_end|>\n"
                   "<|im_start|>assistant\n<svg/><|im_end|>")
    assert r.p == "<|im_start|>user\nGenerate an SVG for: a cat<|im_end|>\n<|im_start|>assistant\n"
    assert r.q.startswith(r.p) and r.q.endswith("-->\n<svg")
