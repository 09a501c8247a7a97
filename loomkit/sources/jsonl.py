"""Tolerant JSONL scan (S1) with the four reader policies, and the JSON sinks.

A line is split once into strings and the pieces between them (``functions/json_text``);
grammar, kind, member types and values are read from those, so the scan is one narrow
stage without a shuffle, and the raw record survives: key order, extra keys, lists,
strings, repeated keys, NaN. Every policy is a projection over the same parse.

Policies (which rows survive, per reader):

- ``cleaner``: objects keep all keys; ``svg`` must be a string and is rewritten by
  X1 then X3; lists and strings without an ``svg`` element survive as they are;
  numbers, null and booleans are rejected. ``record`` is the whole line, written anew.
- ``trainer``: objects only; ``caption`` and ``svg`` default to "" when missing,
  must be strings, and must be non-empty after ``strip``.
- ``bpe``: objects only; missing -> "", other values as Python's text of them.
- ``tokens``: objects with an ``svg`` key; the value is used as it is.

Of repeated keys the last one counts, as in a Python dict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomkit.functions import json_text as J
from loomkit.functions.markup import clean_markup
from loomkit.functions.text import compute_once, is_blank, py_strip

POLICIES = ("cleaner", "trainer", "bpe", "tokens")
KEYS = ["svg", "caption", "source"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)`` from text files; the line number keeps runs repeatable."""
    df = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    return df.withColumn("line_no", F.monotonically_increasing_id())


def parse(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Adds ``blank``, ``valid``, ``kind``, the line's strings and pieces, its members and their
    types, once per line. All but ``blank`` and ``valid`` are NULL where the line is no JSON."""
    line = F.col(line_col)
    cut = compute_once(lines, lines.columns, blank=is_blank(line), cut=J.pieces(line))
    base = compute_once(cut, cut.columns, valid=J.is_valid(line, F.col("cut")))
    split = compute_once(base, [*lines.columns, "blank", "valid"], kind=F.when(F.col("valid"), J.kind(line)),
                         texts=F.when(F.col("valid"), J.strings(line)),
                         between=F.when(F.col("valid"), F.col("cut")))
    found = compute_once(split, split.columns,
                         at=J.members(F.col("texts"), F.col("between"), F.col("kind"), KEYS))
    obj = F.col("kind") == "object"
    return compute_once(found, found.columns, **{
        f"{k}_type": F.when(obj, J.member_type(F.col("between"), F.col(f"at.{k}"))) for k in KEYS})


def _get_string(key: str, line_col: str) -> Column:
    return F.when(F.col("kind") == "object", J.member_text(
        F.col(line_col), F.col("texts"), F.col("between"), F.col(f"at.{key}"), key, F.col(f"{key}_type")))


def _as_text(key: str, line_col: str) -> Column:
    """Python ``f"{value}"`` of a field: "" when missing, "None" for null."""
    t, raw = F.col(f"{key}_type"), _get_string(key, line_col)
    return (F.when(t == "missing", "").when(t == "null", "None").when(t == "string", raw)
            .otherwise(J.python_text(raw)))


def reject_reason(policy: str, overflow: Column | None = None, caption: Column | None = None,
                  svg: Column | None = None) -> Column:
    """why a parsed line is dropped under a policy; NULL when it is kept.

    ``overflow`` says that the markup rewrite failed; ``caption`` and ``svg`` are the stripped fields.
    """
    kind, st, ct = F.col("kind"), F.col("svg_type"), F.col("caption_type")
    invalid = F.when(~F.col("valid"), "invalid_json")
    if policy == "cleaner":
        reason = (invalid.when(kind.isin("number", "null", "boolean"), "not_a_container")
                  .when(F.col("at.element"), "svg_index_on_list")
                  .when((kind == "string") & F.contains(J.unescape(F.get("texts", F.lit(0))), F.lit("svg")),
                        "svg_index_on_string")
                  .when((kind == "object") & ~st.isin("missing", "string"), "svg_not_string"))
        return reason if overflow is None else reason.when(overflow, "number_overflow")
    reason = invalid.when(kind != "object", "not_an_object")
    if policy == "trainer":
        return (reason.when(~ct.isin("missing", "string"), "caption_not_string")
                .when(~st.isin("missing", "string"), "svg_not_string")
                .when((caption == "") | (svg == ""), "empty_after_strip"))
    return reason if policy == "bpe" else reason.when(st == "missing", "no_svg_key")


def _stripped(key: str, line_col: str) -> Column:
    return F.when(F.col(f"{key}_type") == "missing", "").otherwise(py_strip(_get_string(key, line_col)))


def reject_reasons(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``(keys..., policy, reject)`` of every dropped line under each policy, from one parse.

    ``svg_not_string`` under ``tokens`` names a value that the reader hands on but no trainer takes.
    """
    keys = [c for c in lines.columns if c != line_col]
    p = parse(lines, line_col).where(~F.col("blank"))
    svg = F.when(F.col("svg_type") == "string", _get_string("svg", line_col))
    reasons = {
        "cleaner": reject_reason("cleaner", overflow=svg.isNotNull() & clean_markup(svg).isNull()),
        "trainer": reject_reason("trainer", caption=_stripped("caption", line_col), svg=_stripped("svg", line_col)),
        "bpe": reject_reason("bpe"),
        "tokens": F.coalesce(reject_reason("tokens"), F.when(F.col("svg_type") != "string", "svg_not_string"))}
    rows = F.array(*[F.struct(F.lit(k).alias("policy"), r.alias("reject")) for k, r in reasons.items()])
    return p.select(*keys, F.inline(rows)).where(F.col("reject").isNotNull())


def read_jsonl(lines: DataFrame, policy: str = "trainer", line_col: str = "line",
               ndigits: int = 2, mode: str = "faithful", rounding: str = "binary") -> DataFrame:
    """Every non-blank line with a ``reject`` reason (NULL when the row is kept).

    Output columns: the input key columns, ``kind``, ``caption``, ``svg``,
    ``source`` and ``reject``, and for the cleaner ``record``, the whole line as
    ``json.dumps`` writes it with the new ``svg``. Blank lines are skipped (F1), as all
    readers do.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    keys = [c for c in lines.columns if c != line_col]
    p = parse(lines, line_col).where(~F.col("blank"))
    source, extra = _get_string("source", line_col), {}
    if policy == "cleaner":
        has_svg = F.col("svg_type") == "string"
        p = compute_once(p, p.columns, cleaned=F.when(has_svg, clean_markup(
            _get_string("svg", line_col), ndigits, mode, rounding)))
        reject = reject_reason(policy, overflow=has_svg & F.col("cleaned").isNull())
        caption, svg = _get_string("caption", line_col), F.col("cleaned")
        texts = F.when(has_svg, J.splice_string(F.col("texts"), F.col("at.svg"), svg)).otherwise(F.col("texts"))
        extra["record"] = F.when(reject.isNull(), J.dumps(texts, F.col("between")))
    elif policy == "trainer":
        p = compute_once(p, p.columns, caption_s=_stripped("caption", line_col), svg_s=_stripped("svg", line_col))
        caption, svg = F.col("caption_s"), F.col("svg_s")
        reject = reject_reason(policy, caption=caption, svg=svg)
    elif policy == "bpe":
        caption, svg, reject = _as_text("caption", line_col), _as_text("svg", line_col), reject_reason(policy)
    else:  # tokens
        caption, svg, reject = F.lit(None).cast("string"), _get_string("svg", line_col), reject_reason(policy)
    return compute_once(p, keys, kind=F.col("kind"), caption=caption, svg=svg, source=source, reject=reject, **extra)


def kept(scanned: DataFrame) -> DataFrame:
    """Rows that survived the policy."""
    return scanned.where(F.col("reject").isNull()).drop("reject")


def rejected(scanned: DataFrame) -> DataFrame:
    """the rejected rows and their reason."""
    return scanned.where(F.col("reject").isNotNull())


def to_jsonl(df: DataFrame, cols=("caption", "svg", "source")) -> DataFrame:
    """K1: one JSON object per row (``value`` column) in ``json.dumps`` form, ready for ``write.text``."""
    raw = df.select(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}).alias("raw"))
    return raw.select(J.dumps(J.strings(F.col("raw")), J.pieces(F.col("raw"))).alias("value"))


def write_records(cleaned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1 / K2: the cleaner's whole records, one line each."""
    cleaned.select(F.col("record").alias("value")).write.mode(mode).text(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite",
                cols=("caption", "svg", "source")) -> None:
    """K1 / K2: JSONL sink; ``mode="append"`` adds a second corpus to the same folder."""
    to_jsonl(df, cols).write.mode(mode).text(path)


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of tokens in id order -> ``(id, token)``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.from_json("value", "array<string>")).alias("id", "token"))


def vocab_json(vocab: DataFrame) -> DataFrame:
    """K3: ``(id, token)`` -> one JSON array ordered by id (a single row)."""
    arr = F.array_sort(F.collect_list(F.struct("id", "token")))
    return vocab.agg(F.to_json(F.transform(arr, lambda s: s["token"])).alias("value"))
