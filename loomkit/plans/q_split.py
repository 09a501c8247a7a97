"""Queries for the training-data stage: split, heads, batches, truncation, padding."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.operators import split as SP
from loomkit.operators import tokens as T
from loomkit.plans import duck as D
from loomkit.plans.q_records import trainer_rows
from loomkit.plans.registry import register
from loomkit.sources.tables import table

SEED = "loomkit"
MAX_LEN = SP.MAX_LEN["colab_fast"]
BATCH = 2


def _h(key: str) -> str:
    return f"CAST('0x' || substring(md5('{SEED}' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


_SPLIT_CTE = "WITH " + D.TRAINER + f""",
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY {_h('doc_id')}, doc_id) AS rnk, count(*) OVER () AS n FROM trainer),
sp AS (
  SELECT doc_id, CASE WHEN rnk <= ceil(0.05 * n) THEN 'test' ELSE 'train' END AS split,
    CASE WHEN rnk <= ceil(0.05 * n) THEN rnk ELSE rnk - ceil(0.05 * n) END AS pos FROM ranked)"""


def _split(spark, sf):
    return SP.split_positions(trainer_rows(spark, sf), "doc_id", seed=SEED)


@register("split_exact", _SPLIT_CTE + "\nSELECT doc_id, split, CAST(pos AS BIGINT) AS pos FROM sp")
def split_exact(spark, sf):
    """W4 + U4: exactly ceil(5%) of the rows in ``test``, chosen by hash order."""
    return _split(spark, sf).select("doc_id", "split", "pos")


@register("split_head", _SPLIT_CTE + """
SELECT doc_id, split, CAST(pos AS BIGINT) AS pos FROM sp
WHERE (split = 'train' AND pos <= 100) OR (split = 'test' AND pos <= 10)""")
def split_head(spark, sf):
    """L4: quick-test heads, min(100, len) train and min(10, len) test rows."""
    return SP.split_head(_split(spark, sf), SP.HEAD_QUICK).select("doc_id", "split", "pos")


@register("split_head_fast", _SPLIT_CTE + """
SELECT doc_id, split, CAST(pos AS BIGINT) AS pos FROM sp WHERE split = 'test' OR pos <= 2000""")
def split_head_fast(spark, sf):
    """L4: the fast mode's head, min(2000, len) train rows and all test rows."""
    return SP.split_head(_split(spark, sf), SP.HEAD_FAST).select("doc_id", "split", "pos")


@register("batch_ids", _SPLIT_CTE + f"\nSELECT doc_id, split, CAST(floor((pos - 1) / {BATCH}) AS BIGINT) AS batch_id FROM sp")
def batch_ids_q(spark, sf):
    """Batch number of each row inside its split."""
    return SP.batch_ids(_split(spark, sf), BATCH).select("doc_id", "split", "batch_id")


_PLAN_SQL = _SPLIT_CTE + "\n" + """, n AS (SELECT count(*) AS n_train FROM sp WHERE split = 'train'),
modes(mode, batch_size, grad_accum, configured_max_steps, logging_steps, max_len) AS (VALUES
  ('colab_fast', 2, 8, 200, 1, 2048), ('kaggle', 2, 4, 500, 10, 8192), ('local', 1, 8, 500, 1, 16384))
SELECT mode, batch_size, grad_accum, batch_size * grad_accum AS rows_per_step,
  CAST(ceil(n_train / (batch_size * grad_accum)) AS BIGINT) AS steps_per_epoch,
  CAST(ceil(n_train / (batch_size * grad_accum)) * 3 AS BIGINT) AS total_steps,
  configured_max_steps, logging_steps, max_len
FROM modes, n"""


@register("batch_plan", _PLAN_SQL.replace("FROM sp)\n, n AS", "FROM sp), n AS"))
def batch_plan_q(spark, sf):
    """Steps per run mode from the size of the train split."""
    n = _split(spark, sf).where("split = 'train'").agg(F.count(F.lit(1)).alias("n_train"))
    return n.select(F.explode(F.array(*SP.batch_plan(F.col("n_train")))).alias("m")).select("m.*")


_OVERRIDES = dict(batch_size=4, grad_accum=3, max_steps=50, logging_steps=5)
_OVERRIDE_SQL = (_PLAN_SQL.replace("FROM sp)\n, n AS", "FROM sp), n AS")
                 .replace("('colab_fast', 2, 8, 200, 1, 2048), ('kaggle', 2, 4, 500, 10, 8192), ('local', 1, 8, 500, 1, 16384)",
                          "('colab_fast', 4, 3, 50, 5, 2048), ('kaggle', 4, 3, 50, 5, 8192), ('local', 4, 3, 50, 5, 16384)"))


@register("batch_plan_overrides", _OVERRIDE_SQL)
def batch_plan_overrides(spark, sf):
    """The same plan with batch size, accumulation, step and logging overrides given."""
    n = _split(spark, sf).where("split = 'train'").agg(F.count(F.lit(1)).alias("n_train"))
    return n.select(F.explode(F.array(*SP.batch_plan(F.col("n_train"), **_OVERRIDES))).alias("m")).select("m.*")


# ---- encoding with the character vocabulary (byte-pair vocabulary before merges)

_NOSPACE = f"[^{T.UNI_SPACE}]"

_CHAR_IDS = f"""chars AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{_NOSPACE}')) AS token FROM documents),
specials(id, token) AS (VALUES {", ".join(f"({i}, {D.q(s)})" for i, s in enumerate(T.BPE_SPECIALS))}),
vocab AS (
  SELECT id, token FROM specials
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY token) - 1 + {len(T.BPE_SPECIALS)} AS INTEGER), token
  FROM chars WHERE token NOT IN (SELECT token FROM specials)),
exploded AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{_NOSPACE}')) AS ch,
    generate_subscripts(regexp_extract_all(text, '{_NOSPACE}'), 1) AS pos FROM documents),
filled AS (
  SELECT e.doc_id, list(coalesce(v.id, 0) ORDER BY e.pos) AS ids
  FROM exploded e LEFT JOIN vocab v ON v.token = e.ch GROUP BY e.doc_id),
enc AS (SELECT d.doc_id, coalesce(f.ids, []) AS ids FROM documents d LEFT JOIN filled f ON f.doc_id = d.doc_id)"""


def encoded_documents(spark, sf, max_tokens=None):
    """``(doc_id, input_ids)``: every non-blank character through the base vocabulary
    (specials, then characters by code point), looked up inside the row."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = T.base_vocab(T.initial_words(T.word_histogram(docs, "text")), T.BPE_SPECIALS)
    return T.encode_documents(docs, "doc_id", "text", vocab, max_tokens=max_tokens)


@register("encode_lookup", "WITH " + _CHAR_IDS + """
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS id_sum,
  array_to_string(ids, ' ') AS ids FROM enc""")
def encode_lookup(spark, sf):
    """J3 + T8: token -> id lookup (unknown -> <unk> = 0) over whole documents,
    the id sequence in full and in order."""
    enc = encoded_documents(spark, sf)
    return enc.select("doc_id", "n_ids", "id_sum", F.array_join("input_ids", " ").alias("ids"))


@register("truncate_ids", "WITH " + _CHAR_IDS + f"""
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, len(ids) > {MAX_LEN} AS truncated,
  CAST(least(len(ids), {MAX_LEN}) AS INTEGER) AS n_kept, CAST(coalesce(list_sum(ids[1:{MAX_LEN}]), 0) AS BIGINT) AS kept_sum FROM enc""")
def truncate_ids(spark, sf):
    """T5: ids cut at 2048 (colab-fast cap) and a flag for cut rows."""
    enc = encoded_documents(spark, sf, max_tokens=MAX_LEN)
    kept = F.col("input_ids")
    return enc.select("doc_id", "n_ids", (F.col("n_ids") > MAX_LEN).alias("truncated"),
                      F.size(kept).alias("n_kept"),
                      F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("kept_sum"))


_PAD_SQL = "WITH " + _CHAR_IDS + f""",
tr AS (SELECT doc_id, ids[1:{MAX_LEN}] AS ids FROM enc),
ranked AS (SELECT doc_id, ids, row_number() OVER (ORDER BY {_h('doc_id')}, doc_id) AS rnk, count(*) OVER () AS n FROM tr),
sp AS (SELECT doc_id, ids, CASE WHEN rnk <= ceil(0.05 * n) THEN 'test' ELSE 'train' END AS split,
  CASE WHEN rnk <= ceil(0.05 * n) THEN rnk ELSE rnk - ceil(0.05 * n) END AS pos FROM ranked),
b AS (SELECT *, CAST(floor((pos - 1) / {BATCH}) AS BIGINT) AS batch_id FROM sp),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY split, batch_id) AS batch_len FROM b)
SELECT doc_id, split, batch_id, CAST(batch_len AS INTEGER) AS batch_len, CAST(batch_len - len(ids) AS INTEGER) AS n_pad,
  CAST(len(ids) AS BIGINT) AS mask_sum, CAST(coalesce(list_sum(ids), 0) + (-100) * (batch_len - len(ids)) AS BIGINT) AS label_sum
FROM m"""


@register("pad_batch", _PAD_SQL)
def pad_batch(spark, sf):
    """Documents split and batched by two, padded to the longest row of the batch."""
    enc = encoded_documents(spark, sf, max_tokens=MAX_LEN).select("doc_id", "input_ids")
    places = SP.split_positions(table(spark, sf, "documents"), "doc_id", seed=SEED)
    b = enc.join(SP.batch_ids(places, BATCH), "doc_id")
    p = SP.pad_batches(b)
    s = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return p.select("doc_id", "split", "batch_id", "batch_len",
                    (F.col("batch_len") - F.size("input_ids")).alias("n_pad"),
                    s(F.col("attention_mask")).alias("mask_sum"), s(F.col("labels")).alias("label_sum"))
