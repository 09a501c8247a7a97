"""Queries over corpus records: scan policies, filters, joins, chat text."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.functions import chat, markup
from loomkit.functions.text import compute_once
from loomkit.operators import records as R
from loomkit.plans import duck as D
from loomkit.plans.registry import register
from loomkit.sources import fixtures as FX
from loomkit.sources.jsonl import kept, read_jsonl, reject_reasons
from loomkit.sources.tables import table


def record_lines(spark, sf):
    return FX.record_lines(table(spark, sf, "documents"), table(spark, sf, "part"))


def trainer_rows(spark, sf):
    return kept(read_jsonl(record_lines(spark, sf), "trainer"))


# ---------------------------------------------------------------- flagship
_REPORT_SQL = "WITH " + D.TRAINER + f""",
cleaned AS (
  SELECT doc_id, caption, source, {D.round_numbers('svg')} AS svg1 FROM trainer WHERE length(svg) < 64000),
chat AS (
  SELECT doc_id, source, {D.chat_text('caption', D.sort_attributes('svg1'))} AS text FROM cleaned WHERE svg1 IS NOT NULL)
SELECT source, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS total_chars, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
       max(length(text)) AS max_chars, min(length(text)) AS min_chars
FROM chat GROUP BY source"""


def corpus_report_df(spark, sf):
    """Flagship: JSONL lines -> trainer scan -> length cap -> X1 -> X3 -> chat text
    -> rows, characters and bytes per source. Narrow until the final aggregate."""
    rows = trainer_rows(spark, sf).where(R.under_length_cap(F.col("svg")))
    rows = compute_once(rows, ["doc_id", "caption", "source"], svg=markup.round_numbers(F.col("svg")))
    rows = rows.where(F.col("svg").isNotNull())
    text = rows.select("doc_id", "source",
                       chat.chat_text(F.col("caption"), markup.sort_attributes(F.col("svg"))).alias("text"))
    return R.size_report(text, "text", ["source"])


register("corpus_report", _REPORT_SQL)(corpus_report_df)


# ---------------------------------------------------------------- S1 policies
@register("read_jsonl_trainer", "WITH " + D.TRAINER + "\nSELECT doc_id, caption, svg, source FROM trainer")
def read_jsonl_trainer(spark, sf):
    return trainer_rows(spark, sf).select("doc_id", "caption", "svg", "source")


_RECORD_SQL = f"""'{{' || array_to_string(list_filter([
    CASE WHEN caption_type <> 'missing' THEN '"caption": ' || coalesce({D.json_string('j_caption')}, 'null') END,
    CASE WHEN svg_type <> 'missing' THEN '"svg": ' || {D.json_string('svg2')} END,
    CASE WHEN json_type(line, '$.source') IS NOT NULL THEN '"source": ' || {D.json_string('j_source')} END],
  lambda x: x IS NOT NULL), ', ') || '}}'"""

_CLEANER_SQL = "WITH " + D.LINES + ",\n" + D.parsed_cte() + f""",
r1 AS (SELECT *, CASE WHEN kind = 'object' AND svg_type <> 'missing' THEN {D.round_numbers('j_svg')} END AS svg1 FROM parsed),
r2 AS (SELECT *, CASE WHEN kind = 'object' AND svg_type <> 'missing' THEN {D.sort_attributes('svg1')} END AS svg2 FROM r1
  WHERE valid AND kind IN ('object', 'array', 'string')
    AND NOT (kind = 'object' AND svg_type <> 'missing' AND (svg_type <> 'string' OR svg1 IS NULL)))
SELECT doc_id, kind, CASE WHEN kind = 'object' THEN j_caption END AS caption, svg2 AS svg,
  CASE WHEN kind = 'object' THEN j_source END AS source, {_RECORD_SQL} AS record
FROM r2"""


@register("read_jsonl_cleaner", _CLEANER_SQL)
def read_jsonl_cleaner(spark, sf):
    """Entry B: the cleaner keeps records without ``svg``; ``svg`` is rounded then sorted,
    and ``record`` is the whole line around it."""
    return kept(read_jsonl(record_lines(spark, sf), "cleaner")).select(
        "doc_id", "kind", "caption", "svg", "source", "record")


_ODD_SQL = "WITH " + D.SVGS + f""",
d AS (SELECT d.doc_id, d.doc_id % 9 AS form, d.source, {D.json_string('d.text')} AS j_text, d.text, s.svg
  FROM documents d LEFT JOIN svgs s ON s.svg_key = d.doc_id % (SELECT greatest(count(*), 1) FROM part)),
c AS (SELECT *, {D.json_string(D.sort_attributes(D.round_numbers('svg')))} AS j_svg FROM d)
SELECT doc_id, CASE form
    WHEN 0 THEN '{{"id": ' || doc_id || ', "svg": ' || j_svg || ', "tags": ["a", "svg"], "caption": ' || j_text || '}}'
    WHEN 1 THEN '[' || j_text || ', ["svg"], 1.5]'
    WHEN 3 THEN j_text
    WHEN 4 THEN '{{"nested": {{"svg": "1.256", "n": 100000.0}}, "svg": ' || j_svg || ', "m": NaN}}'
    WHEN 7 THEN '{{"caption": {{"a": [1, 2, null]}}, "svg": ' || j_svg || ', "source": null}}'
    ELSE '{{"caption": ' || j_text || ', "svg": ' || j_svg || ', "source": "s"}}' END AS record
FROM c WHERE form NOT IN (2, 5, 6) AND NOT (form = 3 AND contains(text, 'svg'))"""


@register("clean_records", _ODD_SQL)
def clean_records(spark, sf):
    """S1 + K1 + X10: whole records through the cleaner, among them extra keys, nested
    objects, lists, strings, NaN, escapes and loose white space."""
    lines = FX.odd_lines(table(spark, sf, "documents"), table(spark, sf, "part"))
    return kept(read_jsonl(lines, "cleaner")).select("doc_id", "record")


_REJECTS_SQL = "WITH " + D.LINES + ",\n" + D.parsed_cte() + """,
reasons AS (
  SELECT doc_id, 'trainer' AS policy, CASE
      WHEN NOT valid THEN 'invalid_json' WHEN kind <> 'object' THEN 'not_an_object'
      WHEN caption_type NOT IN ('missing', 'string') THEN 'caption_not_string'
      WHEN svg_type NOT IN ('missing', 'string') THEN 'svg_not_string'
      WHEN """ + D.strip("coalesce(j_caption, '')") + " = '' OR " + D.strip("coalesce(j_svg, '')") + """ = '' THEN 'empty_after_strip'
    END AS reject FROM parsed
  UNION ALL
  SELECT doc_id, 'cleaner', CASE
      WHEN NOT valid THEN 'invalid_json' WHEN kind IN ('number', 'null', 'boolean') THEN 'not_a_container'
      WHEN kind = 'object' AND svg_type NOT IN ('missing', 'string') THEN 'svg_not_string' END FROM parsed
  UNION ALL
  SELECT doc_id, 'bpe', CASE WHEN NOT valid THEN 'invalid_json' WHEN kind <> 'object' THEN 'not_an_object' END FROM parsed
  UNION ALL
  SELECT doc_id, 'tokens', CASE
      WHEN NOT valid THEN 'invalid_json' WHEN kind <> 'object' THEN 'not_an_object'
      WHEN svg_type = 'missing' THEN 'no_svg_key' WHEN svg_type <> 'string' THEN 'svg_not_string' END FROM parsed)
SELECT doc_id, policy, reject FROM reasons WHERE reject IS NOT NULL"""


@register("read_jsonl_rejects", _REJECTS_SQL)
def read_jsonl_rejects(spark, sf):
    """the rejected lines of all four readers with a typed reason, from one parse."""
    return reject_reasons(record_lines(spark, sf))


_BPE_SQL = "WITH " + D.LINES + ",\n" + D.parsed_cte() + """
SELECT doc_id,
  CASE caption_type WHEN 'missing' THEN '' WHEN 'null' THEN 'None' ELSE j_caption END AS caption,
  CASE svg_type WHEN 'missing' THEN '' WHEN 'null' THEN 'None' ELSE j_svg END AS svg
FROM parsed WHERE valid AND kind = 'object'"""


@register("read_jsonl_bpe", _BPE_SQL)
def read_jsonl_bpe(spark, sf):
    """Vocabulary-corpus reader: missing -> "", null -> "None", numbers as text."""
    return kept(read_jsonl(record_lines(spark, sf), "bpe")).select("doc_id", "caption", "svg")


# ---------------------------------------------------------------- projections
@register("chat_text", "WITH " + D.TRAINER + f"\nSELECT doc_id, {D.chat_text('caption', 'svg')} AS text FROM trainer")
def chat_text_q(spark, sf):
    """P3 over the trainer's rows."""
    rows = trainer_rows(spark, sf)
    return rows.select("doc_id", chat.chat_text(F.col("caption"), F.col("svg")).alias("text"))


_MULTI_SQL = f"""SELECT conv_id,
  string_agg({D.q(chat.IM_START)} || role || chr(10) || text || {D.q(chat.IM_END)}, chr(10) ORDER BY turn) AS text,
  count(*) AS n_turns
FROM conversations GROUP BY conv_id"""


@register("chat_text_multiturn", _MULTI_SQL)
def chat_text_multiturn(spark, sf):
    """P5: turns of a conversation in ``turn`` order, joined by newlines.

    Turns are formatted row by row before the shuffle; only the formatted segment
    and its turn number travel to the per-conversation assembly.
    """
    conv = table(spark, sf, "conversations")
    seg = conv.select("conv_id", "turn", chat.turn_text(F.col("role"), F.col("text")).alias("seg"))
    return seg.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "seg"))), lambda s: s["seg"]),
                     "\n").alias("text"),
        F.count(F.lit(1)).alias("n_turns"))


_PROMPT_SQL = f"""SELECT doc_id,
  {D.q(chat.IM_START + 'user' + chr(10) + chat.INSTRUCTION)} || text || {D.q(chat.IM_END + chr(10) + chat.IM_START + 'assistant' + chr(10))} AS prompt,
  {D.q(chat.IM_START + 'user' + chr(10) + chat.INSTRUCTION)} || text || {D.q(chat.IM_END + chr(10) + chat.IM_START + 'assistant' + chr(10) + chat.PRIMER)} AS primed
FROM documents"""


@register("prompt_text", _PROMPT_SQL)
def prompt_text_q(spark, sf):
    """Prompt-only text, plain and primed."""
    docs = table(spark, sf, "documents")
    cap = F.col("text")
    return docs.select("doc_id", chat.prompt_text(cap).alias("prompt"), chat.prompt_text(cap, primer=True).alias("primed"))


_RESOLVE_SQL = """SELECT e.vec_id AS image_id, e.label + 20 AS label, coalesce(n.n_name, CAST(e.label + 20 AS VARCHAR)) AS caption
FROM embeddings e LEFT JOIN nation n ON n.n_nationkey = e.label + 20"""


@register("resolve_caption", _RESOLVE_SQL)
def resolve_caption_q(spark, sf):
    """P1 + J1: class-name lookup with the number as fallback."""
    rows = FX.labelled_rows(table(spark, sf, "embeddings"))
    return R.resolve_caption(rows, FX.class_names(table(spark, sf, "nation"))).select("image_id", "label", "caption")


_PROJECT_SQL = "WITH " + D.TRAINER + "\nSELECT caption, svg, 'records' AS source FROM trainer"


@register("project_record", _PROJECT_SQL)
def project_record_q(spark, sf):
    """``{caption, svg, source}`` with a constant source name (P6 drops the rest)."""
    return R.project_record(trainer_rows(spark, sf), "records")


_CAP_SQL = """SELECT doc_id, length(text) AS n_chars FROM documents
WHERE length(text) < 64000 AND text <> ''"""


@register("filter_length_cap", _CAP_SQL)
def filter_length_cap(spark, sf):
    """F5 + F6 with the document text as markup (long enough for the cap to bite)."""
    docs = table(spark, sf, "documents")
    return docs.where(R.corpus_filter(F.col("text"))).select("doc_id", F.char_length("text").alias("n_chars"))


_NONEMPTY_SQL = f"""SELECT conv_id, turn FROM conversations
WHERE {D.strip('role')} <> '' AND {D.strip('text')} <> ''"""


@register("filter_nonempty", _NONEMPTY_SQL)
def filter_nonempty(spark, sf):
    """both fields non-empty after Python ``strip``."""
    conv = table(spark, sf, "conversations")
    return conv.where(R.nonempty_after_strip(F.col("role"), F.col("text"))).select("conv_id", "turn")


_UNION_SQL = "WITH " + D.TRAINER + """,
u AS (SELECT caption, svg, 'records' AS source FROM trainer
      UNION ALL SELECT url, html, 'pages' FROM pages)
SELECT source, count(*) AS n_rows, CAST(sum(length(svg)) AS BIGINT) AS total_chars FROM u GROUP BY source"""


@register("union_corpora", _UNION_SQL)
def union_corpora_q(spark, sf):
    """A second corpus appended to the first (bag union by name)."""
    a = R.project_record(trainer_rows(spark, sf), "records")
    pages = table(spark, sf, "pages").select(F.col("url").alias("caption"), F.col("html").alias("svg"))
    b = R.project_record(pages, "pages")
    u = R.union_corpora(a, b)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum(F.char_length("svg")).cast("bigint").alias("total_chars"))


_LIMIT_SQL = "WITH " + D.TRAINER + """
SELECT doc_id, source FROM trainer WHERE length(svg) < 64000 ORDER BY doc_id LIMIT 100"""


@register("limit_surviving", _LIMIT_SQL)
def limit_surviving(spark, sf):
    """L3: ``target_count`` counts rows after the filters (here 100, by doc_id)."""
    rows = trainer_rows(spark, sf).where(R.under_length_cap(F.col("svg")))
    return R.first_surviving(rows, 100, ["doc_id"]).select("doc_id", "source")


_FIRST_SQL = "WITH " + D.TRAINER + "\nSELECT doc_id, svg FROM trainer ORDER BY doc_id LIMIT 1"


@register("first_row", _FIRST_SQL)
def first_row_q(spark, sf):
    """The first corpus row, the tokenizer report's sample."""
    return R.first_row(trainer_rows(spark, sf), ["doc_id"]).select("doc_id", "svg")


_SIZE_SQL = """SELECT source, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS total_chars, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
  max(length(text)) AS max_chars, min(length(text)) AS min_chars FROM documents GROUP BY source"""


@register("size_report", _SIZE_SQL)
def size_report_q(spark, sf):
    """Characters vs UTF-8 bytes per source (partial aggregation first)."""
    return R.size_report(table(spark, sf, "documents"), "text", ["source"])


_JSON_SQL = """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
  coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events"""


@register("json_default", _JSON_SQL)
def json_default(spark, sf):
    """X11: JSON get with a default."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"),
                     F.coalesce(F.get_json_object("props", "$.missing"), F.lit("")).alias("missing"))


_COMPLETIONS_SQL = """WITH c AS (
  SELECT doc_id, text AS prompt,
    CASE doc_id % 5
      WHEN 0 THEN '<svg viewBox="0 0 8 8"><path d="M' || CAST(n_chars AS VARCHAR) || ' 1"/>' || '</svg>'
      WHEN 1 THEN '```svg' || chr(10) || '<svg viewBox="0 0 8 8"><path d="M' || CAST(n_chars AS VARCHAR) || ' 1"/>' || '</svg>' || chr(10) || '```'
      WHEN 2 THEN 'Here you go: ' || '<svg viewBox="0 0 8 8"><path d="M' || CAST(n_chars AS VARCHAR) || ' 1"/>' || '</svg>'
      WHEN 3 THEN '<svg viewBox="0 0 8 8"><path d="M' || CAST(n_chars AS VARCHAR) || ' 1"/>'
      ELSE '<svg viewBox="0 0 8 8"><path d="M' || CAST(n_chars AS VARCHAR) || ' 1"/>' || '</svg></svg>' END AS response
  FROM documents),
s AS (SELECT doc_id, prompt, """ + D.strip("replace(replace(replace(response, '```xml', ''), '```svg', ''), '```', '')") + """ AS s FROM c),
f AS (SELECT doc_id, prompt, CASE WHEN starts_with(s, '<svg') THEN s ELSE '<svg ' || s END AS s FROM s)
SELECT doc_id,
  CASE WHEN strpos(s, '</svg>') > 0 THEN substring(s, 1, strpos(s, '</svg>') + 5) ELSE s || chr(10) || '</svg>' END AS svg,
  replace(prompt, ' ', '_') || '.svg' AS file_name
FROM f"""


@register("extract_svg", _COMPLETIONS_SQL)
def extract_svg_q(spark, sf):
    """X7 + X8 / K4 table: repaired markup and its file name per completion."""
    comp = FX.completions(table(spark, sf, "documents"))
    return comp.select("doc_id", chat.extract_svg(F.col("response")).alias("svg"),
                       chat.file_name(F.col("prompt")).alias("file_name"))


_RATE_SQL = """SELECT event_type, count(*) AS n_runs, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS seconds,
  round(CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) / CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 6) AS tokens_per_s
FROM events GROUP BY event_type"""


@register("tokens_per_second", _RATE_SQL)
def tokens_per_second(spark, sf):
    """A10 over ``events`` read as a run log: engine = event_type, tokens = props.k,
    seconds = value."""
    ev = table(spark, sf, "events")
    return R.rate_report(ev, ["event_type"], F.get_json_object("props", "$.k").cast("bigint"), F.col("value"))
