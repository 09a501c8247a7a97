"""DuckDB SQL fragments used by the correctness oracle.

Each helper returns SQL text that computes, with DuckDB's own functions, what the
Spark column function of the same name computes. They exist only to build the
independent ``oracle_sql()`` strings.
"""

from __future__ import annotations

from loomkit.functions.markup import ATTRIBUTE, ATTRIBUTE_PRIORITY, NUMBER_ANY, NUMBER_DECIMAL, OTHER_PRIORITY, TAG
from loomkit.functions.text import PY_SPACE
from loomkit.functions.chat import IM_END, IM_START, INSTRUCTION


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q(f'^{PY_SPACE}+|{PY_SPACE}+$')}, '', 'g')"


def is_blank(e: str) -> str:
    return f"regexp_matches({e}, {q(f'^{PY_SPACE}*$')})"


def round_literal(m: str, n: int = 2) -> str:
    """Python ``round(float(m), n)`` text: exact binary tie-break with HUGEINT."""
    scale = 10 ** n
    x = f"TRY_CAST({m} AS DOUBLE)"
    ax = f"abs({x})"
    dec = f"abs(TRY_CAST({m} AS DECIMAL(38,18)))"
    scaled = f"({dec} * {scale})"
    fl = f"floor({scaled})"
    near = f"(abs(({scaled} - {fl}) - 0.5) < 0.000000001)"
    k = f"CAST(53 - floor(log2(greatest({ax}, 1e-300))) AS INTEGER)"
    b = f"CAST({ax} * pow(2, {k}) AS HUGEINT)"
    lhs = f"({b} * {2 * scale})"
    rhs = f"(CAST(2 * {fl} + 1 AS HUGEINT) * (1::HUGEINT << {k}))"
    tied = f"(CASE WHEN {lhs} > {rhs} THEN {fl} + 1 WHEN {lhs} < {rhs} THEN {fl} ELSE {fl} + ({fl} % 2) END)"
    units = f"CAST(CASE WHEN {near} THEN {tied} ELSE round_even({scaled}, 0) END AS HUGEINT)"
    digits = f"lpad(CAST({units} AS VARCHAR), CAST(greatest(length(CAST({units} AS VARCHAR)), {n + 1}) AS INTEGER), '0')"
    if n > 0:
        body = f"left({digits}, length({digits}) - {n}) || '.' || right({digits}, {n})"
        body = f"regexp_replace(regexp_replace({body}, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"
    else:
        body = f"CAST({units} AS VARCHAR)"
    sign = f"CASE WHEN {x} < 0 AND {units} <> 0 THEN '-' ELSE '' END"
    return (f"(CASE WHEN isinf({x}) OR isnan({x}) THEN NULL "
            f"WHEN {ax} < 4503599627370496.0 THEN {sign} || {body} "
            f"ELSE CAST(CAST({x} AS HUGEINT) AS VARCHAR) END)")


def substitute(text: str, pattern: str, fn) -> str:
    """``re.sub(pattern, fn, text)``: pieces between matches zipped with replacements."""
    pieces = f"string_split_regex({text}, {q(pattern)})"
    repl = f"list_transform(regexp_extract_all({text}, {q(pattern)}), lambda lm_s: {fn('lm_s')})"
    return (f"array_to_string(list_transform(list_zip({pieces}, {repl}), "
            f"lambda lm_z: lm_z[1] || coalesce(lm_z[2], '')), '')")


def round_numbers(text: str, n: int = 2) -> str:
    overflow = (f"coalesce(list_bool_or(list_transform(regexp_extract_all({text}, {q(NUMBER_ANY)}), "
                f"lambda lm_o: isinf(CAST(lm_o AS DOUBLE)))), false)")
    return f"(CASE WHEN {overflow} THEN NULL ELSE {substitute(text, NUMBER_ANY, lambda s: round_literal(s, n))} END)"


def round_decimals(text: str, n: int = 2) -> str:
    return substitute(text, NUMBER_DECIMAL, lambda s: round_literal(s, n))


def _priority(e: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in ATTRIBUTE_PRIORITY.items())
    return f"(CASE {e} {whens} ELSE {OTHER_PRIORITY} END)"


def sort_attributes(text: str) -> str:
    """X3 in one expression: every tag rebuilt with sorted ``k="v"`` attributes."""
    pieces = f"string_split_regex({text}, {q(TAG)})"
    names = f"regexp_extract_all({text}, {q(TAG)}, 1)"
    attrs = f"regexp_extract_all({text}, {q(TAG)}, 2)"
    closes = f"regexp_extract_all({text}, {q(TAG)}, 3)"
    an = f"regexp_extract_all(lm_t[2], {q(ATTRIBUTE)}, 1)"
    av = f"regexp_extract_all(lm_t[2], {q(ATTRIBUTE)}, 2)"
    keyed = (f"list_sort(list_transform(range(1, len({an}) + 1), lambda lm_j: "
             f"{{'p': {_priority(f'{an}[lm_j]')}, 'n': {an}[lm_j], 'i': lm_j, 'v': {av}[lm_j]}}))")
    body = f"array_to_string(list_transform({keyed}, lambda lm_a: lm_a.n || '=\"' || lm_a.v || '\"'), ' ')"
    rebuilt = (f"list_transform(list_zip({names}, {attrs}, {closes}), lambda lm_t: "
               f"CASE WHEN len({an}) > 0 THEN '<' || lm_t[1] || ' ' || {body} || lm_t[3] "
               f"ELSE '<' || lm_t[1] || lm_t[3] END)")
    return (f"array_to_string(list_transform(list_zip({pieces}, {rebuilt}), "
            f"lambda lm_z: lm_z[1] || coalesce(lm_z[2], '')), '')")


def collapse_between_tags(e: str) -> str:
    return f"regexp_replace({strip(e)}, {q(f'>{PY_SPACE}+<')}, '><', 'g')"


def collapse_blanks(e: str) -> str:
    return f"regexp_replace({e}, '[ \t]+', ' ', 'g')"


def chat_text(caption: str, svg: str) -> str:
    head = q(f"{IM_START}user\n{INSTRUCTION}")
    mid = q(f"{IM_END}\n{IM_START}assistant\n")
    return f"({head} || {caption} || {mid} || {svg} || {q(IM_END)})"


def json_string(e: str) -> str:
    """A text as a JSON string in ASCII, the way Python's ``dumps`` writes it."""
    code = "unicode(lm_c)"
    unit = lambda x: f"'\\u' || lpad(lower(to_hex({x})), 4, '0')"
    pair = f"{unit(f'55296 + (({code} - 65536) >> 10)')} || {unit(f'56320 + (({code} - 65536) & 1023)')}"
    return (f"array_to_string(list_transform(regexp_extract_all(CAST(to_json({e}) AS VARCHAR), '(?s).'), lambda lm_c: "
            f"CASE WHEN {code} < 127 THEN lm_c WHEN {code} < 65536 THEN {unit(code)} ELSE {pair} END), '')")


# --- derived fixtures (FIXTURES.md C), same rules as loomkit.sources.fixtures ---

SVGS = """svgs AS (
  SELECT p_partkey AS svg_key,
    '<svg width="' || CAST(p_size AS VARCHAR) || '" id="p' || CAST(p_partkey AS VARCHAR)
    || '" viewBox="0 0 ' || CAST(p_size AS VARCHAR) || ' ' || CAST(p_size AS VARCHAR)
    || '"><path fill="#1e5f5f" d="M' || CAST(CAST(p_retailprice AS DECIMAL(12,4)) AS VARCHAR)
    || '-0.001 2.675"  stroke="#000000"/></svg>' AS svg
  FROM part)"""

LINES = SVGS + """,
docs AS (
  SELECT d.doc_id, d.text AS caption, d.source, s.svg
  FROM documents d LEFT JOIN svgs s ON s.svg_key = d.doc_id % (SELECT greatest(count(*), 1) FROM part)),
lines AS (
  SELECT doc_id, CASE
    WHEN doc_id % 11 = 0 THEN ''
    WHEN doc_id % 13 = 0 THEN substring(CAST(to_json({'caption': caption, 'svg': svg, 'source': source}) AS VARCHAR), 1, 20)
    WHEN doc_id % 17 = 0 THEN CAST(to_json({'caption': NULL::VARCHAR, 'svg': svg, 'source': source}) AS VARCHAR)
    WHEN doc_id % 19 = 0 THEN CAST(to_json({'caption': caption, 'source': source}) AS VARCHAR)
    WHEN doc_id % 23 = 0 THEN CAST(to_json({'caption': caption, 'svg': doc_id, 'source': source}) AS VARCHAR)
    ELSE CAST(to_json({'caption': caption, 'svg': svg, 'source': source}) AS VARCHAR) END AS line
  FROM docs)"""


def parsed_cte(src: str = "lines") -> str:
    """Parse columns of the JSONL lines: validity, kind and field types."""
    first = "substring(regexp_replace(line, '^[ \t\n\r]*', ''), 1, 1)"
    return f"""v AS (
  SELECT doc_id, line, json_valid(line) AS valid, CASE WHEN json_valid(line) THEN line END AS vline
  FROM {src} WHERE NOT {is_blank('line')}),
parsed AS (
  SELECT doc_id, line, valid,
    CASE WHEN NOT valid THEN NULL WHEN {first} = '{{' THEN 'object' WHEN {first} = '[' THEN 'array'
         WHEN {first} = '"' THEN 'string' WHEN {first} = 'n' THEN 'null' WHEN {first} IN ('t', 'f') THEN 'boolean'
         ELSE 'number' END AS kind,
    CASE WHEN json_type(vline, '$.caption') IS NULL THEN 'missing' WHEN json_type(vline, '$.caption') = 'NULL' THEN 'null'
         WHEN json_type(vline, '$.caption') = 'VARCHAR' THEN 'string' ELSE 'other' END AS caption_type,
    CASE WHEN json_type(vline, '$.svg') IS NULL THEN 'missing' WHEN json_type(vline, '$.svg') = 'NULL' THEN 'null'
         WHEN json_type(vline, '$.svg') = 'VARCHAR' THEN 'string' ELSE 'other' END AS svg_type,
    json_extract_string(vline, '$.caption') AS j_caption,
    json_extract_string(vline, '$.svg') AS j_svg,
    json_extract_string(vline, '$.source') AS j_source
  FROM v)"""


TRAINER = LINES + ",\n" + parsed_cte() + f""",
trainer AS (
  SELECT doc_id, {strip('j_caption')} AS caption, {strip('j_svg')} AS svg, j_source AS source
  FROM parsed
  WHERE valid AND kind = 'object' AND caption_type = 'string' AND svg_type = 'string'
    AND {strip('j_caption')} <> '' AND {strip('j_svg')} <> '')"""
