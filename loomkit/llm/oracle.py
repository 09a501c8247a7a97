"""DuckDB SQL of the queries that SQL can express, written from the contracts alone."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP1 = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOW}, '{SPACE_WORD}') AS ws FROM documents),
spot AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM spot),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
c AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
  coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id"""

_STOP = ", ".join(f"'{w}'" for w in (
    "the and of to in a is that it for was on with as be at by this are from or an he which not "
    "der die das und ist den dem des ein eine zu mit von für im auf als auch sich nicht "
    "une un le la les et en que qui dans est pour sur par pas au du de "
    "el los las y del se una con su para al lo como no por").split())
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = rf"""WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, sh) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(0, 5)) AS j) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(trim(x, {_WHITE})) > 0) AS ls FROM w),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct_words,
    CAST(len(list_filter(ws, lambda x: lower(trim(x, '.,;:!?')) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(ws, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 1)) AS BIGINT) AS n_capital_words
  FROM w JOIN l ON l.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.1
    AND (n_words < 50 OR n_stop_words / n_words >= 0.02)
    AND n_distinct_words * sqrt(n_words / 50.0) / n_words >= 0.25
    AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.6)
    AND (n_words < 20 OR n_capital_words / n_words <= 0.5) AS kept,
  n_lines, n_distinct_words, n_stop_words, n_capital_words
FROM f"""

OP6 = rf"""WITH RECURSIVE b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOW}, '{ALNUM_WORD}') AS ws FROM benchmark),
q AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS win
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{ALNUM_WORD}') AS ws FROM documents),
spot AS (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS win
       FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
             FROM d, (SELECT DISTINCT size FROM q) WHERE len(ws) >= size)),
hit AS (SELECT doc_id, i, spot.size, item_id FROM spot JOIN q ON q.win = spot.win AND q.size = spot.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS said
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id),
dw AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
seek AS (SELECT DISTINCT win, size, string_split(win, ' ') AS qs FROM q),
walk(win, size, qs, doc_id, start, p, step) AS (
  SELECT win, size, qs, doc_id, p, p, 1 FROM seek JOIN dw ON dw.w = qs[1]
  UNION
  SELECT win, size, qs, t.doc_id, start, dw.p, step + 1
  FROM (SELECT walk.*, unnest(range(p + 1, start + step + 3)) AS next, qs[step + 1] AS want FROM walk WHERE step < size) t
  JOIN dw ON dw.doc_id = t.doc_id AND dw.p = t.next AND dw.w = t.want),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM (SELECT DISTINCT doc_id, win, size FROM walk WHERE step = size) f
         JOIN q ON q.win = f.win AND q.size = f.size GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.said, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated, CAST(coalesce(near.n, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
LEFT JOIN near ON near.doc_id = d.doc_id"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = rf"""WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOW}, '{TERM}') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all({_LOW}, '{TERM}') AS ws FROM benchmark),
want AS (SELECT item_row, item_id, unnest(list_distinct(ws)) AS term FROM b),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf
       FROM (SELECT row, doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM want) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
scored AS (SELECT item_row, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) //
             (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) AS BIGINT) AS score
           FROM want JOIN tf USING (term) JOIN w USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op1_minhash": OP1, "op5_quality": OP5, "op6_decontamination": OP6,
                              "op12_lexical_search": OP12}
