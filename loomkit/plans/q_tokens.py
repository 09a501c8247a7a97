"""Queries for the vocabulary stage: histograms, pairs, merges, vocabulary ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomkit.functions import chat
from loomkit.operators import tokens as T
from loomkit.plans import duck as D
from loomkit.plans.q_records import record_lines
from loomkit.plans.q_split import _CHAR_IDS
from loomkit.plans.registry import register
from loomkit.sources.jsonl import kept, read_jsonl, vocab_json
from loomkit.session import cut_lineage
from loomkit.sources.tables import table

_DOC_WORDS = f"""words AS (SELECT unnest(regexp_extract_all(text, {D.q(T.PRETOKEN)})) AS word FROM documents),
hist AS (SELECT word, count(*) AS n FROM words GROUP BY word)"""

_PAIRS = _DOC_WORDS + """,
syms AS (SELECT word, n, regexp_extract_all(word, '(?s).') AS s FROM hist),
pairs AS (
  SELECT s[i] AS a, s[i + 1] AS b, n FROM (SELECT s, n, unnest(range(1, len(s))) AS i FROM syms WHERE len(s) > 1)),
pc AS (SELECT a, b, sum(n) AS c FROM pairs GROUP BY a, b)"""


def _doc_hist(spark, sf):
    return T.word_histogram(table(spark, sf, "documents"), "text")


@register("word_histogram", "WITH " + _DOC_WORDS + "\nSELECT word, n FROM hist")
def word_histogram(spark, sf):
    """A4 + T1: pre-token histogram of every document."""
    return _doc_hist(spark, sf)


@register("pair_counts", "WITH " + _PAIRS + "\nSELECT a, b, CAST(c AS BIGINT) AS c FROM pc")
def pair_counts(spark, sf):
    """A5: adjacent character pairs weighted by word counts."""
    return T.pair_counts(T.initial_words(_doc_hist(spark, sf)))


@register("top_pair", "WITH " + _PAIRS + "\nSELECT a, b, CAST(c AS BIGINT) AS c FROM pc ORDER BY c DESC, a, b LIMIT 10")
def top_pair(spark, sf):
    """The ten most frequent pairs (the first is the first merge)."""
    return T.top_pairs(T.pair_counts(T.initial_words(_doc_hist(spark, sf))), 10)


def chat_corpus(spark, sf):
    """The vocabulary trainer's corpus: chat text of every parsable object line."""
    rows = kept(read_jsonl(record_lines(spark, sf), "bpe"))
    return rows.select("doc_id", chat.chat_text(F.col("caption"), F.col("svg")).alias("text"))


def svg_corpus(spark, sf):
    """The token analysis corpus: the ``svg`` value of lines that have one."""
    return kept(read_jsonl(record_lines(spark, sf), "tokens")).select("doc_id", F.col("svg").alias("text"))


_ALT = T._special_alternation(T.BPE_SPECIALS)
_SPECIAL_SQL = "WITH " + D.LINES + ",\n" + D.parsed_cte() + f""",
c AS (SELECT doc_id, {D.chat_text(
    "CASE caption_type WHEN 'missing' THEN '' WHEN 'null' THEN 'None' ELSE j_caption END",
    "CASE svg_type WHEN 'missing' THEN '' WHEN 'null' THEN 'None' ELSE j_svg END")} AS text
  FROM parsed WHERE valid AND kind = 'object')
SELECT doc_id, CAST(len(regexp_extract_all(text, {D.q(_ALT)})) AS INTEGER) AS n_special,
  CAST(len(regexp_extract_all(regexp_replace(text, {D.q(_ALT)}, ' ', 'g'), {D.q(T.PRETOKEN)})) AS INTEGER) AS n_plain
FROM c"""


@register("special_split", _SPECIAL_SQL)
def special_split(spark, sf):
    """Special tokens kept whole (longest first), the rest pre-tokenised."""
    corpus = chat_corpus(spark, sf)
    parts = T.special_split(F.col("text"), T.BPE_SPECIALS)
    plain = F.flatten(F.transform(F.filter(parts, lambda p: ~p["special"]), lambda p: T.pretokenize(p["piece"])))
    return corpus.select("doc_id", F.size(F.filter(parts, lambda p: p["special"])).alias("n_special"),
                         F.size(plain).alias("n_plain"))


def _trained(spark, sf, job="chat"):
    """Merges, vocabulary and encoded word table, to the job's vocabulary size."""
    corpus, specials = (chat_corpus, T.BPE_SPECIALS) if job == "chat" else (svg_corpus, [T.UNK])
    hist = T.word_histogram(corpus(spark, sf), "text", T.BPE_SPECIALS if job == "chat" else None)
    merges, words = T.train_bpe(cut_lineage(hist), None, specials, vocab_size=T.VOCAB_SIZES[job])
    base = T.base_vocab(words, specials)
    return merges, cut_lineage(T.vocab_from_merges(base, merges, T.VOCAB_SIZES[job])), words


@register("train_bpe")
def train_bpe(spark, sf):
    """Byte-pair merges over the chat corpus up to 16,384 tokens."""
    return _trained(spark, sf)[0]


@register("train_bpe_svg")
def train_bpe_svg(spark, sf):
    """T2 + T9: the token analysis job, byte-pair merges over the markup alone up to 3,000 tokens."""
    return _trained(spark, sf, "svg")[0]


def _unrolled_sql(n):
    """The first ``n`` merges, each as a few common table expressions: count, top pair, rewrite."""
    mark = "chr(31)"
    sql = ["WITH " + _DOC_WORDS + f""",
w0 AS (SELECT n, {mark} || array_to_string(regexp_extract_all(word, '(?s).'), {mark}) || {mark} AS s FROM hist)"""]
    for i in range(n):
        # a doubled mark between symbols lets one left-to-right replace see every pair
        sql.append(f"""l{i} AS (SELECT n, string_split(s[2:-2], {mark}) AS y FROM w{i}),
p{i} AS (SELECT y[i] AS a, y[i + 1] AS b, CAST(sum(n) AS BIGINT) AS c
  FROM (SELECT y, n, unnest(range(1, len(y))) AS i FROM l{i} WHERE len(y) > 1) GROUP BY ALL),
t{i} AS MATERIALIZED (SELECT a, b, c FROM p{i} ORDER BY c DESC, a, b LIMIT 1),
w{i + 1} AS MATERIALIZED (SELECT n, replace(replace(replace(s, {mark}, {mark} || {mark}),
  {mark} || a || {mark} || {mark} || b || {mark}, {mark} || a || b || {mark}), {mark} || {mark}, {mark}) AS s FROM w{i}, t{i})""")
    rows = "\nUNION ALL ".join(f"SELECT {i} AS rank, a, b, a || b AS token, c FROM t{i}" for i in range(n))
    return ",\n".join(sql) + "\n" + rows


FIRST_MERGES = 6


@register("first_merges", _unrolled_sql(FIRST_MERGES))
def first_merges(spark, sf):
    """The first six merges over the document words (a top-k report of the trainer)."""
    return T.train_bpe(cut_lineage(_doc_hist(spark, sf)), FIRST_MERGES)[0]


@register("vocab_filter_sort")
def vocab_filter_sort(spark, sf):
    """T9 = F7 + L1: learned tokens longer than one character, by id."""
    _, vocab, _ = _trained(spark, sf)
    return T.long_tokens(vocab, T.MIN_TOKEN_CHARS["chat"])


@register("vocab_export")
def vocab_export(spark, sf):
    """K3 + T9: the filtered vocabularies of both jobs, each as one JSON array in id order."""
    out = None
    for job in ("chat", "svg"):
        _, vocab, _ = _trained(spark, sf, job)
        one = vocab_json(T.long_tokens(vocab, T.MIN_TOKEN_CHARS[job])).select(F.lit(job).alias("job"), "value")
        out = one if out is None else out.unionByName(one)
    return out


@register("vocab_last_50")
def vocab_last_50(spark, sf):
    """L2: the last 50 of the markup job's tokens that pass its length filter, by id."""
    _, vocab, _ = _trained(spark, sf, "svg")
    return T.last_tokens(T.long_tokens(vocab, T.MIN_TOKEN_CHARS["svg"]), 50)


@register("compression_ratio")
def compression_ratio(spark, sf):
    """Tokens per row before and after the learned merges."""
    merges, vocab, _ = _trained(spark, sf)
    corpus = chat_corpus(spark, sf)
    before = T.encode_documents(corpus, "doc_id", "text", vocab, specials=T.BPE_SPECIALS)
    after = T.encode_documents(corpus, "doc_id", "text", vocab, merges, T.BPE_SPECIALS)
    both = before.select("doc_id", F.col("n_ids").alias("n_before")).join(
        after.select("doc_id", F.col("n_ids").alias("n_after")), "doc_id")
    return both.withColumn("ratio", F.round(T.compression(F.col("n_before"), F.col("n_after")), 6))


@register("encode_bpe")
def encode_bpe(spark, sf):
    """T4 + T8: whole documents through the markup vocabulary and its merges. Characters that
    never occur in markup are unknown to it."""
    merges, vocab, _ = _trained(spark, sf, "svg")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    enc = T.encode_documents(docs, "doc_id", "text", vocab, merges)
    return enc.select("doc_id", "n_ids", F.size(F.filter("input_ids", lambda i: i == 0)).alias("n_unknown"),
                      F.array_join("input_ids", " ").alias("ids"))


_ADDED = "added(pos, token) AS (VALUES " + ", ".join(f"({i}, {D.q(t)})" for i, t in enumerate(T.TRAINER_TOKENS)) + ")"

_UNION_SQL = "WITH " + _CHAR_IDS + ",\n" + _ADDED + """,
fresh AS (SELECT token, min(pos) AS pos FROM added WHERE token NOT IN (SELECT token FROM vocab) GROUP BY token)
SELECT id, token FROM vocab
UNION ALL
SELECT CAST((SELECT max(id) + 1 FROM vocab) + row_number() OVER (ORDER BY pos) - 1 AS INTEGER), token FROM fresh"""


def _char_vocab(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return T.base_vocab(T.initial_words(T.word_histogram(docs, "text")), T.BPE_SPECIALS)


def _added(spark):
    return spark.createDataFrame(list(enumerate(T.TRAINER_TOKENS)), "pos int, token string")


@register("vocab_union", _UNION_SQL)
def vocab_union(spark, sf):
    """The trainer's tokens added to a base vocabulary; known tokens keep their id."""
    return T.vocab_union(_char_vocab(spark, sf), _added(spark))


_ADDED_SQL = "WITH " + _CHAR_IDS + ",\n" + _ADDED + """
SELECT (SELECT count(*) FROM vocab) AS n_base, (SELECT count(*) FROM added) AS n_list,
  (SELECT count(DISTINCT token) FROM added WHERE token NOT IN (SELECT token FROM vocab)) AS n_added,
  (SELECT count(*) FROM vocab) + (SELECT count(DISTINCT token) FROM added WHERE token NOT IN (SELECT token FROM vocab)) AS n_final"""


@register("vocab_added_count", _ADDED_SQL)
def vocab_added_count(spark, sf):
    """J4 + A2: how many listed tokens are really new, and the final size."""
    base = _char_vocab(spark, sf)
    added = _added(spark)
    fresh = added.select("token").distinct().join(base.select("token"), "token", "left_anti")
    tagged = (base.select(F.lit("base").alias("k")).unionByName(added.select(F.lit("list").alias("k")))
              .unionByName(fresh.select(F.lit("added").alias("k"))))
    n = lambda k: F.sum(F.when(F.col("k") == k, 1).otherwise(0)).cast("bigint")
    out = tagged.agg(n("base").alias("n_base"), n("list").alias("n_list"), n("added").alias("n_added"))
    return out.select("n_base", "n_list", "n_added", (F.col("n_base") + F.col("n_added")).alias("n_final"))
