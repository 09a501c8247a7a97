"""Tokens: pre-tokenising, special tokens, histograms, byte-pair merges, vocabulary
and encoding (T1-T4, T8-T10, A2, A4, A5, A9, L1, L2, L8, F7, U2, J3, J4).

Byte-pair training works on ``words(word, n, symbols)``, one row per *distinct*
word, never on the raw corpus; ``operators/bpe`` keeps the pair counts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.operators import bpe
from loomkit.session import cut_lineage

# Unicode White_Space (the pre-tokenizer's \s).
UNI_SPACE = r"\t\n\x{0b}\x{0c}\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD_CLASS = r"\p{L}\p{M}\p{N}_"
PRETOKEN = f"[{WORD_CLASS}]+|[^{WORD_CLASS}{UNI_SPACE}]+"
SPACES = " \t\n\x0b\f\r"  # what stretches of text are counted between; Java's \s, far quicker than a class of all white space
STRETCH = r"\S++"
CHAR = r"(?s)."
ANY_CHAR = r"\x{0}-\x{10ffff}"

# Special tokens of vocabulary training (29) and of the trainer (26).
UNK = "<unk>"
BPE_SPECIALS = ["<unk>", "<|im_start|>", "<|im_end|>",
                "<svg", "</svg>", "<path", "/>", "<g>", "</g>", "<rect",
                "d=", "fill=", "stroke=", "viewBox=", "transform=",
                "M", "L", "C", "S", "Q", "T", "Z", "m", "l", "c", "s", "q", "t", "z"]
TRAINER_TOKENS = ["<svg>", "</svg>", "<path", "/>", "<g>", "</g>", "<rect",
                  "d=", "fill=", "stroke=", "viewBox=", "transform=",
                  "M", "L", "C", "S", "Q", "T", "Z",
                  "m", "l", "c", "s", "q", "t", "z"]
VOCAB_SIZES = {"chat": 16384, "svg": 3000, "default": 2000}
MIN_TOKEN_CHARS = {"chat": 1, "svg": 2}   # kept when len(token) > k
MAX_VOCAB = 2_000_000                    # tokens that may travel to every worker (code points: 1.1 million)


def pretokenize(text: Column) -> Column:
    """Runs of word characters, or runs of other non-space characters."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN), 0)


def _special_alternation(specials: list[str]) -> str:
    return "|".join(re.escape(s) for s in sorted(set(specials), key=lambda s: (-len(s), s)))


def _one_special(specials: list[str]) -> str:
    """``_special_alternation``, tried only where a special token can begin; those of one character as a class."""
    longer, single, firsts = _by_length(specials)
    either = "|".join(p for p in (_special_alternation(longer) if longer else "", single) if p)
    return f"(?=[{firsts}])(?:{either})"


def _by_length(specials: list[str]) -> tuple[list[str], str, str]:
    """Specials of several characters, the class of the others, the class body of all first characters."""
    single = "".join(sorted({re.escape(s) for s in specials if len(s) == 1}))
    return ([s for s in specials if len(s) > 1], f"[{single}]" if single else "",
            "".join(sorted({re.escape(s[0]) for s in specials})))


def _between_specials(specials: list[str], chars: str) -> str:
    """A run of ``chars`` (a class body) that ends before the next special token."""
    longer, single, firsts = _by_length(specials)
    ends = "|".join(p for p in (single, _special_alternation(longer) if longer else "") if p)
    return f"(?:[[{chars}]&&[^{firsts}]]++|(?!{ends})[{chars}])++"


def special_split(text: Column, specials: list[str]) -> Column:
    """``array<struct<special: boolean, piece: string>>`` in text order; special
    tokens are matched longest first and kept atomic."""
    piece = f"{_one_special(specials)}|{_between_specials(specials, ANY_CHAR)}"
    # a piece between special tokens holds none, so it equals none
    return F.transform(F.regexp_extract_all(text, F.lit(piece), 0),
                       lambda p: F.struct(p.isin(*specials).alias("special"), p.alias("piece")))


def pretokenize_with_specials(text: Column, specials: list[str]) -> Column:
    """T3 + T1: specials stay whole, the text between them is pre-tokenised, in one pass."""
    runs = [_between_specials(specials, c) for c in (WORD_CLASS, f"^{WORD_CLASS}{UNI_SPACE}")]
    return F.regexp_extract_all(text, F.lit("|".join([_one_special(specials), *runs])), 0)


def word_histogram(df: DataFrame, text_col: str, specials: list[str] | None = None) -> DataFrame:
    """A4: ``(word, n)``; partial aggregation before the shuffle absorbs hot words.

    Without white space in a special token no word reaches over it, so texts are counted by their stretches
    between (ASCII) white space first, and each distinct stretch is cut at special tokens once."""
    if not specials:
        words = df.select(F.explode(pretokenize(F.col(text_col))).alias("word"))
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if any(c in SPACES for s in specials for c in s):
        toks = pretokenize_with_specials(F.col(text_col), specials)
        return df.select(F.explode(toks).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    stretches = df.select(F.explode(F.regexp_extract_all(text_col, F.lit(STRETCH), 0)).alias("stretch"))
    counted = stretches.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))
    # explode_outer: of a plain explode a filter would be inferred and pushed below the count of the stretches
    words = counted.select(F.explode_outer(pretokenize_with_specials(F.col("stretch"), specials)).alias("word"), "n")
    return words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))


def initial_words(hist: DataFrame, specials: list[str] | None = None) -> DataFrame:
    """``words(word, n, symbols)``: code points as the first symbols; specials stay atomic."""
    sym = F.regexp_extract_all(F.col("word"), F.lit(CHAR), 0)
    if specials:
        sym = F.when(F.col("word").isin(*specials), F.array(F.col("word"))).otherwise(sym)
    return hist.select("word", "n", sym.alias("symbols"))


def adjacent_pairs(words: DataFrame, keep: list[str]) -> DataFrame:
    """Adjacent symbol pairs ``(keep..., a, b)``: a position explode followed by a
    plain projection, so the pair building stays in generated code."""
    # posexplode_outer: a plain explode lets the optimizer infer size(symbols) > 0
    # and push it below the word aggregation, where it would run the symbol
    # regex once per word occurrence instead of once per distinct word
    pos = words.select(*keep, "symbols", F.posexplode_outer("symbols").alias("i", "a"))
    pairs = pos.select(*keep, "a", F.try_element_at("symbols", F.col("i") + 2).alias("b"))
    return pairs.where(F.col("b").isNotNull())


def pair_counts(words: DataFrame) -> DataFrame:
    """A5: adjacent symbol pairs weighted by the word count: ``(a, b, c)``."""
    return adjacent_pairs(words, ["n"]).groupBy("a", "b").agg(F.sum("n").alias("c"))


def top_pairs(counts: DataFrame, k: int = 1) -> DataFrame:
    """The most frequent pairs; ties by (a, b) ascending (our tie rule)."""
    return counts.orderBy(F.desc("c"), "a", "b").limit(k)


def train_bpe(hist: DataFrame, n_merges: int | None, specials: list[str] | None = None,
              vocab_size: int | None = None, steps: int = bpe.STEPS,
              sample: int = bpe.SAMPLE) -> tuple[DataFrame, DataFrame]:
    """Byte-pair training over the distinct-word table.

    Returns ``(merges(rank, a, b, token, c), words)``: always the most frequent pair of the
    whole corpus, ties by (a, b). Training ends after ``n_merges``, or when base symbols,
    specials and merged texts reach ``vocab_size``, or when no pair is left. ``steps`` and
    ``sample`` (see ``operators/bpe``) decide how many merges one job carries, never which.
    """
    spark = hist.sparkSession
    words = cut_lineage(initial_words(hist, specials))
    room, known = None, set(specials or [])
    if vocab_size is not None:
        base = {r["token"] for r in base_vocab(words, specials or []).collect()}  # bounded by the alphabet
        room, known = max(vocab_size - len(base), 0), base
    elif n_merges is None:
        raise ValueError("n_merges or vocab_size is needed")
    found, words = bpe.train(words, 2**31 - 1 if n_merges is None else n_merges, known, room, steps, sample)
    rows = [(i, a, b, a + b, int(c)) for i, (a, b, c) in enumerate(found)]
    return spark.createDataFrame(rows, "rank int, a string, b string, token string, c bigint"), words


def base_vocab(words: DataFrame, specials: list[str]) -> DataFrame:
    """Specials first (list order), then every symbol character by code point."""
    spark = words.sparkSession
    chars = (words.select(F.explode(F.regexp_extract_all(F.col("word"), F.lit(CHAR), 0)).alias("token"))
             .where(~F.col("token").isin(*specials)).distinct())
    sp = spark.createDataFrame([(i, s) for i, s in enumerate(specials)], "id int, token string")
    n = len(specials)
    # One row per distinct character: the window is bounded by the alphabet.
    ranked = chars.select("token", (F.row_number().over(Window.orderBy("token")) - 1 + n).cast("int").alias("id"))
    return sp.unionByName(ranked.select("id", "token"))


def vocab_from_merges(base: DataFrame, merges: DataFrame, vocab_size: int) -> DataFrame:
    """Vocabulary = base + merge tokens in merge order, capped at ``vocab_size``."""
    n_base = base.count()
    # two merges may give one text; it has one id, that of the first
    new = (merges.groupBy("token").agg(F.min("rank").alias("rank"))
           .join(base.select("token"), "token", "left_anti"))
    ranked = new.select("token", (F.row_number().over(Window.orderBy("rank")) - 1 + n_base).cast("int").alias("id"))
    return base.unionByName(ranked.select("id", "token")).where(F.col("id") < vocab_size)


def long_tokens(vocab: DataFrame, min_chars: int) -> DataFrame:
    """F7 + L1: tokens longer than ``min_chars`` characters, in id order."""
    return vocab.where(F.char_length("token") > min_chars).orderBy("id")


def last_tokens(vocab: DataFrame, n: int = 50) -> DataFrame:
    """L2: the last ``n`` tokens by id."""
    return vocab.orderBy(F.desc("id")).limit(n)


def vocab_union(base: DataFrame, added: DataFrame) -> DataFrame:
    """U2 + J4: tokens not already known get ids after the base, in list order.

    ``added`` is ``(pos, token)``. Duplicates inside the list keep the first.
    """
    n_base = base.agg(F.max("id")).first()[0] + 1
    first = added.groupBy("token").agg(F.min("pos").alias("pos"))
    fresh = first.join(base.select("token"), "token", "left_anti")
    ranked = fresh.select("token", (F.row_number().over(Window.orderBy("pos")) - 1 + n_base).cast("int").alias("id"))
    return base.unionByName(ranked.select("id", "token"))


def merge_ranks(merges: DataFrame) -> dict[bpe.Pair, int]:
    """Rank of every merge; bounded by the vocabulary."""
    return {(r["a"], r["b"]): r["rank"] for r in merges.select("a", "b", "rank").collect()}


def vocab_ids(vocab: DataFrame) -> dict[str, int]:
    """Id of every token. A vocabulary beyond ``MAX_VOCAB`` rows is refused, as it travels to every worker."""
    rows = vocab.select("token", "id").limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"more than {MAX_VOCAB} tokens")
    return {r["token"]: r["id"] for r in rows}


def compression(before: Column, after: Column) -> Column:
    """Token count before / after."""
    return before.cast("double") / F.greatest(after, F.lit(1)).cast("double")


def encode_documents(docs: DataFrame, key: str, text_col: str, vocab: DataFrame,
                     merges: DataFrame | None = None, specials: list[str] | None = None,
                     unk_id: int = 0, max_tokens: int | None = None) -> DataFrame:
    """T4 + J3 + T8: ``(key, input_ids, n_ids, id_sum)`` for every document, in one narrow stage.

    Pre-tokens come from the JVM; merges and the vocabulary, bounded by its size, travel
    to the workers, which look words up inside the row. With ``max_tokens`` (T5) the ids
    are cut, ``n_ids`` and ``id_sum`` still cover the whole text. A document without a token
    keeps its row with no ids.
    """
    toks = (pretokenize_with_specials(F.col(text_col), specials) if specials
            else pretokenize(F.col(text_col)))
    ranks = merge_ranks(merges) if merges is not None else {}
    return bpe.encode(docs, key, toks, vocab_ids(vocab), ranks, set(specials or []), unk_id, max_tokens)
