"""Quality rules: a threshold table compiled into one projection, without user functions.

Measures are column expressions over a document's words and lines; a rule is a row
``(measure, low, high, only from this many words)``.  All rules become one boolean column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loomkit.functions.markup import let

#: white space between words, as a trim set and as a pattern
SPACE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the and of to in a is that it for was on with as be at by this are from or an he which not "
    "der die das und ist den dem des ein eine zu mit von für im auf als auch sich nicht "
    "une un le la les et en que qui dans est pour sur par pas au du de "
    "el los las y del se una con su para al lo como no por"
).split()


@dataclass(frozen=True)
class Rule:
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_share", 0.02, None, from_words=50),
    Rule("distinct_word_share", 0.25, None, from_words=10),
    Rule("dup_line_share", None, 0.6, from_words=10),
    Rule("capital_word_share", None, 0.5, from_words=20),
)


def words(text: Column) -> Column:
    """Array of the words; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def word_lines(text: Column) -> Column:
    """The lines that hold a word, as they stand."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """Words inside ``size``-word windows that occur twice or more, first ones included.

    Windows are compared by 64-bit hash.  Only when some repeat are they sorted with
    their places; the covered words are then counted from the gaps between places.
    """
    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def gaps(p: Column) -> Column:
            nexts = F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(F.element_at(p, -1) + size))
            return F.aggregate(F.zip_with(p, nexts, lambda a, b: F.least(F.lit(size), b - a)),
                               F.lit(0), lambda acc, x: acc + x)

        def places(s: Column) -> Column:
            # a window repeats when a neighbour in hash order is equal
            before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(s, lambda x: x["h"]))
            after = F.concat(F.transform(F.slice(s, F.lit(2), F.size(s)), lambda x: x["h"]),
                             F.array(F.lit(None).cast("bigint")))
            same = F.zip_with(F.zip_with(s, before, lambda x, b: F.when(x.isNotNull(), F.struct(
                x["i"].alias("i"), x["h"].alias("h"), F.coalesce(x["h"] == b, F.lit(False)).alias("e")))),
                after, lambda x, a: F.when(x["e"] | F.coalesce(x["h"] == a, F.lit(False)), x["i"]))
            return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(placed, places), gaps))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)),
                         lambda i: F.xxhash64(*[w[i - 1 + j] for j in range(size)]))
    return F.when(F.size(w) < size + 1, F.lit(0)).otherwise(let(hashes, covered)).cast("long")


def measures(text: Column) -> Column:
    """One struct of every count and ratio of ``text``."""
    safe = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        n = F.size(w).cast("long")
        joined = F.array_join(w, "")
        stop = F.array(*[F.lit(s) for s in STOP_WORDS])
        bare = F.transform(w, lambda x: F.lower(F.btrim(x, F.lit(".,;:!?"))))
        # counted by replacing: hash lookup in a literal set per word
        n_stop = F.size(F.filter(bare, lambda x: x.isin(*STOP_WORDS))) if STOP_WORDS else F.size(stop) * 0
        n_capital = F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.length(x) > 1)))
        return F.struct(
            n.alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
            n_stop.cast("long").alias("n_stop_words"),
            n_capital.cast("long").alias("n_capital_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    symbols = (F.length(safe) - F.length(F.translate(safe, SYMBOLS, ""))).cast("long")
    return F.struct(let(words(text), of_words).alias("w"), let(word_lines(text), of_lines).alias("l"),
                    symbols.alias("n_symbols"))


def _ratio(over: Column, under: Column) -> Column:
    return F.when(under > 0, over / under).otherwise(F.lit(0.0))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one boolean column over the measured columns."""
    value = {
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_word_share": _ratio(F.col("n_stop_words"), F.col("n_words")),
        "distinct_word_share": _ratio(F.col("n_distinct_words") * F.sqrt(F.greatest(F.col("n_words"), F.lit(1)) / 50.0),
                                      F.col("n_words")),
        "dup_line_share": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "capital_word_share": _ratio(F.col("n_capital_words"), F.col("n_words")),
    }
    passed = F.lit(True)
    for rule in rules:
        v = value[rule.measure]
        ok = F.lit(True)
        if rule.low is not None:
            ok = ok & (v >= rule.low)
        if rule.high is not None:
            ok = ok & (v <= rule.high)
        passed = passed & ((F.col("n_words") < rule.from_words) | ok)
    return passed


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document.

    Null, empty and blank texts have no words: base_failed, not kept.  Repeated rows give
    one result row each; an empty table an empty result; other columns are ignored.
    """
    measured = docs.select(F.col("doc_id"), measures(F.col("text").cast("string")).alias("m")).select(
        "doc_id", "m.w.*", "m.l.*", "m.n_symbols")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
        "n_lines", "n_distinct_words", "n_stop_words", "n_capital_words")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of ``docs`` that pass; columns as they came.  One narrow projection, no shuffle."""
    names = [f"`{c}`" for c in docs.columns]
    measured = docs.select(F.struct(*names).alias("__row"), measures(F.col("text").cast("string")).alias("__m")) \
        .select("__row", "__m.w.*", "__m.l.*", "__m.n_symbols")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.where(~failed & verdict(rules)).select("__row.*")
