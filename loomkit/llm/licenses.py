"""License notices: phrase places and an exact set-similarity join against templates.

Only DataFrame functions.  A text block is a line; its set is its distinct words.  With
``wrapped``, runs of adjacent lines are blocks too, so a hard-wrapped notice matches: around
every line break the words that a notice of the longest template's size can reach.  A
template matches a block when at least ``threshold`` of the template's distinct words are
in the block.  Words are ordered by their number of blocks over the whole table, rarest
first.  A block and a template that share ``need`` words share one among the first
``size - need + 1`` of each (prefix filter); a block holds at least ``need`` template words
(length filter); and enough words must be left behind the shared one (positional filter).
Pairs that remain are verified on the full sets.  Words that no template has cannot
count, so blocks carry template words only.

The template table is a parameter: its words are literals of the plan, and what reaches the
driver is one count per template word.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loomkit.functions.markup import let
from loomkit.session import cut_lineage

#: everything that is not a word character after lower-casing A-Z
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9
#: bound of the template table: distinct words over all templates
MAX_WORDS = 20_000

# Phrases of the contract and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Short public notices, one label each.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    need: int


def templates(table=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    out = []
    for i, (label, text) in enumerate(table):
        own = tuple(dict.fromkeys(w for w in re.split(BREAK, text.lower()) if w))
        if own:
            out.append(Template(i, label, own, max(1, math.ceil(threshold * len(own) - 1e-9))))
    if sum(len(t.words) for t in out) > MAX_WORDS:
        raise ValueError(f"the template table has more than {MAX_WORDS} words")
    return out


def spaced(text: Column) -> Column:
    """`` w1 w2 .. `` with a blank around every word; one blank when there is none."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BREAK, " ")
    return F.concat(F.lit(" "), F.btrim(plain), F.lit(" "))


def _blanks(s: Column) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")


def phrase_places(s: Column, phrase: str) -> Column:
    """Number, first and last start (in words) of a phrase in a ``spaced`` text."""
    size = phrase.count(" ") + 1

    def of(parts: Column) -> Column:
        n = (F.size(parts) - 1).cast("long")
        return F.struct(n.alias("n"), F.when(n > 0, _blanks(parts[0])).alias("first"),
                        F.when(n > 0, _blanks(s) - _blanks(F.element_at(parts, -1)) - size).alias("last"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"),
                    F.lit(None).cast("long").alias("last"))
    return F.when(F.contains(s, F.lit(f" {phrase} ")), let(F.split(s, f" {phrase}(?= )", -1), of)).otherwise(none)


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def block_words(text: Column, vocabulary: list[str]) -> Column:
    """Of every line its distinct words among ``vocabulary``, in that order."""
    v = _literal(vocabulary)
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda line: F.array_intersect(v, F.split(spaced(line), " ")))


def run_words(text: Column, vocabulary: list[str], span: int) -> Column:
    """``(line, own)`` of every line break between lines with words: the distinct words among
    ``vocabulary`` of the ``span - 1`` words before it in its line and the ``span - 1`` after it,
    over as many lines as they take."""
    v, most = _literal(vocabulary), max(span - 1, 1)
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line, i: F.struct(
        i.alias("line"), F.split(F.btrim(spaced(line)), " ").alias("words"))), lambda x: x["words"][0] != "")

    def run(all_lines: Column, x: Column, i: Column) -> Column:
        after = F.aggregate(F.slice(all_lines, i + 2, F.lit(most)), F.array().cast("array<string>"), lambda got, y: F.when(
            F.size(got) < most, F.concat(got, F.slice(y["words"], 1, most))).otherwise(got))
        size = F.least(F.size(x["words"]), F.lit(most))
        return F.struct(x["line"].alias("line"), F.array_intersect(
            v, F.concat(F.slice(x["words"], -size, size), F.slice(after, 1, most))).alias("own"))

    return let(lines, lambda w: F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: run(w, x, i)))


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Blocks per template word over the whole table: one row per word reaches the driver."""
    blocks = docs.select(F.explode(block_words(F.col("text").cast("string"), vocabulary)).alias("own"))
    counted = blocks.select(F.explode("own").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def scan_licenses(docs: DataFrame, table=TEMPLATES, threshold: float = THRESHOLD,
                  phrases=PHRASES, wrapped: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)``.

    ``blocks`` lists the matching ``(line, label, containment)``, with ``wrapped`` also those of
    runs of lines, by the line they begin in.  Null and empty texts
    have no words, no labels and score 0.  ``score`` is 1 with a phrase, else the best
    containment.  Repeated rows give one result row each; ties in frequency go by word;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    patterns = templates(table, threshold)
    vocabulary = sorted({w for t in patterns for w in t.words})
    often = word_frequencies(docs, vocabulary)
    ordered = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(ordered)}
    sets = {t.number: sorted(t.words, key=place.__getitem__) for t in patterns}
    prefix = {t.number: sets[t.number][:len(t.words) - t.need + 1] for t in patterns}
    rare = sorted({w for p in prefix.values() for w in p}, key=place.__getitem__)
    least = min((t.need for t in patterns), default=1)

    text = F.col("text").cast("string")
    lines = F.transform(block_words(text, ordered), lambda own, i: F.struct(i.alias("line"), own.alias("own")))
    if wrapped:
        longest = max((len([w for w in re.split(BREAK, t.lower()) if w]) for _, t in table), default=1)
        # a run's words are among the text's: no run matches where the whole text has too few
        enough = let(F.array_intersect(_literal(ordered), F.split(spaced(text), " ")), lambda own: F.exists(
            F.array(*[F.struct(_literal(t.words).alias("words"), F.lit(t.need).alias("need")) for t in patterns]),
            lambda t: F.size(F.array_intersect(t["words"], own)) >= t["need"]))
        runs = run_words(text, ordered, longest)
        lines = F.concat(lines, F.when(enough, runs).otherwise(F.slice(lines, 1, 0)) if patterns else runs)
    wanted = F.filter(lines, lambda b: (F.size(b["own"]) >= least) & F.arrays_overlap(
        F.slice(b["own"], F.lit(1), F.size(b["own"]) - (least - 1)), _literal(rare)))

    def base(s: Column) -> Column:
        return F.struct((_blanks(s) - F.when(s == "  ", 2).otherwise(1)).alias("n_words"),
                        *[phrase_places(s, p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)])

    scanned = docs.select(F.col("doc_id"), let(spaced(text), base).alias("b"), wanted.alias("blocks"))
    scanned = cut_lineage(scanned.withColumn("row", F.monotonically_increasing_id()))

    index = spark.createDataFrame(
        [(w, t.number, t.label, i, t.need, sets[t.number]) for t in patterns
         for i, w in enumerate(prefix[t.number])],
        "word string, template int, label string, place int, need int, words array<string>")
    blocks = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.line", "b.own")
    tokens = blocks.select("row", "line", "own", F.posexplode("own").alias("at", "word"))
    size = F.size("own")
    candidates = tokens.join(index, "word").where(
        (size >= F.col("need")) & (F.col("at") <= size - F.col("need"))
        & (1 + F.least(F.size("words") - F.col("place") - 1, size - F.col("at") - 1) >= F.col("need")))
    matched = (candidates.withColumn("shared", F.size(F.array_intersect("words", "own")))
               .where(F.col("shared") >= F.col("need"))
               .select("row", "line", "label", "template", (F.col("shared") / F.size("words")).alias("containment"))
               .distinct())
    by_row = matched.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"),
        F.array_sort(F.collect_list(F.struct("line", "label", "containment"))).alias("matches"))
    out = scanned.drop("blocks").join(by_row, "row", "left")
    parts = [F.col(f"b.p{i}") for i in range(len(phrases))]
    n_base = sum((p["n"] for p in parts), F.lit(0).cast("long"))
    base_set = F.filter(F.array(*[F.when(p["n"] > 0, F.lit(label)) for p, (_, label) in zip(parts, phrases)]),
                        lambda x: x.isNotNull())
    join = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select(
        "doc_id", F.col("b.n_words").alias("n_words"), n_base.alias("n_base"),
        F.array_min(F.array(*[p["first"] for p in parts])).alias("first_word"),
        F.array_max(F.array(*[p["last"] for p in parts])).alias("last_word"),
        join(base_set).alias("base_labels"), join(F.concat(base_set, found)).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("matches", F.array().cast("array<struct<line:int,label:string,containment:double>>")).alias("blocks"))
