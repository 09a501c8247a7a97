"""Findings of the round: the scan of lines, merges of a word, samples of the trainer."""

import random
import re
from collections import Counter

from loomkit.functions import json_text as J
from loomkit.operators import bpe
from loomkit.operators import tokens as T
from loomkit.sources.jsonl import kept, parse, read_jsonl


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_cut_once_and_never_translated_whole(spark):
    lines = spark.createDataFrame([(1, '{"caption": "a", "svg": "b"}')], "doc_id int, line string")
    plan = _plan(parse(lines))
    assert plan.count(J.STRING[:8]) == 2                      # pieces and strings
    assert not re.search(r"translate\(line#", plan)
    assert not re.search(r"RLIKE\(line#\d+, \[\\x00", plan, re.I)


def test_control_characters_and_leading_space(spark):
    texts = ['{"caption": "a", "svg": "b"}', '\t {"caption": "a", "svg": "b"}', '{"caption": "a\x01", "svg": "b"}',
             '{"caption"\x01: "a", "svg": "b"}', '\x01', '{\x01:\x01}', '\x1c\x1d', '　', '', '"svg', None]
    lines = spark.createDataFrame(list(enumerate(texts)), "i int, line string")
    got = {r["i"]: r["reject"] for r in read_jsonl(lines).collect()}
    assert got == {0: None, 1: None, **{i: "invalid_json" for i in (2, 3, 4, 5, 9)}}
    assert sorted(r["i"] for r in kept(read_jsonl(lines)).collect()) == [0, 1]


def test_an_index_changes_as_a_count_of_all_pairs_does():
    """One merge after another, against words counted anew."""
    draw = random.Random(4)
    words = [[draw.choice("aab") for _ in range(draw.randint(1, 9))] for _ in range(60)]
    counts = [draw.randint(1, 5) for _ in words]
    index = bpe.PairIndex(words, counts)

    def counted(rows):
        total = Counter()
        for s, n in zip(rows, counts):
            for pair in zip(s, s[1:]):
                total[pair] += n
        return total
    for _ in range(25):
        before = counted(words)
        assert index.total == before
        if not before:
            break
        a, b = draw.choice(sorted(before))
        words = [bpe.merge_list(s, a, b) for s in words]
        after = counted(words)
        change = {p: after[p] - before[p] for p in {*before, *after} if after[p] != before[p]}
        assert index.merge(a, b) == change
        assert index.symbols == words
        assert all(held == {w for w, s in enumerate(words) if p in zip(s, s[1:])} for p, held in index.words.items())


def test_a_rewrite_touches_the_pairs_beside_it_alone():
    """A long word with one merge: no pair but those beside it is looked at."""
    class Watched(dict):
        seen = set()

        def __getitem__(self, pair):
            self.seen.add(pair)
            return super().__getitem__(pair)

        def __missing__(self, pair):
            self[pair] = set()
            return super().__getitem__(pair)
    index = bpe.PairIndex([list("abcdefgh")], [3])
    index.words = Watched(index.words)
    assert index.merge("d", "e") == {("d", "e"): -3, ("c", "d"): -3, ("c", "de"): 3, ("e", "f"): -3, ("de", "f"): 3}
    assert Watched.seen == {("c", "d"), ("c", "de"), ("e", "f"), ("de", "f")}


def test_a_sample_of_every_word_is_drawn_once(spark, monkeypatch):
    """Rewriting the words draws no new sample where the first holds them all; one that lacks words is drawn anew.
    The merges are the same."""
    draw = random.Random(6)
    rows = [("".join(draw.choices("abcd", k=draw.randint(1, 8))), draw.randint(1, 9)) for _ in range(80)]
    hist = spark.createDataFrame(sorted(dict(rows).items()), "word string, n bigint")
    drawn = []
    sampled = bpe._sampled
    monkeypatch.setattr(bpe, "_sampled", lambda *a: drawn.append(1) or sampled(*a))
    got = {}
    for sample in (1000, 20):
        drawn.clear()
        got[sample] = [tuple(r) for r in T.train_bpe(hist, 12, steps=4, sample=sample)[0].orderBy("rank").collect()]
        assert (len(drawn) == 1) == (sample == 1000)
    assert len(got[1000]) == 12 and got[1000] == got[20]
