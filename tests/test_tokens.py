"""Pre-tokens, special tokens, byte-pair merges and encoding against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomkit.operators import bpe
from loomkit.operators import tokens as T
from tests.conftest import SF001


def py_bpe(word_counts, n_merges):
    """Plain-Python model: most frequent pair, ties by (a, b), merged left to right."""
    words = {w: list(w) for w in word_counts}
    merges = []
    for _ in range(n_merges):
        pairs = Counter()
        for w, syms in words.items():
            for a, b in zip(syms, syms[1:]):
                pairs[(a, b)] += word_counts[w]
        if not pairs:
            break
        (a, b), c = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        merges.append((a, b, c))
        for w, syms in words.items():
            out = []
            for s in syms:
                if out and out[-1] == a and s == b:
                    out[-1] = a + b
                else:
                    out.append(s)
            words[w] = out
    return merges, words


def py_encode(word, merges):
    rank = {(a, b): i for i, (a, b, _) in enumerate(merges)}
    syms = list(word)
    while True:
        cands = [(rank[p], p) for p in zip(syms, syms[1:]) if p in rank]
        if not cands:
            return syms
        _, (a, b) = min(cands)
        out = []
        for s in syms:
            if out and out[-1] == a and s == b:
                out[-1] = a + b
            else:
                out.append(s)
        syms = out


TEXT = ["aaa abab ba <path d=\"M10 20\"/> l10", "the then there 1000 100 10", "aa aa aaa bébé naïve"]


def test_pretokenize_and_specials(spark):
    df = spark.createDataFrame([("<path d=\"M1 2\"/> héllo, wörld!!",)], "t string")
    r = df.select(T.pretokenize(F.col("t")).alias("p"),
                  T.pretokenize_with_specials(F.col("t"), T.BPE_SPECIALS).alias("s")).first()
    assert r.p == ["<", "path", "d", "=\"", "M1", "2", "\"/>", "héllo", ",", "wörld", "!!"]
    # single-letter specials (l, c, s, ...) are matched anywhere, inside words too
    assert r.s == ["<path", "d=", "\"", "M", "1", "2", "\"", "/>", "hé", "l", "l", "o", ",", "wör", "l", "d", "!!"]


def test_bpe_matches_loop(spark):
    df = spark.createDataFrame([(t,) for t in TEXT], "text string")
    hist = T.word_histogram(df, "text")
    counts = {r.word: r.n for r in hist.collect()}
    merges, words = T.train_bpe(hist, 8)
    exp_merges, exp_words = py_bpe(counts, 8)
    assert [(r.a, r.b, r.c) for r in merges.orderBy("rank").collect()] == exp_merges
    assert {r.word: r.symbols for r in words.collect()} == exp_words


def test_encoding_matches_loop(spark):
    train = spark.createDataFrame([(t,) for t in TEXT], "text string")
    merges, words = T.train_bpe(T.word_histogram(train, "text"), 6)
    m = [(r.a, r.b, r.c) for r in merges.orderBy("rank").collect()]
    vocab = T.vocab_from_merges(T.base_vocab(words, ["<unk>", "<g>"]), merges, 10_000)
    ids = {r.token: r.id for r in vocab.collect()}
    texts = [(i, t) for i, t in enumerate(TEXT + ["ab<g>aaa zzz ?", "", None, "there" * 2000, "  "])]
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    for specials, cap in ((None, None), (["<g>"], None), (None, 4)):
        got = {r.doc_id: (r.input_ids, r.n_ids, r.id_sum) for r in T.encode_documents(
            docs, "doc_id", "text", vocab, merges, specials, max_tokens=cap).collect()}
        toks = T.pretokenize_with_specials(F.col("text"), specials) if specials else T.pretokenize(F.col("text"))
        split = dict(docs.select("doc_id", toks).collect())
        for i, _ in texts:
            want = [ids.get(s, 0) for w in split[i] or []
                    for s in ([w] if w in (specials or []) else py_encode(w, m))]
            assert got[i] == (want[:cap], len(want), sum(want))
    assert 0 in got[3][0] or cap == 4  # characters that training never saw


def test_vocab_ops(spark):
    df = spark.createDataFrame([(t,) for t in TEXT], "text string")
    hist = T.word_histogram(df, "text")
    merges, words = T.train_bpe(hist, 5)
    base = T.base_vocab(words, ["<unk>"])
    vocab = T.vocab_from_merges(base, merges, 10_000)
    ids = [r.id for r in vocab.orderBy("id").collect()]
    assert ids == list(range(len(ids))) and vocab.where("id = 0").first().token == "<unk>"
    assert all(len(r.token) > 1 for r in T.long_tokens(vocab, 1).collect())
    assert T.last_tokens(vocab, 3).count() == 3
    added = spark.createDataFrame([(0, "aa"), (1, "zz"), (2, "zz"), (3, "<unk>")], "pos int, token string")
    u = T.vocab_union(vocab, added)
    assert u.count() == vocab.count() + (0 if vocab.where("token = 'aa'").count() else 1) + 1
    assert u.where("token = 'zz'").first().id == u.agg(F.max("id")).first()[0]


def random_words(rng):
    return {"".join(rng.choices("abcdef"[:rng.randint(1, 6)], k=rng.randint(1, 9))): rng.randint(1, 4)
            for _ in range(rng.randint(1, 25))}


@pytest.mark.parametrize("seed", range(200))
def test_kept_pair_counts_on_random_corpora(seed):
    """Signed differences keep the index equal to a full count after every merge."""
    rng = random.Random(seed)
    counts = random_words(rng)
    index = bpe.PairIndex([list(w) for w in counts], counts.values())
    for a, b, c in py_bpe(counts, 15)[0]:
        assert index.total[a, b] == c
        index.merge(a, b)
        full = Counter()
        for s, n in zip(index.symbols, index.counts):
            for pair in zip(s, s[1:]):
                full[pair] += n
        assert +index.total == full
        assert all(set(index.words[p]) == {w for w, s in enumerate(index.symbols) if p in set(zip(s, s[1:]))}
                   for p in full)


@pytest.mark.parametrize("seed", range(100))
def test_accepted_merges_are_those_of_single_rounds(seed):
    """Whatever is proposed, only the true next merges are taken, and at least the first if it is right."""
    rng = random.Random(seed)
    counts = random_words(rng)
    true, _ = py_bpe(counts, 12)
    if not true:
        return
    wanted = [(a, b) for a, b, _ in true]
    if rng.random() < .7:
        wanted[rng.randrange(len(wanted))] = ("a", "b")
    index = bpe.PairIndex([list(w) for w in counts], counts.values())
    start, changes = dict(index.total), {}
    for step, (a, b) in enumerate(wanted):
        changes[step] = list(index.merge(a, b).items())
    got, _ = bpe.accepted(wanted, start, changes, 1)
    same = next((i for i, (w, t) in enumerate(zip(wanted, true)) if w != t[:2]), len(true))
    assert got == true[:same]


@pytest.mark.parametrize("steps,sample", [(1, 100), (3, 5), (50, 8), (50, 1000)])
def test_training_is_exact_for_any_sample(spark, steps, sample):
    rng = random.Random(steps * 31 + sample)
    counts = Counter()
    for _ in range(12):
        counts.update(random_words(rng))
    hist = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)
    n = 40 if steps > 1 else 6
    merges, words = T.train_bpe(hist, n, steps=steps, sample=sample)
    want, want_words = py_bpe(counts, n)
    assert [(r.a, r.b, r.c) for r in merges.orderBy("rank").collect()] == want
    assert {r.word: r.symbols for r in words.collect()} == want_words


def test_real_words_by_a_small_sample(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    hist = T.word_histogram(docs, "text")
    counts = {r.word: r.n for r in hist.collect()}
    merges, _ = T.train_bpe(hist, 150, steps=100, sample=300)
    index, want = bpe.PairIndex([list(w) for w in counts], counts.values()), []
    for _ in range(150):
        (a, b), c = min(index.total.items(), key=lambda e: (-e[1], e[0]))
        want.append((a, b, c))
        index.merge(a, b)
    assert [(r.a, r.b, r.c) for r in merges.orderBy("rank").collect()] == want


def test_texts_of_two_merges_have_one_id(spark):
    base = spark.createDataFrame([(0, "<unk>"), (1, "a")], "id int, token string")
    merges = spark.createDataFrame([(0, "a", "b", "ab", 3), (1, "ab", "c", "abc", 2), (2, "a", "bc", "abc", 1),
                                    (3, "x", "y", "xy", 1)], "rank int, a string, b string, token string, c bigint")
    vocab = T.vocab_from_merges(base, merges, 100)
    assert {r.token: r.id for r in vocab.collect()} == {"<unk>": 0, "a": 1, "ab": 2, "abc": 3, "xy": 4}


def test_vocab_size_ends_training(spark):
    df = spark.createDataFrame([(t,) for t in TEXT], "text string")
    hist = T.word_histogram(df, "text")
    n_base = T.base_vocab(T.initial_words(hist), []).count()
    assert T.train_bpe(hist, None, vocab_size=n_base + 3)[0].count() == 3
    assert T.train_bpe(hist, None, vocab_size=1)[0].count() == 0
    merges, words = T.train_bpe(hist, None, vocab_size=10_000)  # until no pair is left
    assert all(len(r.symbols) == 1 for r in words.collect())


def test_documents_without_a_token_keep_their_row(spark):
    docs = spark.createDataFrame([(1, "ab a"), (2, ""), (3, "  "), (4, None)], "doc_id int, text string")
    vocab = T.base_vocab(T.initial_words(T.word_histogram(docs, "text")), ["<unk>"])
    for cap in (None, 2):
        got = {r.doc_id: (list(r.input_ids), r.n_ids, r.id_sum)
               for r in T.encode_documents(docs, "doc_id", "text", vocab, max_tokens=cap).collect()}
        assert got == {1: ([1, 2, 1][:cap], 3, 4), 2: ([], 0, 0), 3: ([], 0, 0), 4: ([], 0, 0)}
