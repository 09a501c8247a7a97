"""Token alignment, ranked search and piece encoding against plain models of their contracts."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomkit.llm import alignment, chunks, pieces, search
from loomkit.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF001, SF01

BYTE, PIECE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids long, block long, pair string, rank int, score string, place int, n int"
ALPHABET = "ab;)'ll  \n\r\v\f\té日本 　 x<0x0A>_-😀\x00̈ﬁ12▁."


def odd_texts():
    r = random.Random(11)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 120))) for _ in range(150)]
    return [None, "", " ", "  ", "\n", "▁", "a▁b", " x", "x ", "x" * 3000, " " * 500 + "x", "日本" * 200,
            "the end\r\nof;\r\n it", "<|endoftext|> <s> </s> <unk>", "same text", "same text",
            " ".join(f"w{i % 91}x{i}" for i in range(20_000)), *made]


def table(spark, texts):
    rows = [(None if i == 3 else min(i, 14), t, 1, 2, "p", 3, "s", 4, 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_multiset(rows):
    return Counter(tuple(r) for r in rows)


# --- pieces --------------------------------------------------------------------------------

def test_pieces_equal_the_library(spark, library):
    texts = odd_texts()
    docs = table(spark, texts).repartition(3)
    want = Counter()
    for doc, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "")
        want[(doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True)] += 1
    assert as_multiset(pieces.report(docs, PIECE).collect()) == want


def test_pieces_query_on_all_documents(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op13_pieces"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == \
            (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert r["agrees"]


def test_decode_equals_the_library_on_any_ids(spark, library):
    r = random.Random(2)
    rows = [[r.choice((0, 1, 2, 28705, r.randint(3, 258), r.randint(130, 258), r.randint(259, 31999)))
             for _ in range(r.randint(0, 12))] for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(rows)) + [(-1, None)], "doc_id long, ids array<int>")
    got = dict(pieces.decode_pieces(df, PIECE).collect())
    assert got.pop(-1) == ""
    assert [got[i] for i in range(len(rows))] == library.decode(rows)


def test_heap_and_rounds_give_the_same_pieces():
    m = pieces.model(PIECE)
    r = random.Random(4)
    for _ in range(60):
        text = "".join(r.choice("abcdeé nt▁日") for _ in range(r.randint(1, 90)))
        sym = m.first[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        _, together = m.merge_together(sym.copy(), np.array([len(sym)]))
        assert together.tolist() == m.merge_long(sym).tolist()


def test_a_chunk_unlike_the_library_is_told():
    m = pieces.PieceModel(PIECE)
    raw, sizes = " one two three".encode(), np.array([4, 4, 6])
    counts, ids = m.encode_chunks(raw, sizes)
    assert m.unlike_library(raw, sizes, counts, ids).tolist() == []
    ids = ids.copy()
    ids[counts[0]] += 1
    assert m.unlike_library(raw, sizes, counts, ids).tolist() == [1]


def test_chunks_put_together_are_the_text(monkeypatch):
    monkeypatch.setattr(chunks, "RUN_BYTES", 200)
    texts = odd_texts()
    for run in chunks.runs(pa.array(texts)):
        data = run.chunk_bytes(run.chunk)
        assert data == "".join(" " + t if t else "" for t in texts[run.first:run.last]).encode()


# --- alignment -----------------------------------------------------------------------------

def surfaces(library, byte_library):
    visible = alignment._visible_bytes()
    a = {i: bytes(visible[c] for c in t) for t, i in byte_library.get_vocab(with_added_tokens=False).items()}
    b = {i: bytes([int(library.id_to_piece(i)[1:-1], 16)]) if library.is_byte(i)
         else library.id_to_piece(i).replace("▁", " ").encode() for i in range(library.get_piece_size())}
    return a, b


def plain_alignment(rows, library, byte_library):
    a_bytes, b_bytes = surfaces(library, byte_library)
    texts, counts = [], Counter()
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        a = byte_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
            a, b = [], []
        spans_a, spans_b, links = [], [], []
        for ids, surface, out in ((a, a_bytes, spans_a), (b, b_bytes, spans_b)):
            at = 0
            for i in ids:
                out.append((at, at + len(surface[i]), i))
                at += len(surface[i])
        j = 0
        for x in spans_a:
            while j and spans_b[j - 1][1] > x[0]:
                j -= 1
            while j < len(spans_b) and spans_b[j][0] < x[1]:
                if spans_b[j][1] > x[0]:
                    links.append((x[2], spans_b[j][2]))
                j += 1
        common = sorted({x[1] for x in spans_a} & {x[1] for x in spans_b})
        said, low = [], 0
        for high in common:
            said.append("|".join(",".join(str(x[2]) for x in s if low < x[1] <= high) for s in (spans_a, spans_b))
                        if len(a) < 500 else None)
            low = high
        counts.update(set(links))
        texts.append((doc, len(a), len(b), len(common), links, said))
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    for doc, n_a, n_b, n_groups, links, said in texts:
        digest = None if None in said else sha(";".join(said)) if said else ""
        yield (doc, n_a, n_b, n_groups, len(links), sum(counts[p] == top[p[0]] for p in links),
               sum(counts[p] for p in links), digest)


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 3000])
def test_alignment_equals_plain_overlaps(spark, library, byte_library, monkeypatch, block_bytes):
    docs = table(spark, odd_texts()).repartition(3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = alignment.align_tokens(docs, BYTE, PIECE, block_bytes).collect()
    want = list(plain_alignment(rows, library, byte_library))
    assert Counter(tuple(r)[:7] for r in got) == Counter(w[:7] for w in want)
    digests = Counter(tuple(r) for r in got)
    assert all(digests[w] >= 1 for w in want if w[7] is not None)


def test_alignment_query_on_all_documents(spark, library, byte_library):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {w[0]: w for w in plain_alignment([(r["doc_id"], r["text"]) for r in docs.collect()], library, byte_library)}
    got = QUERIES["op11_token_alignment"](spark, SF001).collect()
    assert len(got) == len(want) > 0
    for r in got:
        w = want[r["doc_id"]]
        assert tuple(r)[:7] == w[:7]
        assert w[7] is None or r["groups_sha256"] == w[7]


def test_run_skipping_finds_every_common_end():
    r = random.Random(8)
    for _ in range(400):
        total = r.randint(1, 200)
        a, b = (sorted(set(r.sample(range(1, total + 1), r.randint(0, total))) | {total}) for _ in range(2))
        if r.random() < 0.3:
            b = list(a)
        i, j = alignment.align(a, b)
        common = sorted(set(a) & set(b))
        assert [a[x - 1] for x in i] == [b[y - 1] for y in j] == common
    assert [x.tolist() for x in alignment.align([], [])] == [[], []]


def test_aligned_groups_carry_tokens_and_ends(spark, library, byte_library):
    docs = table(spark, ["The tokenizers' ends", None, "a▁b", "ünïcode 日本"])
    a_bytes, b_bytes = surfaces(library, byte_library)
    rows = {r["doc_id"]: r for r in alignment.aligned_groups(docs, BYTE, PIECE).collect()}
    assert rows[1]["a_ids"] == rows[2]["a_ids"] == rows[2]["b_ids"] == rows[1]["b_ends"] == []
    for doc in (0, None):
        r = rows[doc]
        for x, y in zip(r["a_ends"], r["b_ends"]):
            assert b"".join(a_bytes[i] for i in r["a_ids"][:x]) == b"".join(b_bytes[i] for i in r["b_ids"][:y])
        assert (r["a_ends"][-1], r["b_ends"][-1]) == (len(r["a_ids"]), len(r["b_ids"]))


# --- search --------------------------------------------------------------------------------

def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, k=10):
    words = [(d, Counter(terms(t))) for d, t in docs]
    words = [(d, c) for d, c in words if c]
    n_docs, n_terms = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in words:
            m = 100 - 90 + ((90 * sum(c.values()) * n_docs) // n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return Counter(out)


def search_tables(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for i in range(120)]
    docs += [(1000 + i, "Alpha beta, GAMMA-delta W1") for i in range(40)]      # ties beyond the ten
    docs += [(None, "alpha beta w1"), (7, "alpha"), (7, "alpha"), (500, None), (501, ""), (502, "?!"),
             (503, " ".join(f"long{i % 700} w{i % 40}" for i in range(30_000))), (504, "日本 ünï ALPHA")]
    items = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (None, "w1 w2 w3 w1"), (3, ""), (4, "absent"),
             (5, " ".join(words)), (6, "日本! long3"), (7, "delta gamma")]
    return (spark.createDataFrame([(d, t, 0, "x", "y") for d, t in docs],
                                  "doc_id long, text string, rank int, item_id string, score string").repartition(5),
            spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, doc_id long, rank string"),
            docs, items)


def test_search_equals_plain_scores(spark):
    docs, items, d, i = search_tables(spark)
    assert as_multiset(search.search(docs, items).collect()) == plain_search(d, i)
    assert as_multiset(search.search(docs, items, k=3).collect()) == plain_search(d, i, 3)


def test_search_in_small_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEMS", 3)
    docs, items, d, i = search_tables(spark)
    assert as_multiset(search.search(docs, items).collect()) == plain_search(d, i)
    block = search.Items([x for x, _ in i], [t for _, t in i], 0)
    weight = np.arange(len(block.vocabulary), dtype=np.int64) * 7919
    r = np.random.default_rng(1)
    doc, place = np.repeat(np.arange(50), 20), r.integers(0, len(weight), 1000)
    pairs = np.unique(doc << 32 | place)
    doc, place = pairs >> 32, pairs & 0xFFFFFFFF
    impact = r.integers(1, 10**6, len(doc))
    want = np.zeros((len(i), 50), dtype=object)
    for a, b in zip(block.item.tolist(), block.place.tolist()):
        for x, y, z in zip(doc.tolist(), place.tolist(), impact.tolist()):
            if b == y:
                want[a, x] += int(weight[b]) * z
    for tile in (1, 5, 4096):
        scorer = search.Scorer(block, weight, 10, 10, 10)
        scorer.term_tile = tile
        assert (scorer.scores(50, doc, place, impact) == want.astype(np.int64)).all()


def test_partial_sums_stay_exact():
    block = search.Items([0], ["a b c"], 0)
    scorer = search.Scorer(block, np.array([2**31, 5, 1]), 1, 1, 10)
    assert scorer.term_tile * 2**31 * search.TOP_IMPACT < 2**53
    assert search.length_norms(np.array([10**8, 1]), 10**12, 10**14).tolist() == [10 + 90 * 10**6, 10]


def test_search_query_on_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    assert as_multiset(QUERIES["op12_lexical_search"](spark, SF01).collect()) == plain_search(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = table(spark, ["a b", None])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert pieces.report(none, PIECE).count() == 0
    assert alignment.align_tokens(none, BYTE, PIECE).count() == 0
    assert alignment.aligned_groups(none, BYTE, PIECE).count() == 0
    assert search.search(none, items).count() == 0
    assert search.search(some, items.limit(0)).count() == 0
    blank = table(spark, [None, "", "?!"])
    assert search.search(blank, items).count() == 0
    assert [r["n_links"] for r in alignment.align_tokens(blank.where("coalesce(text, '') = ''"), BYTE, PIECE).collect()] == [0, 0]
