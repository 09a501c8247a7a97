"""Each operator against brute force on small inputs, and its defined results for nulls, empty
and long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomkit.llm import (chunks, components, decontaminate, licenses, lines, minhash, packing, pages, personal, quality,
                         sharding, warc)
from loomkit.llm.queries import tokenizer_path
from tests.conftest import SF001

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, rank int, "
          "line string, removed int, keys string, at int, id int")


def docs_of(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), "k", 1, "x", 2, "y", 3, 4) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "short text"), (4, "short text"), (5, LONG), (6, "a b c d e f g"),
       (7, "a b c d e f g"), (8, "ünï 日本 語 mit License. MIT license, x")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def space_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def alnum_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def all_operators(docs, bench):
    return {
        "minhash": minhash.near_duplicates(docs), "lines": lines.line_report(docs),
        "drop_lines": lines.drop_repeated_lines(docs), "packing": packing.pack_documents(docs, tokenizer_path()),
        "quality": quality.quality(docs), "keep_good": quality.keep_good(docs),
        "decontaminate": decontaminate.decontamination(docs, bench), "licenses": licenses.scan_licenses(docs),
        "shards": sharding.balanced_shards(docs), "personal": personal.personal_data(docs),
    }


def test_empty_tables_give_empty_results(spark):
    none = docs_of(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, df in all_operators(none, bench).items():
        assert df.count() == 0, name
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string, rank int")).count() == 0
    assert warc.resolve_revisits(spark.createDataFrame([], warc.RECORD)).count() == 0


def test_odd_rows_keep_every_row(spark, odd):
    bench = spark.createDataFrame([(1, None), (None, "a b"), (2, "")], "item_id long, text string")
    out = all_operators(odd, bench)
    for name in ("minhash", "lines", "quality", "decontaminate", "licenses", "shards", "personal"):
        assert out[name].count() == len(ODD), name
    assert out["decontaminate"].where("contaminated").count() == 0
    assert set(out["keep_good"].columns) == set(odd.columns) == set(out["drop_lines"].columns)


def shingle_set(text):
    w = space_words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def true_components(texts):
    sets = {i: shingle_set(t) for i, t in texts}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_texts():
    r = random.Random(5)
    base = [f"w{r.randint(0, 400)}" for _ in range(120)]
    out = [(1000, " ".join(base))]
    for i in range(300):  # a hub and copies that mostly miss each other
        w = list(base)
        for _ in range(r.choice((1, 2, 3, 4, 5))):
            w[r.randrange(len(w))] = f"n{r.randint(0, 10**6)}"
        out.append((i, " ".join(w)))
    return out + [(2000 + i, " ".join(f"z{r.randint(0, 10**6)}" for _ in range(30))) for i in range(20)]


def test_dropping_copies_keeps_rows_without_an_id(spark):
    rows = [(1, "one two three four five six seven"), (2, "one two three four five six seven"), (None, "a clean text"),
            (None, None), (3, ""), (4, "other words that stand here alone")]
    left = minhash.drop_near_duplicates(docs_of(spark, rows))
    assert left.columns == docs_of(spark, rows).columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [
        (0, ""), (0, "a clean text"), (1, rows[0][1]), (3, ""), (4, rows[5][1])]


def test_line_dedup_of_every_length_against_brute_force(spark):
    """Lines of 1 to 40 characters, near copies on both sides of the allowed edits."""
    r = random.Random(17)
    base = ["".join(r.choice("ab c") for _ in range(n)) for n in [*range(1, 41), 9, 10, 19, 20, 29, 30]]
    texts = []
    for i in range(160):
        line = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            at, how = r.randrange(len(line) + 1), r.randint(0, 2)
            if how == 0:
                line.insert(at, r.choice("abxy "))
            elif at < len(line) and how == 1:
                line[at] = r.choice("abxy ")
            elif at < len(line) and len(line) > 1:
                del line[at]
        texts.append("".join(line))
    rows = [(i, "\n".join(texts[4 * i:4 * i + 4])) for i in range(40)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    first, gone = [], {}
    for i, t in rows:
        for place, line in enumerate(t.split("\n")):
            if not line.strip():
                continue
            if any(o == line or distance(o, line) <= min(lines.EDITS, min(len(o), len(line)) // lines.EDIT_CHARS)
                   for o in first):
                gone.setdefault(i, []).append(place)
            first.append(line)
    got = by_id(lines.line_report(docs_of(spark, rows)))
    assert {i: [int(x.split(":")[0]) for x in got[i]["removed"].split(",") if x] for i, _ in rows} == \
        {i: gone.get(i, []) for i, _ in rows}


def test_minhash_finds_every_component(spark, real):
    for texts in (near_texts(), [(r["doc_id"], r["text"]) for r in real.collect()], [x for x in ODD if x[0] != 4]):
        got = by_id(minhash.near_duplicates(docs_of(spark, texts)))
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == true_components(texts)
        assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_estimate_is_corrected_for_collisions():
    r = np.random.default_rng(1)
    for wanted in (0.5, 0.75, 0.95):
        a = r.integers(0, 2**32, (4000, minhash.HASHES), dtype=np.uint64).astype(np.uint32)
        b = np.where(r.random(a.shape) < wanted, a, r.integers(0, 2**32, a.shape, dtype=np.uint64).astype(np.uint32))
        lanes = [np.ascontiguousarray(minhash.pack(x)).view(np.uint64) for x in (a, b)]
        assert abs(minhash.estimate(*lanes).mean() - wanted) < 0.005


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 100), (7, 7)], "a long, b long")
    got = {r["id"]: r["label"] for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 102: 100}


def test_edit_distance_matches_dynamic_programming(spark):
    r = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(r.choice("abé ") for _ in range(r.randint(1, 12)))
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(b) + 1)
            b[k:k + r.randint(0, 1)] = r.choice(("", "a", "é"))
        if b:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame([p for p in pairs if p[1]], "a string, b string")
    got = df.select(lines.edit_distance(F.split("a", ""), F.split("b", ""), 2).alias("d"),
                    F.levenshtein("a", "b").alias("l"))
    assert got.where("(l <= 2 OR d <= 2) AND l <> d").count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def line_texts():
    r = random.Random(3)
    base = ["".join(r.choice("abcdefgh é") for _ in range(r.randint(24, 32))) for _ in range(12)]
    out = []
    for i in range(60):
        own = []
        for _ in range(r.randint(0, 4)):
            s = list(r.choice(base))
            for _ in range(r.choice((0, 0, 1, 2, 3))):
                k = r.randrange(len(s))
                s[k:k + r.randint(0, 1)] = r.choice(("", "x", "y"))
            own.append("".join(s))
        out.append((i, "\n".join(own + ["tiny"])))
    return out


def test_line_dedup_is_exact(spark):
    texts = line_texts()
    places = [(i, p, s) for i, t in texts for p, s in enumerate(t.split("\n")) if len(s) >= lines.MIN_CHARS]
    first = {}
    for i, p, s in places:
        first[s] = min(first.get(s, (i, p)), (i, p))
    gone = {i: [] for i, _ in texts}
    for i, p, s in places:
        near = [f for o, f in first.items() if o != s and f < first[s] and edits(s, o) <= lines.EDITS]
        if (i, p) > first[s] or near:
            gone[i].append(":".join(map(str, (p, *min(near, default=first[s])))))
    got = by_id(lines.line_report(docs_of(spark, texts)))
    assert {i: r["removed"] for i, r in got.items()} == {i: ",".join(g) for i, g in gone.items()}
    left = by_id(lines.drop_repeated_lines(docs_of(spark, texts)))
    for i, t in texts:
        cut = {int(g.split(":")[0]) for g in gone[i]}
        assert left[i]["text"] == "\n".join(s for p, s in enumerate(t.split("\n")) if p not in cut)
        assert left[i]["n_chars"] == len(left[i]["text"])


def test_short_lines_are_deduplicated(spark):
    texts = [(1, "Les.\n\nAnd the rest of it"), (2, "Les.\n\n \nAnd the test of it"), (3, "Lea.\nLes.\nAnd a test of it"),
             (4, "exactly nineteen ch\nLes"), (5, "exactly nineteen chr\nA\nB"), (6, "exactly nineteen chrs\nA\nC"), (7, "Les.")]
    got = by_id(lines.line_report(docs_of(spark, texts)))
    # equal lines of any length; one edit from 10 characters on, two from 20, of the shorter line
    assert {i: r["removed"] for i, r in got.items()} == {
        1: "", 2: "0:1:0,3:1:2", 3: "1:1:0", 4: "", 5: "0:4:0", 6: "0:5:0,1:5:1", 7: "0:1:0"}
    assert len(by_id(lines.drop_repeated_lines(docs_of(spark, texts)))) == 7
    left = by_id(lines.drop_repeated_lines(docs_of(spark, texts), keep_blank=False))
    assert sorted(left) == [1, 3, 4, 5, 6] and left[3]["text"] == "Lea.\nAnd a test of it"


def test_pages(spark):
    html = ("<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav>"
            "<div class='ad'>Buy</div>{}<div id=comments><p>Nice!</div><script>var a='</p>';<!-- </script>"
            "<footer>&copy; x</footer>")
    art = "<article><h1>A &amp; b</h1><p>One\n  two<br>three<p>Four <span class=ad>x</span>five &#233;</article>"
    plain = "<div><p>Site motto</p><p>Body {}</p><p>Subscribe today</p></div>"
    rows = [(1, "http://h/a", html.replace("{}", art)), (2, "http://h/b", html.replace("{}", art)),
            (3, "http://g/1", html.replace("{}", plain.replace("{}", "alpha beta gamma delta epsilon"))),
            (4, "http://g/2", html.replace("{}", plain.replace("{}", "zeta eta theta iota kappa"))),
            (5, None, None), (6, "http://z/", ""), (6, "http://z/", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, rank int")
    got = pages.main_text(df).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == text[2] == "A & b\nOne two three\nFour five é"
    assert text[3] == "Body alpha beta gamma delta epsilon" and text[4] == "Body zeta eta theta iota kappa"
    assert text[5] == text[6] == "" and all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("limit", [pages.CUTS_BYTES, -1])
def test_copies_in_a_row_do_not_hide_the_template(spark, monkeypatch, limit):
    monkeypatch.setattr(pages, "CUTS_BYTES", limit)   # with the cuts broadcast, and with the texts shuffled to them

    def page(body):
        return f"<body><div><p>Site motto of the house</p><p>{body}</p><p>Subscribe to the letter</p></div></body>"
    bodies = ["first text about rivers and hills", "second text about towns and roads"]
    rows = [(i, f"http://h/{i:03d}", page(bodies[0])) for i in range(40)]
    rows += [(100 + i, f"http://h/{i:03d}x", page(bodies[1])) for i in range(20, 30)]
    rows += [(200 + i, "http://other/a", page(bodies[0])) for i in range(3)]      # only copies: nothing to compare with
    got = {r["page_id"]: r["text"] for r in pages.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert {got[i] for i in range(40)} == {bodies[0]} and {got[100 + i] for i in range(20, 30)} == {bodies[1]}
    assert all(got[200 + i].startswith("Site motto") for i in range(3))


def test_common_subsequence_is_longest():
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert len(pages.common_subsequence(a, b)) == table[-1][-1]


def test_packing(spark, real, odd):
    from tokenizers import Tokenizer
    import zlib
    plain = Tokenizer.from_file(tokenizer_path())
    for df in (real, odd):
        got = packing.pack_documents(df, tokenizer_path(), capacity=512).collect()
        wanted = []
        for r in df.collect():
            ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [1]
            for p, b in enumerate(range(0, len(ids), 512)):
                raw = np.array(ids[b:b + 512], dtype="<u4").tobytes()
                wanted.append((r["doc_id"], p, b, len(raw) // 4, zlib.crc32(raw)))
        assert sorted(tuple(r)[:5] for r in got) == sorted(wanted)
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 512
        assert len(bins) <= 1.03 * sum(w[3] for w in wanted) / 512 + 1


def test_packing_splits_words_as_the_tokenizer(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    r = random.Random(3)
    alphabet = "abAB;)'sll  \n\r\v\f\té日本▁\u00a0\u3000<_-😀\x00\u0308ﬁ12ΣİÅ."
    texts = ["It's ÉCOLE, ΟΔΟΣ İstanbul x²!! 3.14 a--b.", "hello <|endoftext|> a", "x<|startoftext|>y <|ENDOFTEXT|>",
             "THE!!\u00a0nbsp\tTab é", "a" * 3000, "''s 's. l'eau,", "", " \n", "I'll don't ΑΣ ΑΣ, İx"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(400)]
    encoder = packing.Encoder(tokenizer_path())
    got = []
    for run in chunks.runs(pa.array(texts)):
        counts, ids = encoder.text_ids(run)
        at = chunks.offsets_of(counts)
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_decontamination(spark, real):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    extra = spark.createDataFrame([(900, "only three words"), (901, None)], "item_id long, text string")
    bench = bench.unionByName(extra)
    more = docs_of(spark, [(10_001, "x Only, three WORDS y only three words"), (10_002, None)]).select(real.columns)
    docs = real.unionByName(more)
    windows = {}
    for r in bench.collect():
        w = alnum_words(r["text"])
        for k in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(r["item_id"]))
    wanted = {}
    for r in docs.collect():
        w, hit, items = alnum_words(r["text"]), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k:k + size]))
                if found:
                    hit |= set(range(k, k + size))
                    items |= found
        wanted[r["doc_id"]] = (len(w), len(hit), len(items))
    for block in (50_000, 60):
        got = by_id(decontaminate.decontamination(docs, bench, windows=block))
        assert {i: (r["n_words"], r["n_hit"], r["n_items"]) for i, r in got.items()} == wanted
    near = docs_of(spark, [(1, "only three big words"), (2, "only three very big long words")])
    assert [by_id(decontaminate.find_passages(near, extra))[i]["near"] for i in (1, 2)] == [["900"], []]


def ordered_within(words, wanted, slop):
    """Whether ``wanted`` stands in order within ``len(wanted) + slop`` words."""
    for start in (i for i, w in enumerate(words) if w == wanted[0]):
        at, left = 1, words[start + 1:start + len(wanted) + slop]
        for w in left:
            if at < len(wanted) and w == wanted[at]:
                at += 1
        if at == len(wanted):
            return True
    return False


def test_proximity_against_brute_force(spark):
    r = random.Random(12)
    words = [f"w{i}" for i in range(6)]
    items = {str(i): r.choices(words, k=r.choice((3, 4, 7, 12))) for i in range(60)}
    texts = {i: r.choices(words + ["other"], k=r.choice((0, 2, 5, 15, 40))) for i in range(120)}
    for i in range(60):                     # items with words put between
        own = list(items[str(i)])
        for _ in range(r.randrange(4)):
            own.insert(r.randrange(1, len(own)), "between")
        texts[200 + i] = ["x"] * r.randrange(3) + own
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id string, text string")
    for options in ({}, {"slop": 0, "windows": 9}, {"slop": 1}):
        got = by_id(decontaminate.find_passages(docs, bench, **options))
        far = 0
        for i, own in texts.items():
            want = {k for k, w in items.items() for j in range(max(1, len(w) - 9))
                    if ordered_within(own, w[j:j + 10], options.get("slop", 2))}
            assert set(got[i]["near"]) == want and set(got[i]["items"]) <= want
            far += len(want) - len(got[i]["items"])
        assert far > 20 if options.get("slop", 2) else far == 0


def test_quality_counts(spark, odd):
    rep = "one two three four five six " * 2 + "seven"
    got = by_id(quality.quality(docs_of(spark, [(1, rep), (2, "a b\na b\n\n \na b#$"), (3, None)])))
    assert (got[1]["n_words"], got[1]["n_repeat_words"], got[1]["base_failed"]) == (13, 12, True)
    assert (got[2]["n_symbols"], got[2]["n_dup_lines"], got[2]["word_chars"]) == (2, 1, 8)
    assert (got[3]["n_words"], got[3]["base_failed"], got[3]["kept"]) == (0, True, False)


def test_quality_agrees_with_labels(spark, real):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    both = quality.quality(real).join(labels, "doc_id").where("NOT base_failed")
    assert both.where("kept <> (quality = 1)").count() <= 0.02 * both.count()


def test_licenses(spark, odd):
    got = by_id(licenses.scan_licenses(odd))
    assert (got[8]["n_base"], got[8]["first_word"], got[8]["last_word"], got[8]["labels"]) == (2, 3, 5, "mit")
    assert (got[1]["n_words"], got[1]["first_word"], got[1]["score"]) == (0, None, 0.0)
    text = "permission is hereby granted free of charge to any person obtaining a copy of software and associated documentation files"
    r = by_id(licenses.scan_licenses(docs_of(spark, [(1, "x\n" + text), (2, "Licensed under CC BY-NC 4.0."), (3, "under the mit")])))
    assert [r[i]["labels"] for i in (1, 2, 3)] == ["mit", "cc-by-nc", ""] and 0.9 <= r[1]["score"] < 1


def test_wrapped_notices_match(spark):
    import textwrap
    texts, want = [], []
    for label, notice in licenses.TEMPLATES:
        for width in (12, 40, 72):
            for mark in ("", " * "):
                texts.append((len(texts), "\n".join(["int main() {}", *(mark + x for x in textwrap.wrap("See: " + notice, width, break_long_words=False)), "", "end of it"])))
                want.append(label)
    got = by_id(licenses.scan_licenses(docs_of(spark, texts), wrapped=True))
    assert [i for i, label in enumerate(want) if label not in got[i]["labels"].split(",")] == []
    apart = "Redistribution and use in source and binary forms" + "\nother words" * 40 + "\nwith or without modification, are permitted"
    assert by_id(licenses.scan_licenses(docs_of(spark, [(1, apart)]), wrapped=True))[1]["labels"] == ""


def test_license_join_is_exact(spark):
    r = random.Random(6)
    vocabulary = [f"t{i}" for i in range(30)]
    table = [(f"l{i}", " ".join(r.sample(vocabulary, r.randint(2, 9)))) for i in range(12)]
    texts = [(i, "\n".join(" ".join(r.choices(vocabulary[:r.choice((12, 30))], k=r.randint(0, 25))) for _ in range(3)))
             for i in range(40)]
    got = by_id(licenses.scan_licenses(docs_of(spark, texts), table, 0.6))
    for i, t in texts:
        want = {label for label, words in table for line in t.split("\n")
                if len(set(words.split()) & set(line.split())) >= 0.6 * len(set(words.split())) - 1e-9}
        assert got[i]["labels"] == ",".join(sorted(want))


def test_wrapped_license_join_and_base_against_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"t{i}" for i in range(24)] + ["MIT", "mit", "License", "apache", "general public license", "GNU"]
    table = [(f"l{i}", " ".join(r.sample([v for v in vocabulary if v.startswith("t")], r.randint(3, 8)))) for i in range(10)]
    longest = max(len(t.split()) for _, t in table)
    seps = (" ", " ", " ", "\n", "\n", ", ", "\n\n", "--")
    texts = [(i, "".join(r.choice(vocabulary) + r.choice(seps) for _ in range(r.randint(0, 60)))) for i in range(150)]
    got = by_id(licenses.scan_licenses(docs_of(spark, texts), table, 0.6, wrapped=True))
    joined = 0
    for i, text in texts:
        by_line = [alnum_words(line) for line in text.split("\n")]
        words = [w for line in by_line for w in line]
        blocks, at = [set(line) for line in by_line], 0
        for line in by_line:                # a run: the end of one line, and the words after it
            at += len(line)
            if line and at < len(words):
                blocks.append(set(line[-(longest - 1):] + words[at:at + longest - 1]))
        fits = lambda b, t: len(b & set(t.split())) >= 0.6 * len(set(t.split())) - 1e-9
        want = {label for label, t in table if any(fits(b, t) for b in blocks)}
        joined += len(want) - len({label for label, t in table if any(fits(b, t) for b in blocks[:len(by_line)])})
        places = []
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            own = phrase.split()
            places += [(k, label) for k in range(len(words)) if words[k:k + len(own)] == own]
        base = {label for _, label in places}
        g = got[i]
        assert (g["n_words"], g["n_base"], g["base_labels"]) == (len(words), len(places), ",".join(sorted(base)))
        assert (g["first_word"], g["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert g["labels"] == ",".join(sorted(base | want)), text
    assert joined > 20


def test_shards_equal_plain_scheduling_where_nothing_is_bundled(spark):
    r = random.Random(9)
    texts = [(i, "x" * r.randint(50, 400) + r.choice("ab")) for i in range(300)]
    texts += [(300 + i, r.choice(texts)[1]) for i in range(80)] + [(400, None), (401, "")]
    got = by_id(sharding.balanced_shards(docs_of(spark, texts), shards=7))
    groups = {}
    for _, t in texts:
        groups[t or ""] = groups.get(t or "", 0) + len(t or "") + 16
    loads = [0] * 7
    for size in sorted(groups.values(), reverse=True):
        loads[loads.index(min(loads))] += size
    mine = [0] * 7
    for row in got.values():
        mine[row["shard"]] += row["size"]
    assert sorted(mine) == sorted(loads) and {row["law"] for row in got.values()} == {"bytes"}


def test_revisits_against_brute_force(spark):
    r = random.Random(7)
    rows = []
    for i in range(1500):
        kind = r.choice(("response", "revisit"))
        head = {k: r.choice("12") for k in ("etag", "last-modified", "x") if r.random() < 0.5}
        url = None if r.random() < 0.02 else "a.com/hot" if r.random() < 0.4 else f"a.com/p{r.randrange(60)}"
        rows.append((i, url, None if r.random() < 0.03 else r.randrange(300), kind, r.choice((200, 200, 404)),
                     head if r.random() < 0.9 else None, r.choice(("d1", "d2", None)), r.randrange(9)))
    got = {g["record_id"]: g for g in warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert len(got) == sum(k[3] == "revisit" for k in rows)
    outcomes = set()
    for i, url, ts, kind, _, head, digest, _ in rows:
        if kind != "revisit":
            continue
        old = [k for k in rows if k[3] == "response" and k[4] == 200 and k[6] is not None and None not in (url, ts, k[2])
               and k[1] == url and (k[2], k[0]) < (ts, i)]
        best = max(old, key=lambda k: (k[2], k[0])) if old else None
        outcome = "missing"
        if best:
            mine, theirs = dict(head or {}), dict(best[5] or {})
            mine["digest"], theirs["digest"] = digest, best[6]
            both = [k for k in ("etag", "last-modified", "digest") if mine.get(k) is not None and theirs.get(k) is not None]
            outcome = "unchecked" if not both else "resolved" if mine[both[0]] == theirs[both[0]] else "mismatch"
        outcomes.add(outcome)
        assert (got[i]["response_id"], got[i]["outcome"]) == (best and best[0], outcome)
        if outcome in ("resolved", "unchecked"):
            renewed = {k: v for k, v in (head or {}).items() if k == "etag"}
            if head is not None and best[5] is not None:
                assert got[i]["headers"] == {**best[5], **renewed}
            assert (got[i]["digest"], got[i]["length"]) == (best[6], best[7])
    assert outcomes == {"missing", "mismatch", "unchecked", "resolved"}


def test_sharding(spark, real, odd):
    for df in (real, odd):
        got = sharding.balanced_shards(df, shards=4).collect()
        by_text, slots = {}, {}
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in got:
            by_text.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
            slots.setdefault(r["shard"], []).append(r["slot"])
            assert r["size"] == len(texts[r["doc_id"]].encode()) + 16
        assert all(len(s) == 1 for s in by_text.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = [0] * 3
    sizes = [(s, i) for i, s in enumerate((7, 7, 6, 5, 5, 4))]
    for unit, shard in sharding.schedule(sizes, 3).items():
        loads[shard] += sizes[unit][0]
    assert sorted(loads) == [11, 11, 12]


def test_personal_base():
    text = "mail a.b@c.de x 1.2.3.4 300.1.1.1 x 4111 1111 1111 1111 and +1 (212) 555-0100."
    found = personal.base_spans(text)[0]
    assert [(personal.KINDS[k], text[a:b]) for a, b, k in found] == [
        ("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0100")]
    assert personal.mask(text, found).startswith("mail <email> x <ip> 300.1.1.1 x <card> and <phone>.")


def test_personal_tagger_on_held_out_documents(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
             .where(F.contains("text", F.lit("@")) | F.col("text").rlike("[0-9]{6}")).orderBy("doc_id").select("text").limit(500).collect()]
    model = personal.train_tagger(texts[:300])
    held = texts[300:]
    # tags that pass the operator's own check, as only those are given out
    tagged = [[s for s in own if s[2] < personal.BASE_KINDS and personal._plausible(t, s)] for t, own in zip(held, personal.tag_spans(model, held))]
    base = [personal.base_spans(t)[0] for t in held]
    both = sum(len(set(a) & set(b)) for a, b in zip(tagged, base))
    assert both >= 0.9 * sum(map(len, base)) and both >= 0.9 * sum(map(len, tagged))
    for own, every in personal.find_spans(model, held):
        assert set(own) <= set(every)


@pytest.fixture(scope="module")
def tagger_and_held(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
             .where(F.contains("text", F.lit("@")) | F.col("text").rlike("[0-9]{6}")).orderBy("doc_id").select("text").limit(700).collect()]
    return personal.train_tagger(texts[:400]), texts[400:]


def test_personal_tagger_finds_forms_beyond_the_patterns(tagger_and_held):
    model, held = tagger_and_held
    texts, spans = personal.written_texts(held, 1500, seed=77)
    right = given = wanted = 0
    kinds = set()
    for text, own, (base, every) in zip(texts, spans, personal.find_spans(model, texts)):
        assert base == personal.base_spans(text)[0] and set(base) <= set(every)
        want, added = set(own) - set(base), set(every) - set(base)
        right, given, wanted = right + len(want & added), given + len(added), wanted + len(want)
        kinds |= {k for _, _, k in want & added}
    assert wanted > 700 and right >= 0.9 * wanted and right >= 0.97 * given and kinds == {0, 1, 2, 3, 4}


def test_personal_tagger_on_worked_forms(tagger_and_held):
    model, held = tagger_and_held
    lead, tail = "the report of the day says that ", " and nothing else was said about it"
    hidden = [("email", "jane (at) example (dot) org"), ("email", "bob [at] mail [dot] com"),
              ("email", "root@host[.]example[.]com"), ("ip", "10 . 20 . 30 . 40"), ("ip", "10[.]20[.]30[.]40"),
              ("card", "4111.1111.1111.1111"), ("card", "4111 1111\n1111 1111"), ("phone", "(212) 555-0187")]
    found = [personal.find_spans(model, [lead + form + tail])[0][1] for _, form in hidden]
    hits = [out == [(len(lead), len(lead) + len(form), personal.KINDS.index(kind))] for (kind, form), out in zip(hidden, found)]
    assert sum(hits) >= 7, list(zip(hidden, found))
    key = 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"'
    assert personal.mask(lead + key, personal.find_spans(model, [lead + key])[0][1]).endswith('token = "<secret>"')
    clean = ["build 1.2.3.999", "300.1.1.1", "2024-01-15 12:30:45 UTC", "ISBN 978-3-16-148410-0", "order 1234-5678",
             "commit 1eb9c654e721b4f812088970e66a6345cee33dd6", "card 4111.1111.1111.1112", "256 . 1 . 1 . 1"]
    for text in clean:
        assert personal.find_spans(model, [lead + text + tail])[0][1] == [], text
    for text, (base, every) in zip(held, personal.find_spans(model, held)):
        for a, b, k in set(every) - set(base):     # what is added to documents as they are: named keys
            assert k == 4 and re.search("token|key|secret|password", text[max(0, a - 24):a], re.I), text[a:b]


def test_personal_check_undoes_the_spelling():
    def ok(kind, text):
        return personal._plausible(text, (0, len(text), personal.KINDS.index(kind)))
    assert ok("ip", "1 . 2 . 3 . 255") and ok("ip", "1[dot]2[.]3.4") and not ok("ip", "1.2.3.256") and not ok("ip", "1.2.3")
    assert ok("card", "4111/1111/1111/1111") and not ok("card", "4111/1111/1111/1112") and not ok("card", "4111")
    assert ok("phone", "(212) 555-0100") and ok("phone", "212.555.0100") and not ok("phone", "2125550100")
    assert not ok("phone", "212 555 01000") and ok("phone", "00 1 212 555 0100") and not ok("phone", "+1 212 555")
    assert ok("email", "a@b . c") and not ok("email", "a at b") and not ok("email", "a@@b.c")
    assert not ok("secret", "a" * 40) and not ok("secret", "1" * 40) and not ok("secret", "a1b2c3") and not ok("email", "a" * 300 + "@b.c")
    long = "1a" * 50_000
    assert personal._whole(long, (40_000, 40_010, 4))[1] - personal._whole(long, (40_000, 40_010, 4))[0] > personal.LONGEST
    assert personal._whole("call (212) 555-0100.", (6, 20, 3)) == (5, 19, 3) and personal._whole("see (00 1 2)", (4, 11, 3)) == (5, 11, 3)


def plain_spans(text):
    """The contract's patterns over the whole text, one kind after the other."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(found)


def test_personal_base_against_the_patterns(spark, real):
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@", "@y.z", "1.2.3.4", "10.0.0.256", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100",
             "+1", "00", " ", " ", "\n", ".", "-", "٣", "é", "1.2.3.4.5.6.7.8", "+12345678901234567", "@a@b.c", "word", "37144963539843"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    texts = dict(enumerate(made)) | {10_000 + r["doc_id"]: r["text"] for r in real.collect()} | {-1: None, -2: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(personal.personal_data(docs))
    assert len(got) == len(texts)
    import hashlib
    for i, text in texts.items():
        want = plain_spans(text or "")
        said = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in want)
        r = got[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for _, k, _ in want) for n in range(4)], text
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))


def test_personal_windows_and_runs():
    assert personal.window_starts("x" * 200) == []
    starts = personal.window_starts("1" * 40_000)
    assert starts[0] == 0 and starts[-1] + personal.WINDOW >= 40_000
    pieces = personal._runs(starts)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(starts) and all(b[0] == a[1] - 2 for a, b in zip(pieces, pieces[1:]))


def test_revisits(spark):
    def rec(i, url, ts, kind, headers=None, digest=None, status=200):
        return (i, url, ts, kind, status, headers, digest, 1)
    rows = [rec(1, "http://www.A.com/x/?b=1&a=2&utm_source=q#f", 10, "response", {"ETag": '"1"', "Date": "d", "X": "y"}, "m1"),
            rec(2, "https://a.com:443/x?a=2&b=1", 20, "response", {"ETag": '"2"', "Content-Length": "9"}, "m2"),
            rec(3, "a.com/x?a=2&b=1", 15, "revisit", {"etag": 'W/"1"', "Date": "e", "Content-Length": "0"}),
            rec(4, "a.com/x?a=2&b=1", 30, "revisit", {"etag": '"1"'}), rec(5, "a.com/x?a=2&b=1", 5, "revisit", {}),
            rec(6, "a.com/x?a=2&b=1", 40, "revisit", None), rec(7, None, 1, "revisit", None),
            rec(8, "a.com/x?a=2&b=1", None, "revisit", None), rec(9, "a.com/x?a=2&b=1", 35, "response", {}, "m9", 404)]
    got = {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert {i: (r["response_id"], r["outcome"]) for i, r in got.items()} == {
        3: (1, "resolved"), 4: (2, "mismatch"), 5: (None, "missing"), 6: (2, "unchecked"), 7: (None, "missing"),
        8: (None, "missing")}
    assert got[3]["headers"] == {"etag": 'W/"1"', "date": "e", "x": "y"} and got[3]["digest"] == "m1"


def test_a_hot_url_crosses_tasks(spark):
    rows = [(i, "h.com/a", i, "response" if i % 50 == 0 else "revisit", 200, {}, f"d{i}" if i % 50 == 0 else None, 1)
            for i in range(1000)]
    got = warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert len(got) == 980 and all(r["response_id"] == r["record_id"] // 50 * 50 for r in got)


def test_warc_files_round_trip(spark, tmp_path):
    import gzip
    http = b"HTTP/1.1 200 OK\r\nETag: \"x\"\r\n\r\n<p>hi</p>"
    data = warc.format_record({"WARC-Type": "warcinfo"}, b"") + warc.format_record(
        {"WARC-Type": "response", "WARC-Target-URI": "http://h/a", "WARC-Date": "2024-01-01T00:00:00Z"}, http)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data[:60]) + gzip.compress(data[60:]))
    (tmp_path / "b.warc").write_bytes(data + b"WARC/1.1\r\nContent-Length: 99\r\n\r\ncut")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert len(got) == 2 and all(bytes(r["payload"]) == b"<p>hi</p>" and r["headers"]["etag"] == '"x"' for r in got)
    assert list(warc.parse_records(data))[1][1] == http


def test_pipeline_stages_on_a_small_table(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert packed.select("doc_id").distinct().count() == n
