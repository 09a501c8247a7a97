"""Personal data: fixed patterns plus a character BiLSTM-CRF trained from labelled spans.

The base finds e-mail addresses, IP numbers, card numbers and phone numbers by pattern.
The tagger finds further forms of the four kinds, which the patterns miss: addresses with
``(at)`` or spaces, IP numbers with ``[.]`` or spaces, card numbers with dots, slashes or a
line break, phone numbers without a plus; and a fifth kind, keys named as such.  It learns from windows of a bounded sample: as
they are, labelled by the base, and with such forms and look-alikes (dates, versions, order
numbers, checksums) written into them by rule.  Every form holds a digit, an ``@`` or an ``(at)``, so
only windows with one are scored.  Windows overlap; their scores are blended, and the best
tag path is searched over the whole run of windows.  Base spans stay; a tagged span is added
where it meets none, ends where its word or number ends, and stands a check of its kind
once its spelling is undone (IP parts to 255, a card's Luhn digit).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomkit.llm import tagger

#: the contract's four, which the base finds, and named keys and passwords, which only the tagger finds
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4
# Patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WINDOW, STRIDE = 96, 64
#: bound of the training sample, in documents and in windows
SAMPLE_DOCS, SAMPLE_WINDOWS = 400, 1200
#: windows of the sample with a form or a look-alike written into them
WRITTEN_WINDOWS = 3000
EPOCHS = 9
#: characters of the longest span that can be added: a mail address has at most 254, a key 128
LONGEST = 256
#: windows scored together, and the longest run searched at once
BATCH, RUN = 512, 256
_TRIGGER = re.compile(r"[0-9@]|[(\[{][Aa][Tt][)\]}]")
_AROUND = re.compile(r"[^\x20\x09-\x0D]*@[^\x20\x09-\x0D]*")
TAGS = 1 + 2 * len(KINDS)  # 0 outside, 2k + 1 begins and 2k + 2 continues kind k
ALLOWED = np.ones((TAGS, TAGS), dtype=bool)
for _k in range(len(KINDS)):
    ALLOWED[:, 2 * _k + 2] = False
    ALLOWED[2 * _k + 1, 2 * _k + 2] = ALLOWED[2 * _k + 2, 2 * _k + 2] = True

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans that meet the contract, and digit runs that met a pattern but not its check."""
    found, failed = [], []
    if "@" in text:
        for chunk in _AROUND.finditer(text):  # a match never crosses white space
            found += [(m.start(), m.end(), 0) for m in EMAIL.finditer(text, chunk.start(), chunk.end())]
    if _TRIGGER.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            ok = all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
            (found if ok else failed).append((m.start(), m.end(), 1))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
            elif len(digits) >= 14:
                failed.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in PHONE.finditer(text):
                ok = 10 <= sum(c.isdigit() for c in m[0]) <= 15
                (found if ok else failed).append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2])), failed


def window_starts(text: str) -> list[int]:
    """Starts of the windows with a digit or an ``@``."""
    out, last = [], -1
    for m in _TRIGGER.finditer(text):
        p = m.start()
        low = max(last + 1, (p - WINDOW) // STRIDE + 1, 0)
        for k in range(low, p // STRIDE + 1):
            out.append(k * STRIDE)
            last = k
    return out


def _classes(text: str, starts: list[int]) -> np.ndarray:
    out = np.zeros((len(starts), WINDOW), dtype=np.int16)
    for row, s in enumerate(starts):
        own = tagger.encode(text[s:s + WINDOW])
        out[row, :len(own)] = own
    return out


def labelled_windows(texts: list[str], spans: list[list[Span]], skip: list[list[Span]],
                     limit: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Training windows and tag paths; windows over a ``skip`` span are left out."""
    x, y = [], []
    for text, own, bad in zip(texts, spans, skip):
        starts = [s for s in window_starts(text)
                  if not any(a < s + WINDOW and b > s for a, b, _ in bad)][:max(0, limit - len(x))]
        if not starts:
            continue
        tags = np.zeros(len(text) + WINDOW, dtype=np.int8)
        for a, b, k in sorted(own, key=lambda s: (s[0], s[2])):
            if not tags[a:b].any():
                tags[a:b] = 2 * k + 2
                tags[a] = 2 * k + 1
        for s, row in zip(starts, _classes(text, starts)):
            path = tags[s:s + WINDOW].copy()
            if path[0] and path[0] % 2 == 0:  # cut inside a span: the window begins it
                path[0] -= 1
            x.append(row)
            y.append(path)
    return (np.array(x, dtype=np.int16).reshape(-1, WINDOW), np.array(y, dtype=np.int64).reshape(-1, WINDOW))


_AT = re.compile(r"\s*[(\[{]\s*(at|AT|At)\s*[)\]}]\s*|\s*@\s*")
_DOT = re.compile(r"\s*[(\[{]\s*(dot|DOT|Dot|\.)\s*[)\]}]\s*|\s*\.\s*")
_GAP = re.compile(r"[\s./-]+")
_LOCAL_PHONE = re.compile(r"[0-9]{3}[\s./-][0-9]{3}[\s./-][0-9]{4}")
_DIGITS = frozenset("0123456789")
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,128}")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_KEY = _NAME | {"_"}


def _plausible(text: str, span: Span) -> bool:
    """Whether a span, its spelling undone, is of its kind."""
    a, b, kind = span
    if b - a > LONGEST:
        return False
    own = text[a:b]
    if kind == 0:
        return EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", own))) is not None
    if kind == 1:
        flat = _DOT.sub(".", own)
        return IP.fullmatch(flat) is not None and all(len(p) <= 3 and int(p) <= 255 for p in flat.split("."))
    if kind == 2:
        flat = _GAP.sub("", own)
        return 14 <= len(flat) <= 19 and set(flat) <= _DIGITS and luhn(flat)
    digits = "".join(c for c in own if c in _DIGITS)
    if kind == 4:
        return _SECRET.fullmatch(own) is not None and len(digits) >= 3 and sum(c.isalpha() for c in own) >= 3
    if not 10 <= len(digits) <= 15 or _GAP.sub("", own).strip("+").replace("(", "").replace(")", "") != digits:
        return False
    return own[0] in "+(" or own.startswith("00") and own[2:3] in " .-/" or _LOCAL_PHONE.fullmatch(own) is not None


def _whole(text: str, span: Span) -> Span:
    """The span to the ends of its word or number, or beyond ``LONGEST``."""
    a, b, kind = span
    while b > a and text[b - 1] not in _NAME:
        b -= 1
    while a < b and text[a] not in _NAME and not (kind == 3 and text[a] in "+("):
        a += 1
    left = _NAME | set("._%+") if kind == 0 else _KEY if kind == 4 else _DIGITS
    right = _NAME if kind == 0 else _KEY if kind == 4 else _DIGITS
    while a > 0 and b - a <= LONGEST and text[a - 1] in left:
        a -= 1
    while 0 < b < len(text) and b - a <= LONGEST and text[b] in right:
        b += 1
    if kind == 3:
        opened = text.count("(", a, b) - text.count(")", a, b)
        if a > 0 and (text[a - 1] == "+" or text[a - 1] == "(" and opened < 0):
            a -= 1
        while a < b and text[a] == "(" and opened > 0:
            a, opened = a + 1, opened - 1
    return a, b, kind


def _number(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def key_like(text: str) -> list[Span]:
    """Long strings of letters and digits: they may be keys or checksums, only their place tells."""
    return [(m.start(), m.end(), 4) for m in _SECRET.finditer(text) if _plausible(text, (m.start(), m.end(), 4))]


def _key(rng: np.random.Generator) -> str:
    """A string of letters and digits as keys and checksums are."""
    signs = "0123456789abcdef" if rng.random() < 0.6 else "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    while True:
        own = "".join(signs[i] for i in rng.integers(0, len(signs), int(rng.choice([20, 24, 32, 32, 40, 40, 48, 64]))))
        if key_like(own):
            return own


def written_form(rng: np.random.Generator, word: str) -> tuple[str, str, int | None]:
    """What introduces it, a form of a random kind that the base misses or (kind None) a look-alike."""
    pick = lambda *c: c[int(rng.integers(len(c)))]
    kind = int(rng.integers(8))
    if kind == 0:
        name = word + pick("", ".", "_", "-") + pick("", _number(rng, 2)) if rng.random() < 0.7 else "user" + _number(rng, 3)
        host = pick("mail", "example", "host", word) + pick("", _number(rng, 1))
        at, dot = pick((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" @ ", "."), ("(at)", "."), (" (at) ", "."),
                       ("[at]", "[dot]"), ("@", " . "), (" {at} ", " {dot} "), ("@", "[.]"), (" [AT] ", " [DOT] "))
        parts = [host, *pick((), ("mail",)), pick("com", "org", "net", "de", "io", "edu")]
        return "", name.strip("._-") + at + dot.join(parts), 0
    if kind == 1:
        return "", pick(" . ", "[.]", "(.)", " .", ". ", "[dot]").join(str(v) for v in rng.integers(0, 256, 4)), 1
    if kind == 2:
        n = int(pick(16, 16, 16, 15, 14, 19))
        body = pick("4", "5", "3", "6") + _number(rng, n - 2)
        full = next(body + d for d in "0123456789" if luhn(body + d))
        gap, turn = pick(".", "/", "  ", "\n", " - ", " / "), int(rng.integers(1, 4))
        groups = [full[i:i + 4] for i in range(0, n, 4)]
        if gap == "\n":
            return "", " ".join(groups[:turn]) + "\n" + " ".join(groups[turn:]), 2
        return "", gap.join(groups), 2
    if kind == 3:
        area, mid, end = _number(rng, 3), pick("555", _number(rng, 3)), _number(rng, 4)
        return "", pick(f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"{area} {mid} {end}",
                        f"00 {pick('1', '44', '49')} {area} {mid} {end}", f"+1\n({area}) {mid}-{end}",
                        f"({area}) {mid} {end}", f"+1/{area}/{mid}/{end}", f"({area}){mid}-{end}"), 3
    if kind == 4:
        named = pick("token", "secret", "api_key", "password", "apikey", "access_key", "auth_token", "API_KEY", "Token")
        return named + pick(" = \"", "=\"", ": \"", "=", ": ", " = ", " = '", "\": \""), _key(rng), 4
    if kind == 5:
        named = pick("commit", "sha256", "md5", "checksum", "file", "etag", "image", "hash", word, "page")
        return named + pick(" ", ": ", "=", ":", "/", " = ", "-"), _key(rng), None
    year, day = int(rng.integers(1950, 2040)), int(rng.integers(10, 29))
    part = lambda: str(int(rng.integers(0, 30)))
    n = _number
    form = pick(f"{year}-{day % 12 + 1:02d}-{day}", f"{day}.{day % 12 + 1}.{year}", f"{part()}.{part()}.{part()}",
                f"{part()}.{part()}.{part()}.{rng.integers(256, 9999)}", n(rng, int(rng.integers(2, 13))),
                f"{n(rng, 3)}-{n(rng, 7)}-{n(rng, 7)}", f"978-{part()}-{n(rng, 5)}-{n(rng, 3)}-1",
                f"{day % 24}:{day + 20}:{day + 30}", f"{n(rng, 2)},{n(rng, 3)}.{n(rng, 2)}", f"@{word}",
                f"{word} @ {n(rng, 2)}", f"({n(rng, 2)}) {n(rng, 4)}-{n(rng, 2)}", f"{n(rng, 4)} {n(rng, 4)}",
                f"#{n(rng, 6)}", f"{word}(at){part()}", f"token = {n(rng, 3)}", f"password: \"{word}\"")
    return "", form, None


def written_texts(texts: list[str], count: int, seed: int = 10) -> tuple[list[str], list[list[Span]]]:
    """At most ``count`` pieces of ``texts`` with one written form each, and their spans (a look-alike has none)."""
    rng = np.random.default_rng(seed)
    out, spans = [], []
    for n in range(count if texts else 0):
        text = texts[n % len(texts)]
        at = int(rng.integers(0, len(text) + 1))
        left, right = text[max(0, at - int(rng.integers(0, 90))):at], text[at:at + int(rng.integers(0, 90))]
        words = re.findall(r"[a-z]{3,9}", left + " " + right) or ["name"]
        named, form, kind = written_form(rng, words[int(rng.integers(len(words)))])
        left += (" ", " ", " ", "\n", ": ", " (")[int(rng.integers(6))] if left else ""
        left += named
        form_end = named[-1] if named.endswith(("\"", "'")) else ""
        right = (" ", " ", " ", "\n", ". ", ", ", ") ")[int(rng.integers(7))] + right
        own = [] if kind is None else [(len(left), len(left) + len(form), kind)]
        whole = left + form + form_end + right
        low, high = len(left), len(left) + len(form)
        own += [s for s in base_spans(whole)[0] if s[1] <= low or s[0] >= high]
        if any(s[1] <= low or s[0] >= high for s in key_like(whole)):
            continue  # the text has such a string of its own, of unknown kind
        out.append(whole)
        spans.append(own)
    return out, spans


_BLEND = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0).astype(np.float32)


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """``(first, last + 1)`` of overlapping windows; long runs in pieces that share two windows."""
    out, at = [], 0
    while at < len(starts):
        to = at + 1
        while to < len(starts) and starts[to] - starts[to - 1] == STRIDE and to - at < RUN:
            to += 1
        out.append((at, to))
        cut = to < len(starts) and starts[to] - starts[to - 1] == STRIDE
        at = to - 2 if cut else to
    return out


def tag_spans(model: dict, texts: list[str]) -> list[list[Span]]:
    """Tagged spans of every text, from blended window scores and one path per run."""
    out: list[list[Span]] = [[] for _ in texts]
    runs = []  # (text, starts, accept from, accept to)
    for i, text in enumerate(texts):
        starts = window_starts(text)
        pieces = _runs(starts)
        for j, (a, b) in enumerate(pieces):
            joined = j > 0 and pieces[j - 1][1] > a
            cut = j + 1 < len(pieces) and pieces[j + 1][0] < b
            runs.append((i, starts[a:b], starts[a] + STRIDE if joined else 0,
                         starts[b - 2] + STRIDE if cut else len(text) + 1))
    runs.sort(key=lambda r: len(r[1]))
    at = 0
    while at < len(runs):
        to, n = at, 0
        while to < len(runs) and (to == at or n + len(runs[to][1]) <= BATCH):
            n += len(runs[to][1])
            to += 1
        group = runs[at:to]
        at = to
        score = tagger.emissions(model, np.concatenate([_classes(texts[i], s) for i, s, _, _ in group]))
        longest = max(len(s) for _, s, _, _ in group)
        width = (longest - 1) * STRIDE + WINDOW
        blended = np.zeros((len(group), width, TAGS), dtype=np.float32)
        weight = np.zeros((len(group), width, 1), dtype=np.float32)
        lengths = np.empty(len(group), dtype=np.int64)
        row = 0
        for g, (i, starts, _, _) in enumerate(group):
            for k in range(len(starts)):
                blended[g, k * STRIDE:k * STRIDE + WINDOW] += score[row] * _BLEND[:, None]
                weight[g, k * STRIDE:k * STRIDE + WINDOW] += _BLEND[:, None]
                row += 1
            lengths[g] = min((len(starts) - 1) * STRIDE + WINDOW, len(texts[i]) - starts[0])
        blended /= np.maximum(weight, 1e-6)
        for (i, starts, low, high), path in zip(group, tagger.viterbi(model, blended, lengths, ALLOWED)):
            begins = np.flatnonzero((path > 0) & (path % 2 == 1))
            for b in begins.tolist():
                e = b + 1
                while e < len(path) and path[e] == path[b] + 1:
                    e += 1
                if low <= starts[0] + b < high:
                    out[i].append((starts[0] + b, starts[0] + e, (int(path[b]) - 1) // 2))
    return out


def find_spans(model: dict | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Per text the base spans, and base plus added spans."""
    base = [base_spans(t)[0] for t in texts]
    tagged = tag_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for text, own, more in zip(texts, base, tagged):
        starts, reach = [s for s, _, _ in own], list(accumulate((e for _, e, _ in own), max))
        added: list[Span] = []
        for a, b, k in sorted({_whole(text, s) for s in more}):
            before = bisect_left(starts, b)  # base spans that start before this one ends
            free = not (before and reach[before - 1] > a) and not (added and added[-1][1] > a)
            if b > a and free and _plausible(text, (a, b, k)):
                added.append((a, b, k))
        out.append((own, sorted(own + added, key=lambda s: (s[0], s[2], s[1]))))
    return out


def _said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _tag(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for batch in batches:
            rows = []
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, (own, every) in zip(ids, find_spans(weights, texts)):
                count = [sum(k == kind for _, _, k in own) for kind in range(BASE_KINDS)]
                rows.append((i, *count, hashlib.sha256(_said(own).encode()).hexdigest(), _said(every),
                             len(every) - len(own)))
            cols = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    return run


def labelled_sample(docs: DataFrame, limit: int = SAMPLE_DOCS) -> list[str]:
    """At most ``limit`` texts that hold a digit or an ``@``, first in hash order of id and
    text; texts beyond 100,000 characters are no training material."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("h")).where(
        F.contains("text", F.lit("@")) | F.col("text").rlike(r"[0-9]{2}|[(\[{][Aa][Tt][)\]}]")).where(F.length("text") <= 100_000)
    # first the hashes alone, then only the texts below the last of them
    least = [r["h"] for r in rows.select("h").orderBy("h").limit(limit).collect()]
    if not least:
        return []
    return [r["text"] for r in rows.where(F.col("h") <= least[-1]).orderBy("h", "text").limit(limit).collect()]


def train_tagger(texts: list[str], spans: list[list[Span]] | None = None, skip: list[list[Span]] | None = None,
                 limit: int = SAMPLE_WINDOWS) -> dict | None:
    """A model from labelled spans; where none are given, from the base's and from written forms.
    None without texts or spans."""
    own = spans is None
    if own:
        both = [base_spans(t) for t in texts]
        spans, skip = [b[0] for b in both], [b[1] + key_like(t) for b, t in zip(both, texts)]
    x, y = labelled_windows(texts, spans, skip or [[] for _ in texts], limit)
    if own:
        more, marks = written_texts([t for t in texts if t], WRITTEN_WINDOWS)
        wx, wy = labelled_windows(more, marks, [[] for _ in more], WRITTEN_WINDOWS)
        x, y = np.concatenate([x, wx]), np.concatenate([y, wy])
    if len(x) < 16 or not y.any():
        return None
    return tagger.train(x, y, TAGS, epochs=min(40, max(EPOCHS, 1800 // len(x))))


def personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` per row.

    Without a model one is trained from a bounded sample of ``docs`` labelled by the base.
    Null and empty texts have no spans.  Repeated rows give one result row each; an empty
    table gives an empty result; other columns are ignored.
    """
    if model is None:
        model = train_tagger(labelled_sample(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 60 KB
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_tag(shared), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                  "base_sha256 string, spans string, n_added long")


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
            at = b
    return "".join(out) + text[at:]
