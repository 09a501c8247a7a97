"""Main text of web pages by nearest-URL page differencing.

A page is read into text blocks (lines).  Pages of one host are ordered by URL path (those with
the same blocks stand as one), each is paired with its neighbours, and the blocks of a pair are aligned by longest common
subsequence; blocks on the common subsequence belong to the site's template and are deleted.

Two things the alignment alone gets wrong are decided by the markup: a copied article
shares its own lines with its copy, and common sentences stand in many articles, so blocks inside
``<article>``/``<main>`` are not deleted (blocks beside them stay where no neighbour has them), nor
is a neighbour used that holds nearly the whole page; and what stands in
navigation, footer, form, comment, advert and similar elements is never main text, also
where the neighbour has other words there.

Only block hashes are ordered and paired; of the pages, the blocks that may be main text move
once, for the final join.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomkit.operators.split import global_rank
from loomkit.session import cut_lineage

#: a neighbour that holds this share of a page's undecided text is a copy, not a sibling
COPY_SHARE = 0.8
#: cuts that are broadcast, in bytes
CUTS_BYTES = 32 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")

# Element names and class words of page furniture.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NOISE = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "label", "fieldset",
         "audio", "video", "canvas"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
         "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
NOISE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
               "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar",
               "side", "aside", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup",
               "modal", "overlay", "newsletter", "subscribe", "signup", "login", "comment", "comments", "respond",
               "reply", "replies", "disqus", "share", "sharing", "social", "related", "recommended", "widget",
               "toolbar", "pagination", "pager", "masthead", "topbar", "skip"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
               "menu", "menubar", "form"}
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
#: a block's standing: undecided, inside the article element, inside page furniture
PLAIN, MAIN, FURNITURE = 0, 1, 2


def _is_noise(tag: str, attrs: str) -> bool:
    if tag in NOISE:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id") and not NOISE_WORDS.isdisjoint(_NAME.findall(value)):
            return True
        if name == "role" and value in NOISE_ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """``(standing, text)`` of every block in page order."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, str]] = []  # (tag, its counter or "")
    inside = {"noise": 0, "inline": 0, "main": 0, "header": 0, "heading": 0}
    buffer: list[str] = []
    at, size = 0, len(page)

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                furniture = inside["noise"] or (inside["header"] and not (inside["main"] and inside["heading"]))
                out.append((FURNITURE if furniture else MAIN if inside["main"] else PLAIN, text))

    def push(tag: str, kind: str) -> None:
        stack.append((tag, kind))
        if kind:
            inside[kind] += 1

    def pop(to: int) -> None:
        while len(stack) > to:
            kind = stack.pop()[1]
            if kind:
                inside[kind] -= 1

    while at < size:
        m = _TOKEN.search(page, at)
        to = m.start() if m else size
        if to > at and not inside["inline"]:
            buffer.append(page[at:to])
        if not m:
            break
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in BLOCK:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        if tag in RAW:
            close = _CLOSE[tag].search(page, at)
            at = close.end() if close else size
            continue
        if tag in BLOCK:
            flush()
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                pop(len(stack) - 1)
        elif tag == "br":
            buffer.append(" ")
        if tag in VOID:
            continue
        if _is_noise(tag, m["attrs"]):
            push(tag, "noise" if tag in BLOCK else "inline")
        elif tag in ("article", "main"):
            push(tag, "main")
        elif tag == "header":
            push(tag, "header")
        elif tag in HEADING:
            push(tag, "heading")
        elif tag in BLOCK:
            push(tag, "")
    flush()
    return out


def candidates(found: list[tuple[int, str]]) -> tuple[list[str], list[int]]:
    """Blocks that may be main text, with their places among all blocks."""
    own = [(t, i) for i, (kind, t) in enumerate(found) if kind != FURNITURE]
    return [t for t, _ in own], [i for _, i in own]


def common_subsequence(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` on a longest common subsequence with ``b``.

    Equal ends are taken off first; the rest is a longest increasing run over the pairs of
    equal lines (for one line of ``a``, places of ``b`` from the right).
    """
    low = 0
    while low < len(a) and low < len(b) and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < len(a) - low and tail < len(b) - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = set(range(low)) | set(range(len(a) - tail, len(a)))
    where = defaultdict(list)
    for j in range(len(b) - tail - 1, low - 1, -1):
        where[b[j]].append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(low, len(a) - tail):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            node = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(node)
            else:
                ends[k] = j
                links[k] = node
    node = links[-1] if links else None
    while node is not None:
        found.add(node[0])
        node = node[1]
    return found


def _line_hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, sizes, kinds = [], [], []
        for page in batch.column("html").to_pylist():
            found = blocks(page or "")
            lines.append([_line_hash(t) for _, t in found])
            sizes.append([len(t) for _, t in found])
            kinds.append([k for k, _ in found])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "page_key", "host", "path")), pa.array(lines, pa.list_(pa.int64())),
             pa.array(sizes, pa.list_(pa.int32())), pa.array(kinds, pa.list_(pa.int32()))],
            ["page_id", "page_key", "host", "path", "lines", "sizes", "kinds"])


def shared_blocks(lines: list[int], sizes: list[int], kinds: list[int], others: list[list[int]]) -> list[int]:
    """Indexes of the blocks that the template shared with a neighbour accounts for. Beside an
    article, a block stays only where a neighbour shows that it is the page's own."""
    drop: set[int] = set()
    body = [i for i, k in enumerate(kinds) if k != FURNITURE]
    whole, compared = sum(sizes[i] for i in body), False
    for other in others:
        common = common_subsequence(lines, other)
        if whole and sum(sizes[i] for i in body if i in common) < COPY_SHARE * whole:
            compared = True
            drop |= {i for i in common if kinds[i] == PLAIN}
    if not compared and MAIN in kinds:
        drop = {i for i in body if kinds[i] == PLAIN}
    return sorted(drop)


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped = [shared_blocks(r["lines"], r["sizes"], r["kinds"],
                                 [o for o in (r["before"], r["after"]) if o is not None])
                   for r in batch.select(["lines", "sizes", "kinds", "before", "after"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("outline"), pa.array(dropped, pa.list_(pa.int32()))],
                                         ["outline", "dropped"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [candidates(blocks(page or "")) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "page_key")), pa.array([t for t, _ in own], pa.list_(pa.string())),
             pa.array([p for _, p in own], pa.list_(pa.int32()))], ["page_id", "url", "page_key", "texts", "places"])


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html, ..)``.

    Null, empty and text-free pages have an empty text.  A null or odd URL counts as host
    ''.  Pages of a host with the same blocks are compared once, at the first of their paths, so
    that a run of copies does not hide the template; with equal paths page_id orders them.  A
    repeated row counts once and gives one result row each time.  A host's only page is compared
    with nothing.  An empty table gives an empty result; other columns are ignored.
    """
    url = F.lower(F.coalesce(F.col("url").cast("string"), F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .withColumn("page_key", F.xxhash64("page_id", "url", "html"))
    # read once: the places of the outlines and the outline of each page come from the same rows
    outline = cut_lineage(rows.select("page_id", "page_key", host.alias("host"), path.alias("path"), "html").mapInArrow(
        _outline, "page_id long, page_key long, host string, path string, lines array<long>, sizes array<int>, "
                  "kinds array<int>").withColumn("outline", F.xxhash64("host", "lines", "kinds")))
    # the ranks come from narrow rows; the block hashes move once to meet them, on the outline
    places = outline.groupBy("outline").agg(F.min(F.struct("host", "path", "page_id", "page_key")).alias("place")) \
        .select("outline", "place.*")
    ranks = cut_lineage(global_rank(places, ["host", "path", "page_id", "page_key"])).select("outline", "host", "rank")
    bodies = outline.groupBy("outline").agg(*[F.first(c).alias(c) for c in ("lines", "sizes", "kinds")])
    ranked = bodies.join(ranks, "outline")
    beside = ranked.select(F.col("host").alias("other_host"), F.col("rank").alias("other_rank"),
                           F.col("lines").alias("other"))

    def neighbour(df: DataFrame, name: str, step: int) -> DataFrame:
        side = beside.select("other_host", (F.col("other_rank") - step).alias("at"), F.col("other").alias(name))
        return df.join(side, (df["rank"] == side["at"]) & (df["host"] == side["other_host"]), "left") \
            .drop("other_host", "at")

    paired = neighbour(neighbour(ranked, "before", -1), "after", 1)
    dropped = paired.select("outline", "lines", "sizes", "kinds", "before", "after").mapInArrow(
        _differences, "outline long, dropped array<int>")
    # an article's blocks all stay, so only pages with others have cuts
    open_pages = outline.where(F.array_contains("kinds", PLAIN)).select("page_key", "outline").dropDuplicates(["page_key"])
    cuts = cut_lineage(open_pages.join(dropped.where(F.size("dropped") > 0), "outline").select("page_key", "dropped"))
    n, cells = cuts.agg(F.count("*"), F.coalesce(F.sum(F.size("dropped")), F.lit(0))).first()
    if 48 * n + 4 * cells <= CUTS_BYTES:
        cuts = F.broadcast(cuts)  # beyond it the pages' texts are shuffled to their cuts
    read = rows.select("page_id", "url", "page_key", "html").mapInArrow(
        _candidates, "page_id long, url string, page_key long, texts array<string>, places array<int>")
    left = F.when(F.col("dropped").isNull(), F.col("texts")).otherwise(
        F.filter("texts", lambda _, i: ~F.array_contains("dropped", F.get("places", i))))
    out = read.join(cuts, "page_key", "left").select("page_id", "url", F.array_join(left, "\n").alias("text"))
    return out.select("*", F.length("text").cast("long").alias("n_chars"))
