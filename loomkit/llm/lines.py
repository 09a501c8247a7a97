"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line that is not blank goes when an earlier line, by doc_id and place, is equal to it or
within the allowed edits: one for every ``EDIT_CHARS`` characters of the shorter line, at
most ``EDITS``.  So lines shorter than ``EDIT_CHARS`` go by equality alone.

1. Equal lines are one: a digest with its first place.  Hot lines fold map-side.
2. A line is cut into one segment more than its allowed edits.  Lines within the edits of the
   shorter one share one of its segments unchanged, shifted by a bounded distance: for each
   possible length of the shorter line a line looks up its substrings at the places where
   that length's segments can stand.  Own segments and lookups are 64-bit keys of (length, segment,
   substring); lookups of the own length at the own place are the own segments.
3. Members of a key that more than one line has are gathered in blocks of about ``BLOCK``,
   and blocks of one key are verified against each other with the banded bit-parallel
   recurrence.  A line gives out only the earliest line it meets in a block, so neither
   a hot key nor a group of many close lines gives all its pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomkit.functions.markup import let
from loomkit.operators.records import bounded_broadcast
from loomkit.session import cut_lineage

EDITS, EDIT_CHARS, MIN_CHARS, BLOCK = 2, 10, 1, 48
#: white space; a line of nothing else is blank
BLANKS = " \t\n\x0b\x0c\r"
#: characters of a gram in the count filter before verification
GRAM = 5
#: rows of a side that is broadcast; its rows are a key or digest of 16 bytes or less
SMALL = 1_000_000


def _segment(length: str, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and size of segment ``i`` (from 0) of a line with ``length`` (SQL)
    characters; longer segments come last."""
    size = f"int(({length}) div {parts})"
    longer = f"int(({length}) % {parts})"  # the last so many segments hold one character more
    short = f"({parts} - {longer})"
    return (F.expr(f"1 + {i} * {size} + greatest(0, {i} - {short})"),
            F.expr(f"{size} + if({i} >= {short}, 1, 0)"))


def own_keys(line: str = "line", length: str = "length", edits: int = EDITS) -> list[Column]:
    out = []
    for i in range(edits + 1):
        start, size = _segment(length, i, edits + 1)
        out.append(F.xxhash64(F.col(length), F.lit(i), F.substring(F.col(line), start, size)))
    return out


def allowed_edits(length: Column, edits: int = EDITS) -> Column:
    """Edits within which a line and one of ``length`` characters, not longer, are alike."""
    return F.least(F.lit(edits), F.floor(length / EDIT_CHARS).cast("int"))


def class_keys(edits: int = EDITS) -> tuple[list[Column], list[Column]]:
    """Own keys and lookups for every number of allowed edits.  The length in a key is that of
    the shorter line, which alone decides the edits; null where a line has another class."""
    own, lookups = [], []
    for e in range(1, edits + 1):
        low, high = EDIT_CHARS * e, EDIT_CHARS * (e + 1) - 1 if e < edits else 2**31 - 1 - edits
        own += [F.when(F.col("length").between(low, high), k) for k in own_keys(edits=e)]
        lookups += [F.when(F.col("length").between(low + d, high + d), k) for d, k in lookup_keys(edits=e)]
    return own, lookups


def lookup_keys(line: str = "line", length: str = "length", edits: int = EDITS) -> list[tuple[int, Column]]:
    """``(d, key)`` at which equally long or shorter lines may share a segment, without the
    own ones; null where no such place is.  With ``d`` characters less on the other side,
    segment ``i`` (from 0) can stand ``s`` places further right here only if ``|s| <= i``
    and ``|s - d| <= edits - i``."""
    out = []
    for d in range(edits + 1):
        for i in range(edits + 1):
            start, size = _segment(f"{length} - {d}", i, edits + 1)
            for s in range(-i, i + 1):
                if abs(s - d) <= edits - i and (d or s):
                    at = start + s
                    out.append((d, F.when((at >= 1) & (at + size - 1 <= F.col(length)), F.xxhash64(
                        F.col(length) - d, F.lit(i), F.substring(F.col(line), at, size)))))
    return out


def edit_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance of character arrays if at most ``edits``, else something larger.

    Bit ``r`` of a word stands for row ``j - edits + r`` of column ``j``, so the word slides
    along the band.  The distance is followed on the diagonal that ends in the last cell;
    along it values never fall, so a column where it passes ``edits`` ends the work.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def run(long: Column, short: Column) -> Column:
        lead = F.size(long) - F.size(short)
        start = F.struct(F.lit(full & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), lead.alias("d"))

        def column(s: Column, j: Column) -> Column:
            here = short[j - 1]
            bits = []
            for r in range(width):
                row = j - edits + r  # from 1
                inside = (row >= 1) & (row <= F.size(long))
                bits.append(F.when(inside & (F.get(long, row - 1) == here), F.lit(1 << r)).otherwise(F.lit(0)))
            return let(reduce(lambda x, y: x + y, bits), lambda eq: state(s, eq))

        def state(s: Column, eq: Column) -> Column:
            vp, vn = s["vp"], s["vn"]
            d0 = ((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(full))
            return let(d0, lambda z: step(s, vp, vn, z))

        def step(s: Column, vp: Column, vn: Column, d0: Column) -> Column:
            hp = vn.bitwiseOR(F.lit(full) - d0.bitwiseOR(vp))
            hn = d0.bitwiseAND(vp)
            half = F.shiftright(d0, 1)
            miss = F.when(F.getbit(d0, lead + edits) == 0, 1).otherwise(0)
            return F.struct(hn.bitwiseOR(F.lit(full) - half.bitwiseOR(hp)).alias("vp"),
                            half.bitwiseAND(hp).alias("vn"), (s["d"] + miss).alias("d"))

        return F.when(lead > edits, lead).when(F.size(short) == 0, lead).otherwise(F.aggregate(
            F.sequence(F.lit(1), F.size(short)), start,
            lambda s, j: F.when(s["d"] > edits, s).otherwise(column(s, j)), lambda s: s["d"]))

    return F.when(F.size(a) >= F.size(b), run(a, b)).otherwise(run(b, a))


def grams(chars: Column) -> Column:
    """Distinct hashed ``GRAM``-grams; one edit removes at most ``GRAM`` of them."""
    return F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(chars) - GRAM, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(chars, i + j) for j in range(GRAM)])))


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """``(doc_id, text_key, place, line, length)`` of the lines of ``least`` characters or more that are not blank.

    The length leaves the Generate with its line, so no later expression counts it again;
    the outer form keeps the optimizer from evaluating the array once more in a filter.
    """
    text = F.col("text").cast("string")
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(
        i.alias("place"), F.length(line).alias("length"), line.alias("line")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       F.explode_outer(lines).alias("x"))
    return rows.select("doc_id", "text_key", "x.place", "x.line", "x.length").where(
        (F.col("length") >= least) & (F.btrim("line", F.lit(BLANKS)) != ""))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def earlier_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """``(digest, first, leader)`` of the distinct lines that occur twice or more or have an
    earlier line within the allowed edits: first place, and the earliest such line's first place."""
    lines = _lines(docs, least)
    own, lookups = class_keys(edits)
    # the higher-order function keeps this projection out of whole-stage code, where some twenty
    # substring keys make one method too long for the JIT; alone they are split into short ones
    at = F.get(F.transform(F.array(F.struct("doc_id", "place")), lambda x: x), 0)
    keyed = lines.select(_digest(F.col("line")).alias("digest"), at.alias("at"), F.array(*own, *lookups).alias("keys"))
    distinct = keyed.groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("often"),
                                           F.any_value("keys").alias("keys"))
    # the number a line goes by from here on is stable: it is read from the checkpoint
    distinct = cut_lineage(distinct.withColumn("id", F.monotonically_increasing_id()))
    # the lowest bit of a mark says that the key is an own segment
    probes = distinct.select("id", F.posexplode_outer("keys").alias("nth", "key")).where("key IS NOT NULL").select(
        "key", (F.col("id") * 2 + F.when(F.col("nth") < len(own), 1).otherwise(0)).alias("mark"))
    # a key is of use when a segment of one line is met by another line
    shared = probes.groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("mark") % 2).alias("owned"),
                                       F.min("mark").alias("low"), F.max("mark").alias("high")) \
        .where("owned = 1 AND shiftright(low, 1) <> shiftright(high, 1)").select("key", "n")
    members = probes.join(bounded_broadcast(shared, SMALL), "key").groupBy(
        "key", F.shiftright("mark", 1).alias("id")).agg(F.max(F.col("mark") % 2 == 1).alias("own"), F.max("n").alias("n"))
    members = cut_lineage(members)
    wanted = cut_lineage(distinct.select("id", "digest", "first").join(
        bounded_broadcast(members.select("id").distinct(), SMALL), "id"))
    texts = lines.select(_digest(F.col("line")).alias("digest"), "line").join(
        bounded_broadcast(wanted.select("digest"), SMALL), "digest").groupBy("digest").agg(
            F.any_value("line").alias("line"))
    full = cut_lineage(members.join(texts.join(wanted, "digest"), "id").select(
        "key", "own", F.pmod(F.hash("id"), F.ceil(F.col("n") / BLOCK)).alias("block"),
        F.struct("first", "digest", "own", "line").alias("m")))
    left = full.where("own").groupBy("key", "block").agg(F.collect_list("m").alias("left")) \
        .withColumnRenamed("block", "left_block")
    right = full.groupBy("key", "block").agg(F.collect_list("m").alias("right"))

    def earliest(mine: Column, others: Column) -> Column:
        near = F.filter(others, lambda o: (o["first"] < mine["first"])
                        & (F.size(F.array_intersect(mine["grams"], o["grams"]))
                           >= F.greatest(F.size(mine["grams"]), F.size(o["grams"])) - GRAM * edits)
                        & (edit_distance(mine["chars"], o["chars"], edits) <= allowed_edits(
                            F.least(F.size(mine["chars"]), F.size(o["chars"])), edits)))
        return F.struct(mine["digest"].alias("digest"), F.array_min(F.transform(near, lambda o: o["first"])).alias("leader"))

    def open_lines(block: Column) -> Column:
        return F.transform(F.transform(block, lambda m: F.struct(
            m["first"].alias("first"), m["digest"].alias("digest"), m["own"].alias("own"),
            F.split(m["line"], "").alias("chars"))), lambda m: F.struct(
                m["first"].alias("first"), m["digest"].alias("digest"), m["own"].alias("own"),
                m["chars"].alias("chars"), grams(m["chars"]).alias("grams")))

    # a lookup meets a segment in one direction only, two segments meet in both
    opened = F.struct(open_lines(F.col("left")).alias("left"), open_lines(F.col("right")).alias("right"))
    pairs = left.join(right, "key").select(F.explode_outer(let(opened, lambda z: F.filter(F.concat(
        F.transform(z["left"], lambda m: earliest(m, z["right"])),
        F.transform(F.filter(z["right"], lambda m: ~m["own"]), lambda m: earliest(m, z["left"]))),
        lambda x: x["leader"].isNotNull()))).alias("x")).select("x.*").where("digest IS NOT NULL")
    leaders = pairs.groupBy("digest").agg(F.min("leader").alias("leader"))
    return distinct.select("digest", "first", "often").join(leaders, "digest", "left") \
        .where("often > 1 OR leader IS NOT NULL").select("digest", "first", "leader")


def repeated_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, text_key, removed)``: per document with repeated lines their
    ``(place, exact, leader)``, in order."""
    found = bounded_broadcast(earlier_lines(docs, edits, least), SMALL // 4)  # rows of 48 bytes
    places = _lines(docs, least).select(
        "doc_id", "text_key", "place", _digest(F.col("line")).alias("digest"))
    at = F.struct("doc_id", "place")
    gone = places.join(found, "digest").where((at > F.col("first")) | F.col("leader").isNotNull())
    return gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct(
        "place", (at > F.col("first")).alias("exact"),
        F.coalesce("leader", "first").alias("leader")))).alias("removed"))


def _joined(docs: DataFrame, gone: DataFrame, *extra: Column) -> DataFrame:
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64(text).alias("__key"), *extra)
    return rows.join(gone.select(F.col("doc_id").alias("__gid"), F.col("text_key").alias("__gkey"), "removed"),
                     F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__key") == F.col("__gkey")), "left")


def line_report(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_exact, n_near, removed)`` for every row of ``docs``.

    ``removed`` lists ``place:doc_id:place`` of each removed line and the line it repeats.
    Null texts have no lines, an empty text one empty line; blank lines and lines shorter
    than ``least`` stay.  Rows with one doc_id and text are one document.  Equal first places cannot
    occur, so every tie is decided by doc_id and place.  An empty table gives an empty
    result; other columns are ignored.
    """
    gone = repeated_lines(docs, edits, least)
    n = F.coalesce(F.size(F.split(F.col("text").cast("string"), "\n")).cast("long"), F.lit(0))
    removed = F.coalesce("removed", F.expr(
        "cast(array() as array<struct<place:int,exact:boolean,leader:struct<doc_id:bigint,place:int>>>)"))
    return _joined(docs, gone, F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines")) \
        .select(F.col("__id").alias("doc_id"), "n_lines",
                F.size(F.filter(removed, lambda x: x["exact"])).cast("long").alias("n_exact"),
                F.size(F.filter(removed, lambda x: ~x["exact"])).cast("long").alias("n_near"),
                F.array_join(F.transform(removed, lambda x: F.concat_ws(
                    ":", x["place"], x["leader"]["doc_id"], x["leader"]["place"])), ",").alias("removed"))


def drop_repeated_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS,
                        keep_blank: bool = True) -> DataFrame:
    """``docs`` without the repeated lines; columns as they came, ``n_chars`` counted anew.

    Without ``keep_blank`` a document of which only white space is left goes: all its words
    stand in earlier lines.
    """
    gone = repeated_lines(docs, edits, least)
    joined = _joined(docs, gone, F.struct(*[f"`{c}`" for c in docs.columns]).alias("__row"))
    places = F.transform("removed", lambda x: x["place"])
    text = F.col("__row.text").cast("string")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(places, i)), "\n")
    row = joined.select(F.when(F.col("removed").isNull(), text).otherwise(left).alias("__text"),
                        F.col("removed").isNotNull().alias("__cut"), "__row")
    if not keep_blank:
        row = row.where(~F.col("__cut") | (F.length(F.btrim(F.col("__text"), F.lit(BLANKS))) > 0))
    new = {"text": F.col("__text"), "n_chars": F.when(F.col("__cut"), F.length("__text").cast("long"))
           .otherwise(F.col("__row.n_chars") if "n_chars" in docs.columns else F.lit(0))}
    return row.select(*[(new[c] if c in new else F.col(f"__row.`{c}`")).cast(docs.schema[c].dataType).alias(c)
                        for c in docs.columns])
