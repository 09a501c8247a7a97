"""String helpers that reproduce Python ``str`` semantics with JVM regexes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: ASCII whitespace, the four information separators,
# NEL, NBSP and the Unicode space separators. Java's \s is ASCII only, so the class
# is spelled out; the same text is valid for RE2 (DuckDB).
PY_SPACE = (r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

#: the same characters one by one
PY_SPACES = "".join(chr(c) for c in (*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                     0x2028, 0x2029, 0x202f, 0x205f, 0x3000))
_LSTRIP_RE = f"^{PY_SPACE}+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    A one-element ``transform`` is a let-binding inside an expression: a column
    function that reads its input several times (split + extract + extract)
    would otherwise re-evaluate a costly input expression for every reference.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _ends_in_space(text: Column) -> Column:
    return reduce(or_, [F.endswith(text, F.lit(c)) for c in PY_SPACES])


def py_strip(col: Column) -> Column:
    """``str.strip()``: removes every Unicode whitespace character at both ends. Trimming the right end
    walks the whole text, so that is done only where the text ends in one."""
    return let(col, lambda t: F.when(_ends_in_space(t), F.btrim(t, F.lit(PY_SPACES)))
               .otherwise(F.ltrim(t, F.lit(PY_SPACES))))


def py_lstrip(col: Column) -> Column:
    return F.regexp_replace(col, _LSTRIP_RE, "")


def is_blank(col: Column) -> Column:
    """``not line.strip()`` (F1); reads no further than the first other character."""
    return ~col.rlike(f"[^{PY_SPACE[1:]}")


def compute_once(df, keep: list[str], **exprs: Column):
    """Project ``exprs`` once per row behind a Generate node.

    Spark pushes a filter on a derived column below the projection by inlining the
    column's expression, so a costly expression (regex rewrite, JSON parse) would
    run twice: in the filter and in the projection. A one-element ``inline`` is a
    boundary the optimizer does not push filters through.
    """
    fields = [e.alias(name) for name, e in exprs.items()]
    return df.select(*keep, F.inline(F.array(F.struct(*fields))))
