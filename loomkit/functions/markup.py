"""Markup normalisation as native column expressions.

A regex substitution with a callback (``re.sub(pattern, fn, text)``) becomes
``split`` (the text between matches) + ``regexp_extract_all`` (the matches) +
``transform`` (the callback) + ``zip_with`` / ``array_join`` (re-assembly).
Everything stays inside the JVM: no Python worker is involved.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomkit.functions.text import PY_SPACE, let, py_strip

# Number patterns. Python's \d also takes non-ASCII digits; the ASCII class is
# used here (no such digits occur in markup).
NUMBER_ANY = r"[-+]?(?:[0-9]*\.[0-9]+|[0-9]+)(?:[eE][-+]?[0-9]+)?"
NUMBER_DECIMAL = r"-?[0-9]+\.[0-9]+"
HEX_COLOUR = r"#[0-9a-fA-F]{3,8}\b"

# Tag and attribute patterns of the attribute sorter.
TAG = r"<([a-zA-Z0-9\-:]+)" + PY_SPACE + r"+([^>]*?)(/?>)"
ATTRIBUTE = r'([a-zA-Z0-9\-:]+)="([^"]*)"'

# Attribute priority of the sorter; any other name ranks 100.
ATTRIBUTE_PRIORITY = {"id": 0, "d": 1, "fill": 2, "stroke": 3, "transform": 4, "viewBox": 5}
OTHER_PRIORITY = 100

_DEC = "decimal(38,18)"


def _pow2(k: Column) -> Column:
    """2^k as an exact decimal(38,0) for 0 <= k <= 124."""
    one = F.lit(1).cast("bigint")
    lo = F.call_function("shiftleft", one, F.least(k, F.lit(62))).cast("decimal(38,0)")
    hi = F.call_function("shiftleft", one, F.greatest(k - 62, F.lit(0))).cast("decimal(38,0)")
    return lo * hi


def _exact_integer_text(x: Column) -> Column:
    """Decimal text of the exact integer value of an integral double (``str(int(x))``)."""
    ax = F.abs(x)
    e = F.greatest(F.floor(F.log2(ax)) - 53, F.lit(0)).cast("int")
    mant = (ax / F.pow(F.lit(2.0), e)).cast("bigint").cast("decimal(38,0)")
    big = F.try_multiply(mant, _pow2(e))
    text = F.coalesce(big.cast("string"), ax.cast("decimal(38,0)").cast("string"),
                      F.format_string("%.0f", ax))
    return F.when(x < 0, F.concat(F.lit("-"), text)).otherwise(text)


def _rounded_binary(m: Column, x: Column, ndigits: int) -> Column:
    """``round(float(m), ndigits)`` on the exact binary value, as decimal(38, ndigits).

    Away from a decimal tie the text and the double round alike. Near a tie the
    double is compared exactly with the tie point T = (2f+1) / (2*10^n):
    |x| = B * 2^-k with B integral, so |x| > T  <=>  B*2*10^n > (2f+1)*2^k,
    both sides exact decimal(38,0) integers. Equality is an exact binary tie and
    goes to the even neighbour, as Python's round does.
    """
    scale = 10 ** ndigits
    dec = F.abs(m.try_cast(_DEC))
    scaled = dec * F.lit(scale)
    fl = F.floor(scaled).cast("decimal(38,0)")
    frac = scaled - fl
    near = F.abs(frac - F.lit(0.5)) < F.lit(1e-9)
    ax = F.abs(x)
    k = (F.lit(53) - F.floor(F.log2(F.greatest(ax, F.lit(1e-300))))).cast("int")
    b = (ax * F.pow(F.lit(2.0), k)).cast("bigint").cast("decimal(38,0)")
    lhs = b * F.lit(2 * scale).cast("decimal(38,0)")
    rhs = (fl * 2 + 1).cast("decimal(38,0)") * _pow2(k)
    tied_up = (F.when(lhs > rhs, fl + 1)
               .when(lhs < rhs, fl)
               .otherwise(fl + F.pmod(fl, F.lit(2))))
    mag_scaled = F.when(near, tied_up).otherwise(F.bround(scaled, 0))
    mag = (mag_scaled.cast("decimal(38,0)") / F.lit(scale)).cast(f"decimal(38,{ndigits})")
    return F.when(x < 0, -mag).otherwise(mag)


def _format_rounded(r: Column) -> Column:
    """``str(int(v)) if v == int(v) else str(v)`` for a decimal value.

    Works on the decimal text: trailing fraction zeros and a bare dot are dropped,
    so ``5.00`` -> ``5`` and ``0.40`` -> ``0.4`` (a comparison with ``floor`` would
    lose the fraction to decimal precision rules).
    """
    text = F.regexp_replace(r.cast("string"), r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(text, r"\.$", "")


def round_literal(m: Column, ndigits: int = 2, rounding: str = "binary") -> Column:
    """Text of one rounded literal; NULL when the value overflows (row rejected).

    ``rounding="binary"`` follows Python's ``round`` on the double (default);
    ``rounding="decimal"`` rounds the decimal text half-even (DuckDB ``round_even``).
    """
    x = m.cast("double")
    small = F.abs(x) < F.lit(2.0 ** 52)
    if rounding == "binary":
        r = _rounded_binary(m, x, ndigits)
    elif rounding == "decimal":
        r = F.bround(m.cast(_DEC), ndigits)
    else:
        raise ValueError(f"unknown rounding {rounding!r}")
    return (F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("string"))
            .when(small & r.isNotNull(), _format_rounded(r))
            .otherwise(_exact_integer_text(x)))


def _units_text(x: Column, units: Column, n: int) -> Column:
    """Text of ``units / 10^n`` with the sign of ``x``: exact decimal scaling, then
    trailing zeros and a bare dot trimmed (``2.50`` -> ``2.5``, ``3.00`` -> ``3``)."""
    if n == 0:
        body = units.cast("string")
    else:
        scaled = units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-n))
        body = F.rtrim(F.rtrim(scaled.cast("string"), F.lit("0")), F.lit("."))
    return F.when((x < 0) & (units != 0), F.concat(F.lit("-"), body)).otherwise(body)


def round_literals(matches: Column, ndigits: int = 2, rounding: str = "binary") -> Column:
    """``array<string>`` of literals -> their rounded texts (NULL on overflow).

    Literals with |x| < 1e6 that are more than 1e-6 away from a tie take a double
    path: ``sd = |x| * 10^n`` is then within far less than the distance to the tie,
    so ``floor(sd + 0.5)`` is the correctly rounded unit count. The rest (near a
    tie, or large) take the exact path of ``round_literal``.
    """
    if rounding != "binary":
        return F.transform(matches, lambda s: round_literal(s, ndigits, rounding))
    scale = float(10 ** ndigits)

    def one(s: Column) -> Column:
        x = s.cast("double")
        sd = F.abs(x) * scale
        fast = (F.abs(x) < 1e6) & (F.abs(sd - F.floor(sd) - 0.5) > 1e-6)
        units = F.floor(sd + 0.5).cast("bigint")
        return F.when(fast, _units_text(x, units, ndigits)).otherwise(round_literal(s, ndigits, rounding))
    return F.transform(matches, one)


def _assemble(text: Column, pattern: str, replaced: Column) -> Column:
    """Text between the matches zipped with the replacement texts."""
    pieces = F.split(text, pattern, -1)
    tail = F.concat(replaced, F.array(F.lit("")))
    return F.array_join(F.zip_with(pieces, tail, lambda p, r: F.concat(p, r)), "")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)


def _substitute(text: Column, pattern: str, fn) -> Column:
    """``re.sub(pattern, fn, text)`` where ``fn`` maps a match Column to a Column."""
    return _assemble(text, pattern, F.transform(_matches(text, pattern), fn))


def round_numbers(text: Column, ndigits: int = 2, mode: str = "faithful",
                  rounding: str = "binary") -> Column:
    """Every signed / exponent number rounded, integral values lose ``.0``.

    ``mode="faithful"`` reproduces the context-blind rewrite (``#000000`` -> ``#0``,
    ``1.5-0.001`` -> ``1.50``). ``mode="safe"`` leaves hex colours alone and keeps a
    separator where a signed number collapses onto its neighbour. The result is
    NULL when a literal overflows a double: such a row is rejected (F9).
    """
    return let(text, lambda t: _round_numbers(t, ndigits, mode, rounding))


def _round_numbers(text: Column, ndigits: int, mode: str, rounding: str) -> Column:
    overflow = F.exists(_matches(text, NUMBER_ANY), lambda m: F.abs(m.cast("double")) == F.lit(float("inf")))
    if mode == "faithful":
        replaced = round_literals(_matches(text, NUMBER_ANY), ndigits, rounding)
        return F.when(overflow, F.lit(None).cast("string")).otherwise(_assemble(text, NUMBER_ANY, replaced))
    if mode != "safe":
        raise ValueError(f"unknown mode {mode!r}")
    # Hex colours are shielded by matching them first and returning them unchanged.
    pattern = f"{HEX_COLOUR}|{NUMBER_ANY}"
    found = _matches(text, pattern)
    numbers = F.transform(found, lambda m: F.when(m.startswith("#"), F.lit("0")).otherwise(m))
    rounded = round_literals(numbers, ndigits, rounding)

    def fn(s: Column, lit: Column) -> Column:
        signed_zero = s.startswith("-") & (lit == F.lit("0"))
        return (F.when(s.startswith("#"), s)
                .when(signed_zero, F.lit(" 0"))
                .otherwise(lit))
    replaced = F.zip_with(found, rounded, fn)
    return F.when(overflow, F.lit(None).cast("string")).otherwise(_assemble(text, pattern, replaced))


def round_decimals(text: Column, ndigits: int = 2, rounding: str = "binary") -> Column:
    """Only ``-?\\d+\\.\\d+`` literals are rounded; exponents stay as they are."""
    return let(text, lambda t: _assemble(t, NUMBER_DECIMAL, round_literals(_matches(t, NUMBER_DECIMAL), ndigits,
                                                                          rounding)))


def _priority(name: Column) -> Column:
    lookup = F.create_map(*[x for k, v in ATTRIBUTE_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(lookup, name), F.lit(OTHER_PRIORITY))


def _rebuild_tag(tag: Column) -> Column:
    """One tag match -> ``<name k="v" ...>`` with attributes ordered by (priority, name)."""
    names = F.regexp_extract_all(tag["attrs"], F.lit(ATTRIBUTE), 1)
    values = F.regexp_extract_all(tag["attrs"], F.lit(ATTRIBUTE), 2)
    keyed = F.transform(
        F.arrays_zip(names.alias("n"), values.alias("v")),
        lambda a, i: F.struct(_priority(a["n"]).alias("p"), a["n"].alias("n"), i.alias("i"),
                              a["v"].alias("v")))
    ordered = F.array_sort(keyed)
    body = F.array_join(F.transform(ordered, lambda a: F.concat(a["n"], F.lit('="'), a["v"], F.lit('"'))), " ")
    return F.when(F.size(ordered) > 0, F.concat(F.lit("<"), tag["name"], F.lit(" "), body, tag["close"])) \
        .otherwise(F.concat(F.lit("<"), tag["name"], tag["close"]))


def sort_attributes(text: Column) -> Column:
    """Rebuild every tag with whitespace after its name; only ``k="v"`` survives.

    Ordering is stable: equal (priority, name) keep their input position.
    """
    return let(text, _sort_attributes)


def _sort_attributes(text: Column) -> Column:
    pieces = F.split(text, TAG, -1)
    tags = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(TAG), 1).alias("name"),
        F.regexp_extract_all(text, F.lit(TAG), 2).alias("attrs"),
        F.regexp_extract_all(text, F.lit(TAG), 3).alias("close"))
    rebuilt = F.concat(F.transform(tags, _rebuild_tag), F.array(F.lit("")))
    return F.array_join(F.zip_with(pieces, rebuilt, lambda p, r: F.concat(p, r)), "")


def collapse_between_tags(text: Column) -> Column:
    """Strip, then ``>\\s+<`` -> ``><``."""
    return F.regexp_replace(py_strip(text), f">{PY_SPACE}+<", "><")


def collapse_blanks(text: Column) -> Column:
    """Runs of blanks and tabs -> one blank."""
    return F.regexp_replace(text, r"[ \t]+", " ")


def collapse_markup_space(text: Column) -> Column:
    """Both whitespace rules."""
    return collapse_blanks(collapse_between_tags(text))


def minify(text: Column, precision: int = 2, rounding: str = "binary") -> Column:
    """X4a, X2 at ``precision``, X4b, X3 in this order (no external minifier)."""
    return sort_attributes(collapse_blanks(round_decimals(collapse_between_tags(text), precision, rounding)))


def clean_markup(text: Column, ndigits: int = 2, mode: str = "faithful",
                 rounding: str = "binary") -> Column:
    """The cleaner's rewrite: X1 then X3 (NULL when X1 rejects the row)."""
    return sort_attributes(round_numbers(text, ndigits, mode, rounding))


def byte_size(text: Column) -> Column:
    """UTF-8 size in bytes (``len(s.encode())``)."""
    return F.octet_length(text)


def char_length(text: Column) -> Column:
    """Length in code points (``len(s)``)."""
    return F.char_length(text)


def target_bytes(kb: Column) -> Column:
    """``int(kb * 1024)`` (truncation toward zero)."""
    return (kb * F.lit(1024.0)).cast("bigint")


def scaled_size(w: Column, h: Column, max_dim: Column) -> tuple[Column, Column]:
    """``max(1, round(w*scale))`` per side, only when ``scale < 1``.

    Python's ``round`` on the double is half-even on the binary value; ``bround`` of
    the product is used, which agrees except on decimal ties that are not binary ties.
    """
    scale = max_dim.cast("double") / F.greatest(w, h).cast("double")
    nw = F.when(scale < 1, F.greatest(F.lit(1), F.bround(w * scale, 0).cast("int"))).otherwise(w)
    nh = F.when(scale < 1, F.greatest(F.lit(1), F.bround(h * scale, 0).cast("int"))).otherwise(h)
    return nw, nh
