"""JSON lines as text: grammar check, top-level members, splicing and Python's ``dumps`` form.

A line is split once into its strings and the pieces between them. The pieces decide the
nesting depth and the members; strings are never scanned for structure. Everything keeps
the raw text, so key order, extra and repeated keys, lists, NaN and long numbers survive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomkit.functions.text import let

# JSON tokens as Python's reader takes them: strict strings, NaN and infinities allowed.
# Runs are atomic groups around a greedy class: the same matches as possessive ones, in a tighter loop.
STRING = r'"(?>[^"\\\x00-\x1f]*)(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})(?>[^"\\\x00-\x1f]*))*+"'
SCALAR = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|true|false|null|NaN|-?Infinity"
SPACE = " \t\n\r"
_S, _V, _C = "\x01", "\x02", "\x03"      # a string, a scalar, a container
_VALUE = r"[\x01\x02\x03]"
_CLOSED = (r"\{(?:\x01:" + _VALUE + r"(?:,\x01:" + _VALUE + r")*+)?+\}"
           r"|\[(?:" + _VALUE + r"(?:," + _VALUE + r")*+)?+\]")
_MAX_DIGITS = 4300                       # Python's limit for reading an integer


def strings(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(STRING), 0)


def pieces(line: Column) -> Column:
    """Text before, between and after the strings: one element more than ``strings``."""
    return F.split(line, STRING, -1)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _skeleton(bare: Column) -> Column:
    """The line with strings and scalars as single marks and no white space."""
    return F.translate(F.regexp_replace(bare, SCALAR, _V), SPACE, "")


def is_valid(line: Column, between: Column | None = None) -> Column:
    """Whether Python's ``json.loads`` takes the line; ``between`` are its ``pieces``, if they are at hand.

    Innermost containers of the skeleton become one mark, level by level, until a single
    mark is left. A string holds no raw control character, so the pieces alone tell whether the
    line has one; such a line is no JSON, and none can pass for a mark.
    """
    if between is None:
        return let(pieces(line), lambda p: is_valid(line, p))
    return let(F.array_join(between, _S), lambda bare: let(_skeleton(bare), lambda sk: _balanced(between, bare, sk)))


def _balanced(between: Column, bare: Column, sk: Column) -> Column:
    levels = F.sequence(F.lit(0), _count(sk, "{["))
    left = F.aggregate(levels, sk, lambda s, i: F.when(F.length(s) == 1, s)
                       .otherwise(F.regexp_replace(s, _CLOSED, _C)))
    long_int = (F.length(bare) > _MAX_DIGITS) & bare.rlike(
        rf"(?<![0-9.eE+-])-?[0-9]{{{_MAX_DIGITS + 1},}}(?![0-9.eE])")
    control = F.array_join(between, "").rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
    return ~control & left.rlike(rf"^{_VALUE}$") & ~long_int


def kind(line: Column) -> Column:
    """Type of the top-level value of a valid line."""
    first = F.substring(F.ltrim(line, F.lit(SPACE)), 1, 1)
    return let(first, _kind)


def _kind(first: Column) -> Column:
    return (F.when(first == "{", "object").when(first == "[", "array")
            .when(first == '"', "string").when(first == "n", "null")
            .when(first.isin("t", "f"), "boolean").otherwise("number"))


def unescape(token: Column) -> Column:
    """The text of a string token."""
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    return F.when(~F.contains(token, F.lit("\\")), body).otherwise(
        F.element_at(F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>"), 1))


def members(texts: Column, between: Column, top: Column, keys: list[str]) -> Column:
    """Where the last top-level member of each key stands: a struct ``{key: n}``, ``n`` the
    number of its key string (from 1; 0: no such member), and ``element``: a top-level list
    holds the first key as an element.

    ``texts`` and ``between`` are ``strings`` and ``pieces`` of a valid line, ``top`` its kind.
    """
    zero = F.lit(0)
    start = F.struct(zero.alias("depth"), F.lit(False).alias("element"), *[zero.alias(k) for k in keys])

    # bytes of a key's token, all UTF-16 units escaped; counted without a walk over the token
    longest = 6 * max(len(k.encode("utf-16-le")) // 2 for k in keys) + 2

    def step(s: Column, n: Column) -> Column:
        token, before = F.get(texts, n - 1), F.get(between, n - 1)
        depth = s["depth"] + F.when(F.length(before) > 0, _count(before, "{[") - _count(before, "}]")).otherwise(0)
        return let(F.struct(depth.alias("depth"), token.alias("token"), F.get(between, n).alias("after")),
                   lambda z: named(s, n, z))

    def named(s: Column, n: Column, z: Column) -> Column:
        may = (z["depth"] == 1) & (F.octet_length(z["token"]) <= longest)
        key = (top == "object") & F.ltrim(F.translate(z["after"], "\t\n\r", "   ")).startswith(":")
        name = F.when(may & ((top == "array") | key), unescape(z["token"]))
        return let(name, lambda m: state(s, n, z, m))

    def state(s: Column, n: Column, z: Column, name: Column) -> Column:
        is_object = top == "object"
        return F.struct(
            z["depth"].alias("depth"),
            F.when((top == "array") & (name == keys[0]), True).otherwise(s["element"]).alias("element"),
            *[F.when(is_object & (name == k), n).otherwise(s[k]).alias(k) for k in keys])

    numbers = F.filter(F.sequence(F.lit(0), F.size(texts)), lambda n: n > 0)
    return F.aggregate(numbers, start, step)


def _after_colon(between: Column, n: Column) -> Column:
    return F.trim(F.translate(F.regexp_extract(F.get(between, n), r"(?s)^\s*:(.*)$", 1), "\t\n\r", "   "))


def member_type(between: Column, n: Column) -> Column:
    """'missing', 'null', 'string', 'boolean', 'number', 'array' or 'object' of the member whose
    key is string ``n``."""
    return F.when(n == 0, "missing").otherwise(let(_after_colon(between, n), _type_of))


def _type_of(rest: Column) -> Column:
    first = F.substring(rest, 1, 1)
    return (F.when(rest == "", "string").when(first == "{", "object")
            .when(first == "[", "array").when(first == "n", "null").when(first.isin("t", "f"), "boolean")
            .otherwise("number"))


def member_text(line: Column, texts: Column, between: Column, n: Column, key: str,
                member: Column | None = None) -> Column:
    """A string member's text; a scalar member's raw text; a container's JSON (of the first
    such key). NULL when missing or null. ``member`` is its ``member_type``, if at hand."""
    t = member_type(between, n) if member is None else member
    return (F.when(t.isin("missing", "null"), F.lit(None).cast("string"))
            .when(t == "string", unescape(F.get(texts, n)))
            .when(t.isin("object", "array"), F.get_json_object(line, f"$.{key}"))
            .otherwise(F.trim(F.regexp_extract(_after_colon(between, n), r"^[^,}]*", 0))))


def ascii_escaped(text: Column) -> Column:
    """Characters outside printable ASCII as ``\\uXXXX`` of their UTF-16 units."""
    odd = r"[^\x20-\x7e]+"

    def units(r: Column) -> Column:
        return let(F.lower(F.hex(F.encode(r, "UTF-16BE"))), lambda digits: F.when(
            F.length(digits) == 4, F.concat(F.lit(r"\u"), digits)).otherwise(
                F.regexp_replace(digits, "(.{4})", r"\\u$1")))
    runs = F.transform(F.regexp_extract_all(text, F.lit(odd), 0), units)
    parts = F.zip_with(F.split(text, odd, -1), runs, lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    return F.when(text.rlike(odd), F.array_join(parts, "")).otherwise(text)


# Characters that dumps writes with a short escape.
_SHORT = {"0008": r"\b", "0009": r"\t", "000a": r"\n", "000c": r"\f", "000d": r"\r", "0022": r"\"", "005c": r"\\"}
_ESCAPE = r'\\(?:u[0-9a-fA-F]{4}|["\\/bfnrt])'


def _canonical_escape(e: Column) -> Column:
    code = F.lower(F.substring(e, 3, 4))
    short = F.element_at(F.create_map(*[F.lit(x) for kv in _SHORT.items() for x in kv]), code)
    value = F.conv(code, 16, 10).cast("int")
    return (F.when(e == r"\/", "/").when(~e.startswith(r"\u"), e).when(short.isNotNull(), short)
            .when((value >= 0x20) & (value <= 0x7e), F.char(value)).otherwise(F.concat(F.lit(r"\u"), code)))


def canonical_string(token: Column) -> Column:
    """A string token as ``dumps`` writes it: ASCII only, the shortest escapes."""
    parts = F.zip_with(F.split(token, _ESCAPE, -1), F.regexp_extract_all(token, F.lit(_ESCAPE), 0),
                       lambda p, e: F.concat(p, F.coalesce(_canonical_escape(e), F.lit(""))))
    plain = F.when(F.contains(token, F.lit(r"\u")) | F.contains(token, F.lit(r"\/")),
                   F.array_join(parts, "")).otherwise(token)
    return ascii_escaped(plain)


def encode_string(text: Column) -> Column:
    """A text as a JSON string in ``dumps`` form."""
    raw = F.to_json(F.struct(text.alias("v")), {"ignoreNullFields": "false"})
    return canonical_string(F.substring(raw, F.lit(6), F.length(raw) - 6))


def float_text(number: Column) -> Column:
    """``repr(float(x))`` of a number's text: shortest digits, exponent form from 1e16 and below 1e-4."""
    x = number.cast("double")
    ax = F.abs(x)
    shortest = F.upper(ax.cast("string"))
    exponent = F.coalesce(F.nullif(F.regexp_extract(shortest, r"E(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    mantissa = F.regexp_extract(shortest, r"^[0-9.]+", 0)
    whole, part = F.substring_index(mantissa, ".", 1), F.regexp_replace(F.regexp_extract(mantissa, r"\.([0-9]*)", 1), "0+$", "")
    digits = F.regexp_replace(F.concat(whole, part), "^0+", "")
    # value = 0.digits * 10^point
    lead = F.length(F.concat(whole, part)) - F.length(digits)
    point = F.length(whole) + exponent - lead
    kept = F.regexp_replace(digits, "0+$", "")
    kept = F.when(kept == "", "0").otherwise(kept)
    n = F.length(kept)
    exp10 = point - 1
    science = F.concat(F.substring(kept, 1, 1),
                       F.when(n > 1, F.concat(F.lit("."), F.substring(kept, F.lit(2), n))).otherwise(""),
                       F.when(exp10 < 0, "e-").otherwise("e+"),
                       F.lpad(F.abs(exp10).cast("string"), F.greatest(F.length(F.abs(exp10).cast("string")), F.lit(2)), F.lit("0")))
    plain = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), kept))
             .when(point >= n, F.concat(kept, F.repeat(F.lit("0"), point - n), F.lit(".0")))
             .otherwise(F.concat(F.substring(kept, F.lit(1), point), F.lit("."), F.substring(kept, point + 1, n))))
    body = (F.when(ax == 0, "0.0").when((exp10 < -4) | (exp10 >= 16), science).otherwise(plain))
    return (F.when(ax == float("inf"), F.when(x < 0, "-Infinity").otherwise("Infinity"))
            .otherwise(F.concat(F.when(number.startswith("-"), "-").otherwise(""), body)))


_NUMBER = r"-?[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+"


def _canonical_piece(piece: Column) -> Column:
    """A piece between strings with ``dumps`` separators and number texts."""
    tight = F.translate(piece, SPACE, "")
    def text(m: Column) -> Column:
        return F.when(m.rlike("[.eE]"), float_text(m)).when(m == "-0", "0").otherwise(m)
    numbers = F.zip_with(F.split(tight, _NUMBER, -1), F.regexp_extract_all(tight, F.lit(_NUMBER), 0),
                         lambda p, m: F.concat(p, F.coalesce(text(m), F.lit(""))))
    exact = F.when(tight.rlike(r"[.eE][0-9+-]|-0"), F.array_join(numbers, "")).otherwise(tight)
    return F.replace(F.replace(exact, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))


def dumps(texts: Column, between: Column) -> Column:
    """The line as Python's ``json.dumps(json.loads(line))`` writes it, but for repeated keys,
    which stay as members (a reader takes the last one either way)."""
    tail = F.concat(F.transform(texts, canonical_string), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.transform(between, _canonical_piece), tail, lambda p, s: F.concat(p, s)), "")


def splice_string(texts: Column, n: Column, text: Column) -> Column:
    """``texts`` with the string after key string ``n`` written anew."""
    return F.transform(texts, lambda t, i: F.when(i == n, encode_string(text)).otherwise(t))


def python_repr(text: Column) -> Column:
    """``repr`` of a string."""
    control = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]+"
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, code in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(code))
    runs = F.transform(F.regexp_extract_all(body, F.lit(control), 0), lambda r: F.regexp_replace(
        F.lower(F.hex(F.encode(r, "UTF-8"))), "(.{2})", r"\\x$1"))
    body = F.when(body.rlike(control), F.array_join(F.zip_with(
        F.split(body, control, -1), runs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")).otherwise(body)
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _python_names(piece: Column) -> Column:
    for name, said in (("true", "True"), ("false", "False"), ("null", "None"), ("NaN", "nan"), ("Infinity", "inf")):
        piece = F.replace(piece, F.lit(name), F.lit(said))
    return piece


def python_text(json: Column) -> Column:
    """``str`` of the value of a JSON text that is no string: numbers, names, lists and dicts."""
    texts, between = strings(json), pieces(json)
    tail = F.concat(F.transform(texts, lambda t: python_repr(unescape(t))), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.transform(between, lambda p: _python_names(_canonical_piece(p))), tail,
                                   lambda p, s: F.concat(p, s)), "")
