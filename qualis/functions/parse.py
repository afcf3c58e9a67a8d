"""Scalar functions as Column expressions (no Python UDF anywhere).

They reproduce Python's parsing and formatting rules exactly enough for the
audit: strptime-style multi-format dates, strict ISO shape, float() numerics
(incl. nan/inf/underscores), and ``:g`` number text.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes (ASCII whitespace + \x1c-\x1f + the
# Unicode spaces). Java regex syntax.
WS_CLASS = (r"\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}"
            r"\x{2029}\x{202f}\x{205f}\x{3000}")
_WS = WS_CLASS

# strptime field shapes: %Y four digits, %m 1-2 digits, %d 1-2 digits or a
# space-padded single digit. A digit that only has to be one may be any Unicode
# decimal digit.
_Y = r"(\p{Nd}{4})"
_M = "(1[0-2]|0[1-9]|[1-9])"
_D = r"(3[01]|[12]\p{Nd}|0[1-9]|[1-9]| [1-9])"

# Unicode decimal digits beyond ASCII, and the ASCII digits that they stand for.
_OTHER_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None]
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)

# Ordered date formats, first match wins (ISO first). Each entry:
# (pattern, group index of year, month, day).
DATE_SHAPES = [
    (rf"^{_Y}-{_M}-{_D}\z", 1, 2, 3),     # %Y-%m-%d
    (rf"^{_D}\.{_M}\.{_Y}\z", 3, 2, 1),   # %d.%m.%Y
    (rf"^{_Y}/{_M}/{_D}\z", 1, 2, 3),     # %Y/%m/%d
    (rf"^{_D}-{_M}-{_Y}\z", 3, 2, 1),     # %d-%m-%Y
]
ISO_SHAPE = r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}\z"

# Text that any of the parsers below takes as it stands: tested first, with one regex.
PLAIN_DATE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
PLAIN_NUMBER = r"^[0-9]{1,15}([.][0-9]{1,15})?\z"

_DIG = "[0-9](_?[0-9])*"
FLOAT_SHAPE = rf"^[+-]?({_DIG}(\.({_DIG})?)?|\.{_DIG})([eE][+-]?{_DIG})?\z"
SPECIAL_SHAPE = r"(?i)^[+-]?(nan|inf|infinity)\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def by_name(fn):
    """Memoise an expression builder for named-column input.

    Building a Column costs one JVM round trip per node (a date parse has a
    few hundred); the result is an immutable expression, so the same column
    name can reuse it across DataFrames and queries.
    """
    cache: dict[str, Column] = {}

    def wrapper(col):
        if isinstance(col, str):
            if col not in cache:
                cache[col] = fn(col)
            return cache[col]
        return fn(col)

    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


# The same whitespace set as literal characters, for the regex-free trim.
PY_WHITESPACE = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
                 + "\u2028\u2029\u202f\u205f\u3000")


# float() trims the same set minus the information separators \x1c-\x1f.
FLOAT_WHITESPACE = PY_WHITESPACE.replace("\x1c\x1d\x1e\x1f", "")


@by_name
def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()``: Spark's trim only removes spaces. ``btrim`` with
    the whitespace set is a character scan, no regex."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def ascii_digits(s: Column) -> Column:
    """Unicode decimal digits as ASCII ones; plain text is not looked up."""
    return F.when(s.rlike(r"[^\x00-\x7f]"), F.translate(s, "".join(_OTHER_DIGITS), _AS_ASCII)).otherwise(s)


def _iso_shaped(s: Column) -> Column:
    """dddd-dd-dd without a regex: fixed length, dashes in place, digits only."""
    return ((F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
            & (F.translate(s, "0123456789", "") == "--"))


@by_name
def parse_date(col: Column | str) -> Column:
    """multi-format date parse; NULL when no format gives a valid date."""
    c, s = _c(col), py_strip(col)
    # Fast path: strict ISO text is the first format and the common case.
    return F.when(c.rlike(PLAIN_DATE), c.try_cast("date")).when(_iso_shaped(s) & (F.substring(s, 1, 4) != "0000"), s.try_cast("date")) \
        .otherwise(parse_date_stripped(s))


def parse_date_stripped(s: Column) -> Column:
    """F1 on already stripped text: per format one shape test and one rewrite
    to Y-M-D (1-digit month/day and a space-padded day allowed), then a
    calendar-checked cast."""
    branches = []
    for pat, gy, gm, gd in DATE_SHAPES:
        ymd = ascii_digits(F.replace(F.regexp_replace(s, pat, f"${gy}-${gm}-${gd}"), F.lit(" "), F.lit("")))
        branches.append(F.when(s.rlike(pat) & ~ymd.startswith("0000"), ymd.try_cast("date")))
    return F.coalesce(*branches)


@by_name
def is_iso_date(col: Column | str) -> Column:
    """strict ISO shape on the unstripped text plus a valid calendar date.
    NULL input gives NULL (never TRUE)."""
    c = _c(col)
    plain = _iso_shaped(c) & (F.substring(c, 1, 4) != F.lit("0000")) & c.try_cast("date").isNotNull()
    other = c.rlike(ISO_SHAPE) & parse_date_stripped(c).isNotNull()
    return F.when(c.rlike(PLAIN_DATE), c.try_cast("date").isNotNull()) \
        .when(c.rlike(r"[^\x00-\x7f]"), other).otherwise(plain)


@by_name
def parse_float(col: Column | str) -> Column:
    """Python float() on text; decimal comma and suffixes are rejected."""
    c = _c(col)
    s = F.btrim(c, F.lit(FLOAT_WHITESPACE))
    # Fast path: only digits, sign, point and exponent letters (no underscore,
    # no letters that Java's parser would accept but Python's would not): the
    # plain cast decides exactly like float().
    plain = (F.length(s) > 0) & (F.translate(s, "0123456789.+-eE", "") == "")
    return F.when(c.rlike(PLAIN_NUMBER), c.try_cast("double")) \
        .when(plain, s.try_cast("double")).otherwise(_let(s, parse_float_stripped))  # rare: kept out of the generated code


def parse_float_stripped(s: Column) -> Column:
    s = ascii_digits(s)
    low = F.lower(s)
    special = (F.when(low.contains("nan"), F.lit(float("nan")))
               .when(low.startswith("-"), F.lit(float("-inf")))
               .otherwise(F.lit(float("inf"))))
    return (F.when(s.rlike(SPECIAL_SHAPE), special)
            .when(s.rlike(FLOAT_SHAPE), F.regexp_replace(s, "_", "").try_cast("double")))


@by_name
def to_number(col: Column | str) -> Column:
    """numeric coercion for the master: unlike ``parse_float`` no digit
    separators, and a not-a-number text is a missing value."""
    c = _c(col)
    x = parse_float(c)
    return F.when(~c.contains("_") & ~F.isnan(x), x)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a Column would repeat it at every use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _two_product(a: Column, b: Column) -> tuple[Column, Column]:
    """a * b rounded, and what rounding took away (both exact, by halves of 26 bits)."""
    def halves(v: Column) -> tuple[Column, Column]:
        big = v * 134217729.0
        high = big - (big - v)
        return high, v - high
    (ah, al), (bh, bl), p = halves(a), halves(b), a * b
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _tie_digits(x: Column, seven: Column) -> Column:
    """``%.5e`` of a value whose shortest decimal is the seven digits ``seven``, the last one a 5:
    the exact product with a power of ten tells on which side of the tie it lies."""
    digits = F.replace(F.substring_index(seven, "e", 1), F.lit("."), F.lit("")).cast("long")
    exp = F.substring_index(seven, "e", -1).cast("int")

    def of(v: Column) -> Column:
        d, low, e = v["d"].cast("double"), F.floor(v["d"] / 10).cast("long"), v["e"]
        p, lost = _two_product(x, F.pow(F.lit(10.0), (F.lit(6) - e).cast("double")))
        q, rest = _two_product(d, F.pow(F.lit(10.0), (e - 6).cast("double")))
        side = F.when(e <= 6, (p - d) + lost).otherwise((x - q) - rest)  # negative below the tie
        return F.struct(F.when((side > 0) | ((side == 0) & (low % 2 == 1)), low + 1).otherwise(low).alias("n"), e.alias("e"))

    def text(v: Column) -> Column:
        n = F.when(v["n"] == 1000000, F.lit(100000)).otherwise(v["n"]).cast("string")
        e = F.when(v["n"] == 1000000, v["e"] + 1).otherwise(v["e"])
        return F.concat(F.substring(n, 1, 1), F.lit("."), F.substring(n, 2, 5), F.lit("e"), e.cast("string"))
    return _let(_let(F.struct(digits.alias("d"), exp.alias("e")), of), text)


def _six_digits(x: Column) -> Column:
    """``%.5e`` of a non-negative double, rounded on its exact binary value, ties to even.

    The JVM rounds the shortest decimal half up. The two differ only where that decimal
    has exactly seven digits and ends in 5 (decided exactly from 1e-16 to 1e28; beyond, such
    values round up). Subnormal values of fewer digits keep their shortest decimal."""
    def of(seven: Column) -> Column:
        tie = seven.contains("5e") & (seven.cast("double") == x) & F.substring_index(seven, "e", -1).cast("int").between(-16, 28)
        return F.when(tie, _tie_digits(x, seven)).otherwise(F.format_string("%.5e", x))
    return _let(F.format_string("%.6e", x), of)


@by_name
def fmt_g(col: Column | str) -> Column:
    """F8: Python ``format(x, 'g')`` (6 significant digits, zeros stripped)."""
    return _let(_c(col).cast("double"), lambda x: _let(_six_digits(F.abs(x)), lambda sci: _general(x, sci)))


def _general(x: Column, sci: Column) -> Column:
    mant = F.substring_index(sci, "e", 1)               # sci: d.ddddde[+-]XX
    exp = F.substring_index(sci, "e", -1).cast("int")
    digits = F.regexp_replace(mant, r"\.", "")         # six digits

    def joined(whole: Column, frac: Column) -> Column:
        f = F.regexp_replace(frac, "0+$", "")
        return F.when(f == "", whole).otherwise(F.concat(whole, F.lit("."), f))

    fixed = F.when(exp >= 0, joined(F.substring(digits, F.lit(1), exp + 1),
                                    F.substring(digits, exp + 2, F.lit(10))))
    fixed = fixed.otherwise(joined(F.lit("0"), F.concat(F.repeat(F.lit("0"), -exp - 1), digits)))
    m_stripped = F.regexp_replace(F.regexp_replace(mant, "0+$", ""), r"\.$", "")
    sci_txt = F.concat(m_stripped, F.lit("e"), F.when(exp < 0, "-").otherwise("+"),
                       F.when(F.abs(exp) < 10, "0").otherwise(""), F.abs(exp).cast("string"))
    body = F.when((exp >= -4) & (exp < 6), fixed).otherwise(sci_txt)
    negative = x.cast("string").startswith("-")          # keeps -0.0
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), "nan")
            .when(x == float("inf"), "inf")
            .when(x == float("-inf"), "-inf")
            .otherwise(F.concat(F.when(negative, "-").otherwise(""), body)))


def round_half_up(col: Column | str) -> Column:
    """commercial rounding of a non-negative value to an integer."""
    return F.floor(_c(col) + F.lit(0.5)).cast("int")


def round_cents(col: Column | str) -> Column:
    """numpy ``round(2)``: scale, round half to even, unscale."""
    return F.rint(_c(col) * 100.0) / 100.0


def norm_key(col: Column | str) -> Column:
    """synonym lookup key (Python strip + lower)."""
    return F.lower(py_strip(col))


def map_lookup(mapping: dict[str, str], key: Column) -> Column:
    """Literal map lookup; NULL when the key is absent."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def error_id(seq: Column | str) -> Column:
    """'E' + five-digit zero padded sequence (plain digits from 100000)."""
    n = _c(seq).cast("long")
    return F.concat(F.lit("E"), F.when(n < 100000, F.lpad(n.cast("string"), 5, "0"))
                    .otherwise(n.cast("string")))


def severity_action(col: Column | str) -> Column:
    """severity -> recommended action."""
    c = _c(col)
    return (F.when(c == "CRITICAL", "ACT").when(c == "MAJOR", "CHECK")
            .when(c == "MINOR", "OBSERVE"))
