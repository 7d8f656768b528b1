"""Column-expression helpers (all native Spark expressions, no UDFs).

These reproduce a few Python string/number conventions exactly with built-in
functions so that whole-stage codegen and predicate pushdown survive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace set (str.isspace), as a Java regex class.
PY_WS = "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"

# Token pieces: numbers (with inner . or ,), words, other numerics, a newline,
# a run of 2+ blanks, one blank, or any other single character.  Joined back
# together the pieces are the text again; every piece but the single blank is a
# token, so newlines and blank runs break phrases.
PIECE_PATTERN = (
    "[0-9]+(?:[.,][0-9]+)*"
    "|[\\p{L}\\p{M}_][\\p{L}\\p{M}\\p{N}_]*"
    "|\\p{N}+"
    "|\\n"
    "| {2,}"
    "| "
    "|[^\\p{L}\\p{M}\\p{N}_]"
)
# The same tokens without the single-blank pieces (RE2-compatible form used by
# the SQL oracle as well).
TOKEN_PATTERN = (
    "[0-9]+(?:[.,][0-9]+)*"
    "|[\\p{L}\\p{M}_][\\p{L}\\p{M}\\p{N}_]*"
    "|\\p{N}+"
    "| {2,}"
    "|[^\\p{L}\\p{M}\\p{N}_ ]"
)

# Python float() grammar (after strip): sign, digits with single underscores,
# optional fraction and exponent, or inf / infinity / nan.
_DIGITS = "[0-9](?:_?[0-9])*"
PY_FLOAT_PATTERN = (
    "(?i)^[+-]?(?:(?:" + _DIGITS + "(?:\\.(?:" + _DIGITS + ")?)?|\\." + _DIGITS + ")"
    "(?:e[+-]?" + _DIGITS + ")?|inf|infinity|nan)$"
)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``.  A named column whose first and last characters are visible ASCII is
    returned as it is, without a pattern search (an expression would be evaluated once a mention)."""
    s = col_(c)
    searched = F.regexp_replace(s, f"^{PY_WS}+|{PY_WS}+$", "")
    if not isinstance(c, str):
        return searched
    return F.when(F.ascii(s).between(33, 126) & F.ascii(F.substring(s, -1, 1)).between(33, 126), s).otherwise(searched)


def pieces(text) -> Column:
    """Lossless token pieces of a text (array<string>)."""
    return F.regexp_extract_all(col_(text), F.lit(PIECE_PATTERN), 0)


def py_float(c) -> Column:
    """Python ``float(s)`` for an already stripped string; null when it raises."""
    s = col_(c)
    return F.when(s.rlike(PY_FLOAT_PATTERN), F.replace(s, F.lit("_"), F.lit("")).cast("double"))


def normalize_key(c) -> Column:
    """strip -> casefold -> blanks to underscores."""
    return F.replace(F.lower(py_strip(c)), F.lit(" "), F.lit("_"))


def title_case(c) -> Column:
    """Python ``str.title()``: capital after every non-letter."""
    runs = F.regexp_extract_all(F.lower(col_(c)), F.lit("(\\p{L}+|\\P{L}+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))),
        "",
    )


def percent0(c) -> Column:
    """Python ``f"{x:.0%}"`` (round half to even on x*100)."""
    return F.concat(F.bround(col_(c) * F.lit(100.0), 0).cast("long").cast("string"), F.lit("%"))


def let(value: Column, fn) -> Column:
    """Bind ``value`` once and use it many times inside ``fn`` (a one-element
    ``transform``), so a large sub-expression is not copied per reference."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _java_digits(a: Column) -> Column:
    """Java double text (123.45 / 1.2345E7) -> struct(d digits, e exponent)."""
    has_e = F.instr(a, "E") > 0
    mant = F.substring_index(a, "E", 1)
    jexp = F.when(has_e, F.substring_index(a, "E", -1).cast("int")).otherwise(F.lit(0))
    return let(F.struct(F.substring_index(mant, ".", 1).alias("i"), F.substring_index(mant, ".", -1).alias("f"),
                        jexp.alias("x")), lambda m: F.struct(
        F.regexp_replace(F.regexp_replace(F.concat(m["i"], m["f"]), "^0+", ""), "(?<=.)0+$", "").alias("d"),
        F.when(m["i"] != "0", F.length(m["i"]) - 1 + m["x"])
        .otherwise(m["x"] - F.length(F.regexp_extract(m["f"], "^0*", 0)) - 1).alias("e")))


def _sci_digits(av: Column) -> Column:
    """Shortest of 13..17 significant digits that round-trips -> struct(d, e)."""
    sci = None
    for k in range(12, 17):
        cand = F.format_string(f"%.{k}e", av)
        hit = cand.cast("double") == av
        sci = F.when(hit, cand) if sci is None else sci.when(hit, cand)
    return let(sci, lambda s: F.struct(
        F.regexp_replace(F.replace(F.substring_index(s, "e", 1), F.lit("."), F.lit("")), "(?<=.)0+$", "").alias("d"),
        F.substring_index(s, "e", -1).cast("int").alias("e")))


def py_float_str(c) -> Column:
    """Python ``str(float)``: shortest digits that parse back to the same
    double, printed positionally for 1e-4 <= |x| < 1e16, else in exponent
    form.  Java's own digits are used when they are at most 15 long; longer
    ones (where JDK 17 is not always shortest) are retried as ``%.{k}e``
    with 13..17 significant digits, first round trip wins.  Java's text of at
    most 15 digits between 1e-3 and 1e7 is Python's as it stands, unless a zero
    trails in it."""

    def body(v):
        av = F.abs(v)
        de = let(_java_digits(av.cast("string")), lambda j: F.when(F.length(j["d"]) <= 15, j).otherwise(_sci_digits(av)))
        neg = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
        return (
            F.when(F.isnan(v), F.lit("nan"))
            .when(v == float("inf"), F.lit("inf"))
            .when(v == float("-inf"), F.lit("-inf"))
            .when(v == 0, v.cast("string"))
            .otherwise(F.concat(neg, let(de, lambda x: _from_digits(x["d"], x["e"]))))
        )

    v = col_(c).cast("double")
    text = v.cast("string")
    plain = (F.abs(v) >= 1e-3) & (F.abs(v) < 1e7) & (F.length(text) <= 16) & (text.endswith(".0") | ~text.endswith("0"))
    return F.when(plain, text).otherwise(let(v, body))


def _from_digits(digits: Column, exp: Column) -> Column:
    nd = F.length(digits)
    # positional, exp >= 0
    int_part = F.rpad(digits, F.greatest(exp + 1, nd), "0").substr(F.lit(1), exp + 1)
    rest = F.when(nd > exp + 1, digits.substr(exp + 2, F.lit(1 << 30))).otherwise(F.lit("0"))
    positional_pos = F.concat(int_part, F.lit("."), rest)
    # positional, -4 <= exp < 0
    positional_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    # scientific: d[.ddd]e+XX
    sci_m = F.when(nd > 1, F.concat(digits.substr(1, 1), F.lit("."), digits.substr(F.lit(2), F.lit(1 << 30)))).otherwise(digits)
    sci_e = F.concat(
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exp) < 10, F.concat(F.lit("0"), F.abs(exp).cast("string"))).otherwise(F.abs(exp).cast("string")),
    )
    sci = F.concat(sci_m, F.lit("e"), sci_e)
    return (
        F.when((exp >= 0) & (exp < 16), positional_pos)
        .when((exp < 0) & (exp >= -4), positional_neg)
        .otherwise(sci)
    )


def value_text(value_text_col, value_num_col) -> Column:
    """``str(value)`` of the text/number duality (number wins when set)."""
    return F.when(col_(value_num_col).isNotNull(), py_float_str(value_num_col)).otherwise(col_(value_text_col))
