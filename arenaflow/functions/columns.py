"""Column builders shared by the operators.

All of them compose built-in ``pyspark.sql.functions`` so they stay inside
whole-stage code generation; none calls back into Python.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Record field separator (U+0001) and the spellings of a missing
# version that count as "no value".
FIELD_SEPARATOR = "\u0001"
NULL_SPELLINGS = ("null", "Null", "NULL")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(logtime="logtime") -> Column:
    """``yyyy-MM-dd`` key of a ``yyyy-MM-dd HH:mm:ss`` log time (first 10 characters)."""
    return F.substring(_col(logtime), 1, 10)


def month_key(pt_dt="pt_dt") -> Column:
    """``yyyy-MM`` key of a date key (first 7 characters)."""
    return F.substring(_col(pt_dt), 1, 7)


def _successor(text: str) -> str:
    """Smallest string greater than every string that starts with ``text``."""
    return text[:-1] + chr(ord(text[-1]) + 1)


def date_range(logtime, start: str, end: str, pushable: bool = True) -> Column:
    """Inclusive ``start <= date_key(logtime) <= end`` on ISO date strings.

    ``substr`` is opaque to source filter pushdown.  For 10-character bounds the
    test is rewritten exactly as ``start <= logtime < successor(end)`` on the raw
    column, for any string: a string is not smaller than its first ten
    characters, and a string whose first ten characters exceed ``end`` cannot
    sort below ``successor(end)``.  The bound reaches Parquet row-group
    statistics and JSON parsing, and the substring is never evaluated.
    Other bounds (or ``pushable=False``) use the substring form.
    """
    c = _col(logtime)
    if pushable and len(start) == 10 and len(end) == 10 and end[-1] < "\uffff":
        return (c >= F.lit(start)) & (c < F.lit(_successor(end)))
    key = F.substring(c, 1, 10)
    return (key >= F.lit(start)) & (key <= F.lit(end))


def valid_version(kv="keyversion") -> Column:
    """The version if it is a usable value, else NULL.

    Missing: NULL, ``''``, only spaces, or ``null``/``Null``/``NULL`` after
    trimming spaces.  Only the space character is trimmed (a tab stays), and the
    value kept is the untrimmed one.
    """
    c = _col(kv)
    trimmed = F.trim(c)
    return F.when(~trimmed.isin("", *NULL_SPELLINGS), c)


@lru_cache(maxsize=1)
def python_whitespace_class() -> str:
    """Regex character class of every code point for which ``str.isspace()`` holds.

    Built from the rule rather than listed, written with ``\\x{h}`` escapes that
    both Java regex and RE2 accept.
    """
    cps = [cp for cp in range(sys.maxunicode + 1) if chr(cp).isspace()]
    ranges = []
    for cp in cps:
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:04X}}}" if lo == hi else f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}")
    return "[" + "".join(parts) + "]"


def valid_version_ws(kv="keyversion") -> Column:
    """Stricter validity of the grouped-aggregate variant.

    Missing: NULL, ``''``, text made only of white space (any code point for
    which ``str.isspace()`` holds), or ``null``/``Null``/``NULL`` once all such
    white space is stripped from both ends.
    """
    c = _col(kv)
    ws = python_whitespace_class()
    stripped = F.regexp_replace(c, f"^{ws}+|{ws}+$", "")
    missing = c.isNull() | (c == "") | c.rlike(f"^{ws}+$") | stripped.isin(*NULL_SPELLINGS)
    return F.when(missing, F.lit(None).cast("string")).otherwise(c)


def first_valid(values: Column) -> Column:
    """Deterministic "first non-NULL value" of a group: the minimum.

    The original picks an arbitrary element of an unordered list; any non-NULL
    choice is valid, and ``min`` makes it reproducible, keeps O(1) state per
    group (no list buffering for a hot group) and combines map-side.
    """
    return F.min(values)


def null_to_empty(c) -> Column:
    """Text form of a value with NULL mapped to ``''`` so a packed record keeps positions."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def plain_decimal(c, scale: int) -> Column:
    """Text of a decimal of that scale, in any SQL mode: no exponent, no zeros at the end of the fraction."""
    text = F.replace(F.format_number(_col(c), scale), F.lit(","), F.lit(""))
    return F.regexp_replace(text, r"\.?0+$", "") if scale else text


def number_text(c) -> Column:
    """Text form of a double that reads back as the same double.

    Without a fraction when it is integral, without an exponent where 38 digits (18 of them after the
    point) hold it; any other value in Spark's own text form (``1.0E40``).
    """
    n = _col(c)
    whole, part = n.try_cast("decimal(38,0)"), n.try_cast("decimal(38,18)")
    return (
        F.when(whole.cast("double") == n, plain_decimal(whole, 0))
        .when(part.cast("double") == n, plain_decimal(part, 18))
        .otherwise(n.cast("string"))
    )


def pack(*cols) -> Column:
    """U+0001-joined positional record; every field goes through :func:`null_to_empty`."""
    return F.concat_ws(FIELD_SEPARATOR, *[null_to_empty(c) for c in cols])


def pack_record(df: DataFrame, fields: Sequence[str]) -> Column:
    """:func:`pack` of columns of ``df``, its doubles in the form of :func:`number_text`."""
    types = dict(df.dtypes)
    return pack(*(number_text(f) if types[f] == "double" else f for f in fields))


def compact_to_iso(c) -> Column:
    """``YYYYMMDD`` -> ``YYYY-MM-DD`` by slicing characters 1-4, 5-6, 7-8 (no validation)."""
    s = _col(c)
    return F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))


def compact_to_iso_checked(c) -> Column:
    """Validated conversion: NULL for text that is not a calendar date in ``YYYYMMDD``."""
    return F.date_format(F.try_to_date(_col(c), "yyyyMMdd"), "yyyy-MM-dd")


def iso_to_compact(c) -> Column:
    """ISO date to the compact path form (dashes removed)."""
    return F.replace(_col(c), F.lit("-"), F.lit(""))
