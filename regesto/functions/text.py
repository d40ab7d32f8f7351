"""Text scalars. Every function maps Column -> Column with built-in
expressions only, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regesto.functions._util import col_of, let

# Characters a file name may not hold (backslash / * ? : " < > |).
UNSAFE_NAME_CLASS = r'[\\/*?:"<>|]'
# The Lazio variant keeps slashes apart (they become '-').
UNSAFE_NAME_CLASS_NO_SLASH = r'[*:?"<>|]'


# a run of white space that is not one plain space already: most of a text's runs are, and need no writing
WS_RX = r"(?U) \s+|[\s&&[^ ]]\s*+"


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def norm_ws(c) -> Column:
    """TXT-1: collapse every whitespace run (NBSP included) to one space, trim; NULL -> ''."""
    return F.trim(F.regexp_replace(F.coalesce(col_of(c), F.lit("")), WS_RX, " "))


def safe_name_underscore(c) -> Column:
    """TXT-2: unsafe file-name characters become '_'."""
    return F.regexp_replace(col_of(c), UNSAFE_NAME_CLASS, "_")


def safe_name_delete(c, trim: bool = False) -> Column:
    """TXT-3: delete unsafe file-name characters (Veneto also trims)."""
    out = F.regexp_replace(col_of(c), UNSAFE_NAME_CLASS, "")
    return strip_ws(out) if trim else out


def safe_name_50(c) -> Column:
    """TXT-4: delete unsafe characters, newline -> space, trim, first 50 characters."""
    cleaned = strip_ws(F.replace(F.regexp_replace(col_of(c), UNSAFE_NAME_CLASS, ""), F.lit("\n"), F.lit(" ")))
    return F.left(cleaned, F.lit(50))


def safe_name_spaces(c) -> Column:
    """TXT-5: slashes -> '-', delete * : ? " < > |, collapse whitespace; empty -> 'Unknown'."""
    def clean(v):
        x = F.translate(v, "/\\", "--")
        x = F.regexp_replace(x, UNSAFE_NAME_CLASS_NO_SLASH, "")
        x = F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
        return F.when(v.isNull() | (v == ""), F.lit("Unknown")).otherwise(x)

    return let(c, clean)


def norm_quotes(c) -> Column:
    """TXT-6: lower case; right/left curly quote and backtick become a plain apostrophe."""
    return F.translate(F.lower(col_of(c)), "’`‘", "'''")


def truncate_title(c, n: int) -> Column:
    """TXT-7: first n characters."""
    return F.left(col_of(c), F.lit(n))


def strip_phrase(c, phrase: str) -> Column:
    """TXT-8: remove every occurrence of a literal label."""
    return F.replace(col_of(c), F.lit(phrase), F.lit(""))


def cap_month(c) -> Column:
    """TXT-9: Python ``str.capitalize``: first character upper, the rest lower."""
    return let(c, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30))))


def zfill2(c) -> Column:
    """TXT-10: left-pad with '0' to 2 characters, never truncating longer input."""
    return let(col_of(c).cast("string"), lambda x: F.lpad(x, F.greatest(F.lit(2), F.length(x)), "0"))


def to_int_or_null(c) -> Column:
    """TXT-11: integer value of a digit string, NULL otherwise."""
    return let(F.trim(col_of(c)), lambda d: F.when(d.rlike(r"^[0-9]{1,9}$"), d.cast("int")))


# line boundaries of Python ``str.splitlines``
LINE_BREAK_RX = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def lines_split(c) -> Column:
    """TXT-12: stripped, non-empty lines of a text (array, in order)."""
    return F.filter(F.transform(F.split(col_of(c), LINE_BREAK_RX), strip_ws), lambda s: s != "")


def first_title_line(c, min_len: int = 20, skip_prefix: str = "legge regionale") -> Column:
    """HTM-14: first line longer than ``min_len`` not starting with ``skip_prefix`` (any case), else ''."""
    good = F.filter(
        lines_split(c), lambda s: ~F.lower(s).startswith(skip_prefix) & (F.length(s) > min_len)
    )
    return F.coalesce(F.try_element_at(good, F.lit(1)), F.lit(""))
