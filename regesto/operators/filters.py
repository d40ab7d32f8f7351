"""Filters and predicates.  All are plain ``filter``s, so they stay in
the scan's whole-stage-codegen span and column predicates can reach Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions._util import col_of, let
from regesto.functions.text import norm_quotes

# The strict repeal mark (parenthesised "Abrogata", any case and spacing).
STRICT_REPEAL_RX = r"(?iU)\(\s*Abrogata\s*\)"

# Repeal phrases of the phrase rule, in their published order.
REPEAL_PHRASES = [
    "(abrogato dalla l.r.",
    "(abrogata dall'art.",
    "(legge abrogata dall'art",
    "(abrogato dall'art.",
    "(regolamento abrogato dall'art.",
    "(abrogata, a decorrere dal",
    "(Abrogata dal",
]


def is_repealed_strict(c) -> Column:
    return col_of(c).rlike(STRICT_REPEAL_RX)


def drop_repealed_strict(df: DataFrame, text: str = "text") -> DataFrame:
    """PRD-1: drop a row iff its text holds ``(Abrogata)`` (any case, any inner spacing)."""
    return df.filter(~F.coalesce(is_repealed_strict(text), F.lit(False)))


def is_repealed_phrase(c, phrases=REPEAL_PHRASES) -> Column:
    """PRD-2 predicate: quote-normalised lower text contains a listed phrase.

    Both sides are lower-cased (quirk Q3: one listed phrase has a capital and
    could never match lower-cased text)."""
    return let(norm_quotes(c), lambda t: reduce(lambda a, b: a | b, [t.contains(p.lower()) for p in phrases]))


def drop_repealed_phrases(df: DataFrame, text: str = "text", phrases=REPEAL_PHRASES) -> DataFrame:
    """PRD-2."""
    return df.filter(~F.coalesce(is_repealed_phrase(text, phrases), F.lit(False)))


# The first bytes of a PDF file.
PDF_MAGIC = b"%PDF"


def is_valid_capture(status="status", body="body", content_type=None) -> Column:
    """PRD-3 predicate: HTTP 200 and a PDF body (magic ``%PDF``), or a content type naming
    ``application/pdf``; never NULL.  A file whose status was never captured counts by its body."""
    is_pdf = F.substring(col_of(body), 1, 4) == F.lit(PDF_MAGIC)
    if content_type is not None:
        is_pdf = is_pdf | F.lower(F.coalesce(col_of(content_type), F.lit(""))).contains("application/pdf")
    return F.coalesce((F.coalesce(col_of(status), F.lit(200)) == 200) & is_pdf, F.lit(False))


def valid_capture(df: DataFrame, status: str = "status", body: str = "body", content_type: str | None = None) -> DataFrame:
    """PRD-3."""
    return df.filter(is_valid_capture(status, body, content_type))


def min_size(df: DataFrame, payload: str = "body", n: int = 2000) -> DataFrame:
    """PRD-4: payload strictly over ``n`` bytes."""
    return df.filter(F.octet_length(col_of(payload)) > n)


def year_of_text(c) -> Column:
    """The year a text *is* (all digits), else the first ``19xx``/``20xx`` standing as a word."""
    t = F.trim(col_of(c))
    whole = F.when(t.rlike(r"^[0-9]{1,9}$"), t.cast("int"))
    found = F.nullif(F.regexp_extract(t, r"\b(19\d{2}|20\d{2})\b", 1), F.lit("")).cast("int")
    return F.coalesce(whole, found)


def valid_year(df: DataFrame, text: str, lo: int, hi: int, lo_inclusive: bool = True, out: str = "year") -> DataFrame:
    """PRD-5: keep rows whose text is a year within [lo, hi] (or (lo, hi]); adds the year column."""
    y = year_of_text(text)
    lower = (y >= lo) if lo_inclusive else (y > lo)
    return df.withColumn(out, y).filter(lower & (F.col(out) <= hi))


def in_categories(df: DataFrame, col: str, allow) -> DataFrame:
    """PRD-6: allow-list; an empty list keeps everything.  A DataFrame allow-list is a semi join."""
    if isinstance(allow, DataFrame):
        key = allow.columns[0]
        return df.join(allow.select(F.col(key).alias("__allow")).distinct(), F.col(col) == F.col("__allow"), "left_semi")
    allow = list(allow)
    if not allow:
        return df
    return df.filter(F.col(col).isin(allow))


def require_fields(df: DataFrame, cols) -> DataFrame:
    """PRD-7: keep only rows where every field was found (not NULL, not blank)."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in cols])
    return df.filter(cond)


def text_filter(df: DataFrame, text: str, contains: str | None = None, not_startswith: str | None = None,
                no_leading_digit: bool = False, min_len: int | None = None, ignore_case: bool = True) -> DataFrame:
    """PRD-8: contains / does not start with / does not start with a digit / longer than ``min_len``."""
    t = col_of(text)
    low = F.lower(t) if ignore_case else t
    cond = F.lit(True)
    if contains is not None:
        cond = cond & low.contains(contains.lower() if ignore_case else contains)
    if not_startswith is not None:
        cond = cond & ~low.startswith(not_startswith.lower() if ignore_case else not_startswith)
    if no_leading_digit:
        cond = cond & ~t.rlike(r"^\d")
    if min_len is not None:
        cond = cond & (F.length(t) > min_len)
    return df.filter(F.coalesce(cond, F.lit(False)))


def successful_only(df: DataFrame, status: str = "status", value: str = "Success") -> DataFrame:
    """PRD-9: index only the rows whose status is the success value."""
    return df.filter(F.col(status) == value)
