"""Law-number and header scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regesto.functions._util import col_of, let, rx
from regesto.functions.dates import IT_MONTH_ALT, any_date, it_date, slash_date

# The law-number patterns.
STRICT_NO_RX = r"(?i)n\.\s*(\d+)"
LOOSE_NO_RX = r"(?i)n\.?\s*(\d+)"
ONE_SPACE_NO_RX = r"(?i)n\.\s?(\d+)"
ALT_NO_RX = r"(?i)(?:n\.|num\.|numero)\s*(\d+)"
LEGGE_NO_RX = r"(?i)(?:legge|l\.)\s+(\d+)"
REGIONALE_NO_RX = r"(?i)regionale\s+(\d+)"
LINK_NO_RX = r"-(\d+)\."


def law_no(c, loose: bool = False) -> Column:
    """NUM-1: first ``n.`` number, strict ``n\\.\\s*(\\d+)`` or loose ``n\\.?\\s*(\\d+)`` (string, NULL if none)."""
    return rx(c, LOOSE_NO_RX if loose else STRICT_NO_RX)


def law_no_chain(*candidates: Column) -> Column:
    """NUM-2: first non-NULL of candidate extractions, in the given order."""
    return F.coalesce(*candidates)


def law_no_text_chain(c) -> Column:
    """NUM-2 over one text: strict ``n.``, loose ``n``, ``legge N``/``l. N``, ``regionale N``.

    Strict comes before loose (quirk Q6: the loose form also matches any word ending in n)."""
    return law_no_chain(rx(c, STRICT_NO_RX), rx(c, LOOSE_NO_RX), rx(c, LEGGE_NO_RX), rx(c, REGIONALE_NO_RX))


def law_no_alt(c) -> Column:
    """NUM-3: ``n.``, ``num.`` or ``numero`` followed by digits."""
    return rx(c, ALT_NO_RX)


def cell_number(c) -> Column:
    """NUM-4: a table cell that *is* a number: under 15 chars, no '/', whole text ``[n[.][ ]]digits``."""
    def pick(x):
        ok = (F.length(x) < 15) & ~x.contains("/") & F.lower(x).rlike(r"^(n\.? ?)?\d+$")
        return F.when(ok, F.regexp_extract(x, r"(\d+)", 1))

    return let(F.trim(col_of(c)), pick)


# HDR-1 "<d[°] mese yyyy> ... n. <no>" and HDR-2 "n. <no> del <date>" (``numero`` too).
HDR1_RX = rf"(?iU)(\d{{1,2}}[°º]?\s+(?:{IT_MONTH_ALT})\s+\d{{4}}).*?(?:n\.|numero)\s*(\d+)"
HDR2_RX = rf"(?iU)(?:n\.|numero)\s*(\d+)\s+del\s+(\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}}[°º]?\s+(?:{IT_MONTH_ALT})\s+\d{{4}})"


def header_date_no(c) -> Column:
    """HDR-1 as struct(law_date DATE, law_no STRING, date_text STRING); all NULL on no match."""
    # the text is scanned once, the short match again for its parts
    return let(rx(c, HDR1_RX, 0), lambda x: let(rx(x, HDR1_RX, 1), lambda dtext: F.struct(
        it_date(dtext).alias("law_date"), rx(x, HDR1_RX, 2).alias("law_no"), dtext.alias("date_text"))))


def header_no_date(c) -> Column:
    """HDR-2 as struct(law_date, law_no, date_text)."""
    return let(rx(c, HDR2_RX, 0), lambda x: let(rx(x, HDR2_RX, 2), lambda dtext: F.struct(
        F.coalesce(slash_date(dtext), it_date(dtext)).alias("law_date"),
        rx(x, HDR2_RX, 1).alias("law_no"),
        dtext.alias("date_text"),
    )))


def header_fields(c) -> Column:
    """HDR-1, and only when it does not match, HDR-2 (the first pattern that matches decides)."""
    return let(c, lambda x: let(rx(x, HDR1_RX, 0), lambda m: F.when(m.isNotNull(), header_date_no(m)).otherwise(header_no_date(x))))


__all__ = [
    "law_no", "law_no_chain", "law_no_text_chain", "law_no_alt", "cell_number",
    "header_date_no", "header_no_date", "header_fields", "any_date",
]
