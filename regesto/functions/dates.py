"""Date scalars.

Italian dates are found by regex and mapped through a month literal map
(constant-folded by Catalyst), then built with ``try_to_date`` so a bad day
gives NULL under ANSI mode instead of failing the task.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from regesto.functions._util import col_of, let, nz
from regesto.functions.text import norm_ws, safe_name_delete

# Month names in calendar order.
IT_MONTHS = [
    "gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno",
    "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre",
]
EN_MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

IT_MONTH_ALT = "|".join(IT_MONTHS)
# day, optional ordinal mark, Italian month, year
IT_DATE_RX = rf"(?iU)(\d{{1,2}})[°º]?\s+({IT_MONTH_ALT})\s+(\d{{4}})"
SLASH_DATE_RX = r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})"
STRICT_SLASH_DATE_RX = r"(\d{2})/(\d{2})/(\d{4})"


def month_map(english: bool = False) -> Column:
    """JON-5 as an expression: lower-case month name -> month number (a folded literal map)."""
    names = IT_MONTHS + EN_MONTHS if english else IT_MONTHS
    return F.create_map(*chain.from_iterable((F.lit(n), F.lit(i % 12 + 1)) for i, n in enumerate(names)))


def month_number(name, english: bool = False) -> Column:
    return F.element_at(month_map(english), F.lower(col_of(name)))


def make_date(y, m, d) -> Column:
    """DATE from parts (strings or ints); NULL if any part is missing/empty or the date is invalid
    (``concat`` of a missing part is NULL: a text without a date is not parsed, which would fail inside)."""
    s = F.concat(col_of(y).cast("string"), F.lit("-"), col_of(m).cast("string"), F.lit("-"), col_of(d).cast("string"))
    return F.try_to_date(s, "yyyy-M-d")


def it_date(c) -> Column:
    """DAT-1 / DAT-3: first Italian textual date (``1°`` accepted) as DATE."""
    return _matched(c, IT_DATE_RX, lambda x: make_date(
        F.regexp_extract(x, IT_DATE_RX, 3),
        month_number(F.regexp_extract(x, IT_DATE_RX, 2)),
        F.regexp_extract(x, IT_DATE_RX, 1),
    ))


def _matched(c, pattern: str, fn) -> Column:
    """``fn`` of the first match: the text is searched once, the short match again for its parts; NULL
    without one, as there is no date to parse."""
    return let(F.regexp_extract(col_of(c), pattern, 0), lambda m: F.when(m != F.lit(""), fn(m)))


def ordinal_day(c) -> Column:
    """DAT-3: drop the ordinal mark after a day number (``1°`` -> ``1``); every date parser here
    already accepts it, this is for display text."""
    return F.regexp_replace(col_of(c), r"(\d)[°º]", "$1")


def slash_date(c, strict: bool = False) -> Column:
    """DAT-2: ``dd/mm/yyyy`` (also ``-`` and ``.``) as DATE; ``strict`` wants two-digit ``/`` only."""
    rx = STRICT_SLASH_DATE_RX if strict else SLASH_DATE_RX
    return _matched(c, rx, lambda x: make_date(F.regexp_extract(x, rx, 3), F.regexp_extract(x, rx, 2), F.regexp_extract(x, rx, 1)))


def any_date(c) -> Column:
    """DAT-4: textual Italian date first, then numeric."""
    return let(c, lambda x: F.coalesce(it_date(x), slash_date(x)))


# Trentino-style patterns: numeric, then "d month yyyy", then "month d, yyyy" (IT and EN months)
_BI_NUM = r"(\d{1,2})[./-](\d{1,2})[./-](\d{4})"
_BI_DMY = r"(\d{1,2})\s+([a-zA-Z]+)\s+(\d{4})"
_BI_MDY = r"([a-zA-Z]+)\s+(\d{1,2}),?\s+(\d{4})"


def bilingual_date(c) -> Column:
    """DAT-5: the first pattern that *matches* decides; an unknown month word gives NULL."""
    cleaned = F.trim(F.replace(F.replace(col_of(c), F.lit("Data"), F.lit("")), F.lit("\n"), F.lit(" ")))

    def parse(x):
        num = make_date(F.regexp_extract(x, _BI_NUM, 3), F.regexp_extract(x, _BI_NUM, 2), F.regexp_extract(x, _BI_NUM, 1))
        dmy = make_date(F.regexp_extract(x, _BI_DMY, 3), month_number(F.regexp_extract(x, _BI_DMY, 2), english=True),
                        F.regexp_extract(x, _BI_DMY, 1))
        mdy = make_date(F.regexp_extract(x, _BI_MDY, 3), month_number(F.regexp_extract(x, _BI_MDY, 1), english=True),
                        F.regexp_extract(x, _BI_MDY, 2))
        return F.when(x.rlike(_BI_NUM), num).when(x.rlike(_BI_DMY), dmy).otherwise(mdy)

    return let(cleaned, parse)


def it_month_name(d) -> Column:
    """Italian month name of a DATE."""
    return F.try_element_at(F.array(*[F.lit(m) for m in IT_MONTHS]), F.month(col_of(d)))


def date_display(d, style: str) -> Column:
    """DAT-6: render a DATE.

    styles: ``dmy`` dd/MM/yyyy, ``dmy_dash`` dd-MM-yyyy, ``iso`` yyyy-MM-dd,
    ``d_month`` d mese yyyy, ``d_Month`` d Mese yyyy, ``dd_month`` dd mese yyyy,
    ``d_english`` d Month yyyy in English (the C-locale ``%B`` of two scripts).
    """
    if style not in ("dmy", "dmy_dash", "iso", "d_english"):
        return let(d, lambda v: _date_display(v, style))
    return _date_display(col_of(d), style)


def _date_display(x: Column, style: str) -> Column:
    if style == "dmy":
        return F.date_format(x, "dd/MM/yyyy")
    if style == "dmy_dash":
        return F.date_format(x, "dd-MM-yyyy")
    if style == "iso":
        return F.date_format(x, "yyyy-MM-dd")
    if style == "d_english":
        return F.date_format(x, "d MMMM yyyy")
    day = F.date_format(x, "dd" if style == "dd_month" else "d")
    mon = it_month_name(x)
    if style == "d_Month":
        mon = F.initcap(mon)
    elif style not in ("d_month", "dd_month"):
        raise ValueError(f"unknown date style {style!r}")
    return F.when(x.isNotNull(), F.concat_ws(" ", day, mon, F.year(x).cast("string")))


YEAR_RX = r"(20\d{2}|19\d{2})"


def date_or_year(d, title=None, year=None) -> Column:
    """DAT-7: fall back to 1 January of a year found in the title, then of a given year."""
    parts = [col_of(d)]
    if title is not None:
        parts.append(make_date(nz(F.regexp_extract(col_of(title), YEAR_RX, 1)), F.lit(1), F.lit(1)))
    if year is not None:
        parts.append(make_date(col_of(year), F.lit(1), F.lit(1)))
    return F.coalesce(*parts)


def first_date(arr, parser=any_date) -> Column:
    """DAT-8: first array element that parses to a date."""
    return F.try_element_at(F.filter(F.transform(col_of(arr), parser), lambda v: v.isNotNull()), F.lit(1))


def date_passthrough(d, raw, style: str = "dmy", dashed: bool = False) -> Column:
    """DAT-9: formatted date, else the cleaned raw text (FVG) or its sanitised dashed form (Veneto)."""
    fallback = norm_ws(raw)
    if dashed:
        fallback = F.replace(safe_name_delete(col_of(raw)), F.lit(" "), F.lit("-"))
    return F.coalesce(date_display(d, style), fallback)


def dash_date(c, chars: str = "/ ") -> Column:
    """DAT-10: slashes (FVG) or spaces (Marche) to '-' for file names."""
    return F.translate(col_of(c), chars, "-" * len(chars))
