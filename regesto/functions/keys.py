"""Keys, file names and conditional columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions._util import col_of, nz, rx
from regesto.functions.urls import query_param


def law_filename(prefix, no, date_key, ext: str = ".pdf", sep: str = "_") -> Column:
    """KEY-1: ``<prefix>_<no>_<date>.pdf``; ``prefix`` may be a literal or a Column."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(F.concat_ws(sep, p, col_of(no).cast("string"), col_of(date_key).cast("string")), F.lit(ext))


def fallback_key(no, url, param: str = "id", unknown: str = "Unknown") -> Column:
    """KEY-2: the number if found, else ``ID_<param>`` from the URL, else ``Unknown``."""
    pid = query_param(url, param)
    return F.coalesce(col_of(no), F.when(pid.isNotNull(), F.concat(F.lit("ID_"), pid)), F.lit(unknown))


def doc_language(href) -> Column:
    """KEY-3: ``_it``/``-it.`` -> IT; ``_st``/``-st.``/``_de`` -> DE; else DOC (tested in this order)."""
    t = F.lower(col_of(href))
    return (
        F.when(t.contains("_it") | t.contains("-it."), F.lit("IT"))
        .when(t.contains("_st") | t.contains("-st.") | t.contains("_de"), F.lit("DE"))
        .otherwise(F.lit("DOC"))
    )


FILENAME_RX = r"^(.*?)_(.*)_(\d{4})-(\d{2})-(\d{2})\.pdf$"


def parse_filename(name) -> Column:
    """KEY-4: read region, number and ISO date back from ``Region_No_yyyy-mm-dd.pdf``."""
    n = col_of(name)
    return F.struct(
        rx(n, FILENAME_RX, 1).alias("region"),
        rx(n, FILENAME_RX, 2).alias("law_number"),
        F.try_to_date(
            F.concat_ws("-", rx(n, FILENAME_RX, 3), rx(n, FILENAME_RX, 4), rx(n, FILENAME_RX, 5)), "yyyy-MM-dd"
        ).alias("law_date"),
        rx(n, FILENAME_RX, 3).cast("int").alias("year"),
    )


# Sentinels the regional indexes write for a missing date or number.
DATE_SENTINELS = [
    "0000-00-00", "01/01/1900", "00/00/0000", "N/A", "NA", "UnknownDate",
    "Unknown_Date", "Unknown Date", "unknown_date", "",
]
NUMBER_SENTINELS = ["0", "Unknown", "NA", "N/A", ""]


def fill_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """CND-1: replace NULL by the region's sentinel (``na.fill`` on string columns)."""
    return df.na.fill(defaults)


def null_sentinels(c, sentinels=None) -> Column:
    """CND-1 inverse: a sentinel display value back to NULL."""
    x = col_of(c)
    vals = DATE_SENTINELS if sentinels is None else sentinels
    return F.when(~F.trim(x).isin(vals), x)


def derive_status(exists=None, has_document=None, http_status=None, ok=None, detail=None) -> Column:
    """CND-2: status from facts.

    ``Skipped (Exists)`` when the file is there; ``No PDF`` when the page offers none;
    ``Downloaded`` when the transfer was good; ``Failed (<code or detail>)`` when it
    was attempted and bad; ``Pending`` when nothing is known yet.
    """
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    if exists is not None:
        out = out.when(col_of(exists), F.lit("Skipped (Exists)"))
    if has_document is not None:
        out = out.when(~col_of(has_document), F.lit("No PDF"))
    if ok is not None:
        out = out.when(col_of(ok), F.lit("Downloaded"))
    failed_bits = []
    if http_status is not None:
        failed_bits.append(col_of(http_status).cast("string"))
    if detail is not None:
        failed_bits.append(col_of(detail))
    if failed_bits:
        reason = F.coalesce(*failed_bits)
        attempted = reason.isNotNull() if ok is None else col_of(ok).isNotNull()
        out = out.when(attempted, F.concat(F.lit("Failed ("), F.coalesce(reason, F.lit("error")), F.lit(")")))
    elif ok is not None:
        out = out.when(~col_of(ok), F.lit("Failed"))
    return out.otherwise(F.lit("Pending"))


__all__ = [
    "law_filename", "fallback_key", "doc_language", "parse_filename", "fill_defaults",
    "null_sentinels", "derive_status", "nz",
]
