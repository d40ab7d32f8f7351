"""Orderings.  A total order is a range-partitioned sort in
Spark; use these only at the sink, where the order is the feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regesto.functions.dates import any_date
from regesto.functions.urls import year_num_from_url


def order_years(df: DataFrame, year: str = "year") -> DataFrame:
    """SRT-1: newest year first."""
    return df.orderBy(F.col(year).desc_nulls_last())


def order_year_number(df: DataFrame, url: str = "url", *ties: str) -> DataFrame:
    """SRT-2: (year, number) from ``lr<yyyy>-<n>`` ascending; URLs without them last."""
    return df.orderBy(*year_number_keys(url), *ties)


def order_by_date(df: DataFrame, date_text: str = "date_text", *ties: str) -> DataFrame:
    """SRT-3: by parsed date ascending, unparsable last."""
    return df.orderBy(*date_order_keys(date_text), *ties)


def date_order_keys(date_text: str = "date_text"):
    """Sort keys of SRT-3 (for ``number_rows`` or ``orderBy``)."""
    return [F.asc_nulls_last(any_date(F.col(date_text))), F.col(date_text)]


def year_number_keys(url: str = "url"):
    """Sort keys of SRT-2."""
    yn = year_num_from_url(url)
    return [yn["year"], yn["num"], F.col(url)]
