"""Counts and picks.  Every report is a grouped aggregate with
partial aggregation; none collects rows of a group into one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def laws_per_year(df: DataFrame, year: str, y0: int, y1: int) -> DataFrame:
    """AGG-1: count per year over [y0, y1], zero for years with nothing (a year spine)."""
    spine = df.sparkSession.range(y0, y1 + 1).select(F.col("id").cast("int").alias(year))
    counts = df.groupBy(F.col(year).cast("int").alias(year)).agg(F.count(F.lit(1)).alias("n_laws"))
    return spine.join(counts, [year], "left").select(year, F.coalesce("n_laws", F.lit(0)).cast("long").alias("n_laws"))


def status_counts(df: DataFrame, status: str = "status", wide: dict[str, list[str]] | None = None) -> DataFrame:
    """AGG-2: totals per status (long form), or one row with a column per named bucket."""
    if wide is None:
        return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    return df.agg(*[F.count_if(F.col(status).isin(vals)).alias(name) for name, vals in wide.items()])


def completeness(df: DataFrame, number: str = "law_number", date: str = "law_date", by=None) -> DataFrame:
    """AGG-3: missing number, missing date, both present, total."""
    keys = [] if by is None else ([by] if isinstance(by, str) else list(by))
    return df.groupBy(*keys).agg(
        F.count_if(F.col(number).isNull()).alias("missing_number"),
        F.count_if(F.col(date).isNull()).alias("missing_date"),
        F.count_if(F.col(number).isNotNull() & F.col(date).isNotNull()).alias("complete"),
        F.count(F.lit(1)).alias("total"),
    )


def links_per_page(links: DataFrame, source: str = "source", page: str = "page", url: str = "url") -> DataFrame:
    """AGG-4: links found and new per page."""
    from regesto.operators.cutoffs import news_per_page

    return news_per_page(links, source, page, url)


def longest_text(df: DataFrame, group, text: str = "text", pos: str = "pos", floor: int | None = None) -> DataFrame:
    """AGG-5: the longest candidate per group, the earliest on ties; optional length floor."""
    keys = [group] if isinstance(group, str) else list(group)
    src = df if floor is None else df.filter(F.length(text) > floor)
    pick = F.max_by(F.col(text), F.struct(F.length(text), -F.col(pos)))
    return src.groupBy(*keys).agg(pick.alias(text))


def first_where(df: DataFrame, group, pred: Column, text: str = "text", pos: str = "pos") -> DataFrame:
    """AGG-6: the first candidate in position order meeting a predicate."""
    keys = [group] if isinstance(group, str) else list(group)
    return df.filter(pred).groupBy(*keys).agg(F.min_by(F.col(text), F.col(pos)).alias(text))


def distinct_years(df: DataFrame, year: str = "year") -> DataFrame:
    """AGG-7: distinct years seen, newest first."""
    return df.select(year).where(F.col(year).isNotNull()).distinct().orderBy(F.col(year).desc())
