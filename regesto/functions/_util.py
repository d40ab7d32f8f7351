"""Small shared helpers for Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn``.

    Spark rewrites ``nullif``/``when``/``coalesce`` by repeating their input, so nested
    extractions (a regex over the result of a regex) grow the expression tree and evaluate the
    same regex many times.  A one-element ``transform`` binds the value to a lambda variable
    instead, which keeps every regex evaluated once per row."""
    return F.element_at(F.transform(F.array(col_of(value)), fn), 1)


def nz(c: Column) -> Column:
    """'' -> NULL (``regexp_extract`` returns '' on no match and for an unmatched group)."""
    return let(c, lambda v: F.when(v != F.lit(""), v))


def rx(c, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (group ``group``), NULL when absent."""
    return nz(F.regexp_extract(col_of(c), pattern, group))
