"""Keep-first / keep-last and set operators.

"First occurrence" is an aggregate, not a window: ``min`` over a struct led by
the ordering columns picks the first row per key with partial (map-side)
aggregation, so a key holding a third of all rows is pre-reduced in every task
before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_cols(order) -> list[Column]:
    out = []
    for o in ([order] if isinstance(order, (str, Column)) else order):
        out.append(F.col(o) if isinstance(o, str) else o)
    return out


def keep_extreme(df: DataFrame, key, order, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``.  Ties in ``order`` resolve by the
    remaining columns, so the result never depends on input order."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ords = _order_cols(order)
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(ords)], *[F.col(c) for c in rest])
    agg = F.max(packed) if last else F.min(packed)
    return df.groupBy(*keys).agg(agg.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def distinct_ordered(df: DataFrame, key, order) -> DataFrame:
    """SET-1: keep the first occurrence of each key (position order)."""
    return keep_extreme(df, key, order)


def distinct_any(df: DataFrame) -> DataFrame:
    """SET-2: plain distinct."""
    return df.distinct()


def distinct_across(df: DataFrame, key: str = "url", year: str = "year", pos: str = "pos") -> DataFrame:
    """SET-3: a URL met under one year is not met again under a later one (years run newest first)."""
    return keep_extreme(df, key, [-F.col(year), F.col(pos)])


def dedupe_file(df: DataFrame, name: str = "filename", order="pos") -> DataFrame:
    """SET-4: one row per file name, the first wins."""
    return keep_extreme(df, name, order)


def union_indexes(*dfs: DataFrame) -> DataFrame:
    """SET-5: old + new, and all regions into one schema (missing columns become NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def new_files(before: DataFrame, after: DataFrame, key: str = "path") -> DataFrame:
    """SET-6: files present only in the later snapshot."""
    return after.join(before.select(key).distinct(), [key], "left_anti")


def last_writer_wins(df: DataFrame, key, order) -> DataFrame:
    """SET-7: a later record with the same name replaces the earlier one."""
    return keep_extreme(df, key, order, last=True)


def purge_repealed(index: DataFrame, repealed: DataFrame, key="source_url") -> DataFrame:
    """SET-8: remove laws found repealed since the last run."""
    keys = [key] if isinstance(key, str) else list(key)
    return index.join(repealed.select(*keys).distinct(), keys, "left_anti")
