"""Joins: equi-inner, left, semi and anti only.

No explicit broadcast hints: state, inventories and category lists are side
tables whose size is only known at run time, so the choice is left to AQE
(``spark.sql.adaptive.autoBroadcastJoinThreshold`` measures the built side after
its stage ran; above it the join stays a shuffled join).  Duplicate keys on the
side table are removed first so a join never multiplies law rows by accident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regesto.functions.dates import month_number


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def todo(keys: DataFrame, done: DataFrame | None = None, on="key", done_years: DataFrame | None = None,
         year: str = "year") -> DataFrame:
    """JON-1: drop keys already done and keys of whole years already done (anti joins, before any parsing)."""
    out = keys
    if done is not None:
        out = out.join(done.select(*_keys(on)).distinct(), _keys(on), "left_anti")
    if done_years is not None:
        out = out.join(done_years.select(F.col(done_years.columns[0]).alias(year)).distinct(), [year], "left_anti")
    return out


def mark_existing(laws: DataFrame, inventory: DataFrame, left: str = "filename", right: str = "name",
                  keep_row: bool = True, flag: str = "exists") -> DataFrame:
    """JON-2: flag laws whose file is already stored (``keep_row``) or leave them out."""
    inv = inventory.select(F.col(right).alias("__name")).distinct()
    if not keep_row:
        return laws.join(inv, F.col(left) == F.col("__name"), "left_anti")
    return (
        laws.join(inv.withColumn("__hit", F.lit(True)), F.col(left) == F.col("__name"), "left")
        .withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
        .drop("__name", "__hit")
    )


def listing_with_detail(listing: DataFrame, detail: DataFrame, on="url", fields=("title",),
                        listing_prefix: str = "list_") -> DataFrame:
    """JON-3: left join listing -> detail; for each field the detail value wins, the listing's
    ``<listing_prefix><field>`` is the fallback.  ``detail`` must hold one row per key."""
    keys = _keys(on)
    d = detail.select(*keys, *[F.col(f).alias(f"__d_{f}") for f in fields])
    out = listing.join(d, keys, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(F.col(f"__d_{f}"), F.col(f"{listing_prefix}{f}"))).drop(f"__d_{f}")
    return out


def law_with_category(laws: DataFrame, cats: DataFrame, on="key") -> DataFrame:
    """JON-4: label each law with its categories (a law in several categories gives several rows)."""
    return laws.join(cats.dropDuplicates(_keys(on) + [c for c in cats.columns if c not in _keys(on)]), _keys(on), "inner")


def month_lookup(df: DataFrame, name: str, out: str = "month") -> DataFrame:
    """JON-5: month name -> number through a folded literal map (no join needed)."""
    return df.withColumn(out, month_number(F.col(name)))


def law_documents(laws: DataFrame, docs: DataFrame, on="law_id") -> DataFrame:
    """JON-6: law x its documents (1:N), law fields repeated on each document row."""
    return laws.join(docs, _keys(on), "inner")
