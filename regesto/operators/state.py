"""Resume state in constant space per key: bitmaps of done numbers and mergeable distinct sketches.

A year's done numbers are bitmaps of 32,768 numbers each (4 KB), not one row per key: batches merge
by OR, and what is left to do is found by a bit test behind a join with a few rows per year.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.operators.cutoffs import with_stop

#: Numbers in one bitmap: what ``bitmap_bucket_number`` and ``bitmap_bit_position`` go by.
PER_BITMAP = 32_768


def done_bitmaps(done: DataFrame, year: str = "y", number: str = "n") -> DataFrame:
    """(year, part, bits): the done numbers of each year, partial bitmaps in every task."""
    n = F.col(number).cast("long")
    return done.filter(n.isNotNull()).groupBy(F.col(year).alias("year"), F.bitmap_bucket_number(n).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")
    )


def merge_bitmaps(*batches: DataFrame) -> DataFrame:
    """One bitmap per (year, part) over all batches; a batch that is merged twice changes nothing."""
    every = reduce(DataFrame.unionByName, batches)
    return every.groupBy("year", "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_is_set(bits: Column, position: Column) -> Column:
    """Whether bit ``position`` (from 0) of a bitmap is set; a NULL bitmap has none."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte.cast("long"), (position % 8).cast("int")) == 1, F.lit(False))


def todo_by_bit(keys: DataFrame, bitmaps: DataFrame, year: str = "y", number: str = "n") -> DataFrame:
    """JON-1 over bitmaps: the keys whose number is not done, with the rows of an anti join.

    A year is joined by many tasks, whatever its share of the keys."""
    n = F.col(number).cast("long")
    named = keys.withColumn("__key", F.struct(F.col(year).cast("long").alias("y"), F.bitmap_bucket_number(n).alias("p")))
    parts = bitmaps.select(F.struct(F.col("year").cast("long").alias("y"), F.col("part").alias("p")).alias("__key"), F.col("bits").alias("__bits"))
    joined = with_stop(named, parts, "__key", [number], "__bits")
    return joined.filter(n.isNull() | ~bit_is_set(F.col("__bits"), F.bitmap_bit_position(n))).drop("__key", "__bits")


def done_counts(bitmaps: DataFrame) -> DataFrame:
    """(year, n): done numbers per year, from the bitmaps alone."""
    return bitmaps.groupBy("year").agg(F.sum(F.bitmap_count("bits")).alias("n"))


# ------------------------------------------------------------------ distinct sketches

#: 2^LG_K registers per sketch; the relative standard error is about 1.04 / sqrt(2^LG_K).
LG_K = 14


def distinct_sketches(df: DataFrame, by, value: str) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of the distinct values of each group."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, LG_K).alias("sketch"))


def merge_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """The sketches of runs, years or sources put together by the keys that are left."""
    keys = [by] if isinstance(by, str) else list(by)
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_estimates(sketches: DataFrame, out: str = "n") -> DataFrame:
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")
