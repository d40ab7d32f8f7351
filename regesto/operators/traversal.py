"""Walks over captured pages: which pages a listing loop would have opened, in which order.

The scripts follow a "next" link until there is none, until a page repeats or until a page cap.
Over captured pages each page has at most one next page, so a walk is a chain in a functional
graph.  ``walk`` finds all chains at once by pointer doubling: after step k every start knows its
first 2^k pages and every page its 2^k-th successor, so a cap of 100 takes seven joins, not a
hundred.  A start's pages are a group of at most ``cap`` rows; a page that many starts reach has
one row in the table of successors, and AQE splits the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions import html as H
from regesto.functions import urls as U
from regesto.session import ensure_checkpoint_dir

#: More pages than any listing has: the cap of a walk without one.
NO_CAP = 1 << 20


def page_anchors(pages: DataFrame, keep=("url",)) -> DataFrame:
    """(*keep, pos, to, text, cls): the anchors of each page with their absolute address."""
    found = H.extract_anchors(pages, keep=keep).filter(F.col("href").isNotNull())
    return found.select(*keep, "pos", U.url_join(F.col("url"), F.col("href")).alias("to"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("cls", F.lit("")).alias("cls"))


def next_pages(pages: DataFrame, anchors: DataFrame, is_next: Column) -> DataFrame:
    """(url, next) of every captured page: where its first anchor that ``is_next`` leads, or NULL."""
    first = anchors.filter(is_next).groupBy("url").agg(F.min(F.struct("pos", "to")).alias("a")).select("url", F.col("a.to").alias("next"))
    return pages.select("url").distinct().join(first, "url", "left")


def walk(starts: DataFrame, nexts: DataFrame, cap: int | None = None) -> DataFrame:
    """(source, page_no, url, stop): the pages that each start of ``starts`` (source, url) reaches
    along ``nexts`` (url, next), numbered from 1, each page once.

    ``stop`` stands at a source's last page: ``last`` (no next link), ``missing`` (the next page was
    not captured), ``cycle`` (the next page was visited before), or ``cap``.  A start that was not
    captured gives no rows; a page that is listed twice counts with its least next page.
    """
    ensure_checkpoint_dir(starts.sparkSession)
    cap = cap or NO_CAP
    once = nexts.groupBy("url").agg(F.min("next").alias("next"))
    captured = once.select(F.col("url").alias("next"), F.lit(True).alias("captured"))
    once = once.join(captured, "next", "left").checkpoint()
    jump = once.filter("captured").select("url", F.col("next").alias("to"))
    reach = starts.select("source", "url").distinct().join(once.select("url"), "url", "left_semi").select("source", "url", F.lit(1).alias("page_no")).checkpoint()
    span, size = 1, reach.count()
    while span < cap:
        later = reach.join(jump, "url").select("source", F.col("to").alias("url"), (F.col("page_no") + span).alias("page_no")).filter(F.col("page_no") <= cap)
        reach = reach.unionByName(later).groupBy("source", "url").agg(F.min("page_no").alias("page_no")).checkpoint()
        span, before, size = span * 2, size, reach.count()
        if size == before:
            break
        jump = jump.join(jump.select(F.col("url").alias("to"), F.col("to").alias("on")), "to").select("url", F.col("on").alias("to")).checkpoint()
    ends = reach.groupBy("source").agg(F.max("page_no").alias("page_no"))
    why = (
        F.when(F.col("next").isNull(), "last").when(F.col("captured").isNull(), "missing").when(F.col("page_no") == cap, "cap").otherwise("cycle")
    )
    ends = reach.join(ends, ["source", "page_no"]).join(once, "url").select("source", "page_no", why.alias("stop"))
    return reach.join(ends, ["source", "page_no"], "left").select("source", "page_no", "url", "stop")
