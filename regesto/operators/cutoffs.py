"""Cut-off rules and positions.

The reference stops loops early (k misses in a row, k empty pages, a page with
nothing new, a page seen twice).  Over captured data these become set rules:

* ``cut_after_misses``, ``cut_after_empty_pages``, ``cut_when_no_news``,
  ``drop_revisits``, ``resolve_attempts``, ``latest_file`` use only joins, grouped
  aggregates (partial aggregation, no per-group sort) and a distributed sort, and
  join one row per group by ``with_stop``, so a group holding a third of all rows
  is never handled by one task;
* ``number_rows(partition=...)`` uses a window per partition: for bounded groups
  only, such as the documents of one law;
* ``number_rows`` without a partition is a distributed row number (sorted,
  checkpointed, per-partition offsets), never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


SPREAD = 32


def with_stop(df: DataFrame, stops: DataFrame, group: str, by, name: str) -> DataFrame:
    """Left join of the big side with a table of one row per group.

    The small rows are copied ``SPREAD`` times and the big side is dealt by a hash of ``by`` as
    well, so a group with a third of all rows is joined by that many tasks."""
    parts = [F.lit(x) for x in range(SPREAD)]
    copies = stops.select(F.col(group).alias("__group"), name, F.explode(F.array(*parts)).alias("__copy"))
    dealt = df.withColumn("__own", F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int"))
    on = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__own") == F.col("__copy"))
    return dealt.join(copies, on, "left").drop("__group", "__copy", "__own")


def cut_after_misses(df: DataFrame, group: str = "y", n: str = "n", hit: str = "found", k: int = 10) -> DataFrame:
    """WIN-1: per group, in number order, keep keys up to and including the k-th consecutive miss.

    ``n`` are the probed numbers 1, 2, 3 ... of the key grid.  A miss at ``n`` ends a run of k
    misses iff n >= k and no hit lies in [n-k+1, n]: each hit covers the k numbers starting at
    itself (an explode of k rows per hit), uncovered misses are candidates, the cut is their
    minimum per group.
    """
    hits = df.filter(_c(hit)).select(group, n)
    covered = hits.select(group, F.explode(F.sequence(F.col(n), F.col(n) + (k - 1))).alias(n))
    # merge: the size that Spark sees is that of the hits, before they are copied k times
    candidates = df.filter(~_c(hit) & (F.col(n) >= k)).select(group, n).join(covered.hint("merge"), [group, n], "left_anti")
    cut = candidates.groupBy(group).agg(F.min(n).alias("__cut"))
    return (
        with_stop(df, cut, group, [n], "__cut")
        .filter(F.col("__cut").isNull() | (F.col(n) <= F.col("__cut")))
        .drop("__cut")
    )


def cut_after_empty_pages(df: DataFrame, source: str = "source", page: str = "page", n_links: str = "n_links",
                          failed: str = "failed", k: int = 3) -> DataFrame:
    """WIN-2: stop the listing at the k-th empty page in a row; a failed page neither counts nor
    resets the run.  Keeps the pages up to the stopping page (inclusive)."""
    ok = df.filter(~F.coalesce(_c(failed), F.lit(False))).select(source, page, F.coalesce(_c(n_links), F.lit(0)).alias("__n"))
    # positions in (source, page) order, consecutive within a source, from a distributed sort
    ranked = number_rows(ok, [source, page], out="__i")
    start = ranked.groupBy(source).agg(F.min("__i").alias("__s"))
    ranked = with_stop(ranked, start, source, ["__i"], "__s")
    # as in WIN-1: a full page covers the k positions from its own on
    covered = ranked.filter(F.col("__n") > 0).select(source, F.explode(F.sequence(F.col("__i"), F.col("__i") + (k - 1))).alias("__i"))
    empty = ranked.filter((F.col("__n") <= 0) & (F.col("__i") - F.col("__s") + 1 >= k))
    stop = empty.join(covered, [source, "__i"], "left_anti").groupBy(source).agg(F.min(page).alias("__stop"))
    return (
        with_stop(df, stop, source, [page], "__stop")
        .filter(F.col("__stop").isNull() | (F.col(page) <= F.col("__stop")))
        .drop("__stop")
    )


def news_per_page(links: DataFrame, source: str = "source", page: str = "page", url: str = "url",
                  pages: DataFrame | None = None) -> DataFrame:
    """(source, page, found, new): links found on a page and links not met on an earlier page."""
    first = links.groupBy(source, url).agg(F.min(page).alias("__first"))
    new = first.groupBy(source, F.col("__first").alias(page)).agg(F.count(F.lit(1)).alias("new"))
    found = links.groupBy(source, page).agg(F.count(F.lit(1)).alias("found"))
    if pages is not None:  # fetched pages, empty ones included
        found = pages.select(source, page).distinct().join(found, [source, page], "left")
    return (
        found.join(new, [source, page], "left")
        .select(source, page, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("new", F.lit(0)).alias("new"))
    )


def cut_when_no_news(links: DataFrame, source: str = "source", page: str = "page", url: str = "url",
                     skip_first: bool = False, pages: DataFrame | None = None) -> DataFrame:
    """WIN-3: stop at the first page that adds no unseen link (also an empty page);
    ``skip_first`` leaves the first page out of the rule.  Keeps the links of earlier pages."""
    per_page = news_per_page(links, source, page, url, pages)
    stopping = per_page.filter(F.col("new") == 0)
    if skip_first:
        first_page = per_page.groupBy(source).agg(F.min(page).alias("__p0"))
        stopping = stopping.join(first_page, [source]).filter(F.col(page) > F.col("__p0")).drop("__p0")
    stop = stopping.groupBy(source).agg(F.min(page).alias("__stop"))
    return (
        with_stop(links, stop, source, [page, url], "__stop")
        .filter(F.col("__stop").isNull() | (F.col(page) < F.col("__stop")))
        .drop("__stop")
    )


def cut_after_last_page(df: DataFrame, pages: DataFrame, source: str = "source", page: str = "page", has_next: str = "has_next") -> DataFrame:
    """Numbered pager: the listing ends with the first page (of ``pages``) that offers no later one.
    Keeps the rows of ``df`` up to that page (inclusive)."""
    stop = pages.filter(~F.coalesce(_c(has_next), F.lit(False))).groupBy(source).agg(F.min(page).alias("__stop"))
    by = [c for c in df.columns if c != source][:4]
    return with_stop(df, stop, source, by, "__stop").filter(F.col("__stop").isNull() | (F.col(page) <= F.col("__stop"))).drop("__stop")


def drop_revisits(df: DataFrame, group: str = "year", seq: str = "seq", url: str = "url") -> DataFrame:
    """WIN-4: stop at the first page (in ``seq`` order) whose URL was visited before in the group."""
    first = df.groupBy(group, url).agg(F.min(seq).alias("__first"))
    revisit = (
        df.select(group, url, seq).join(first, [group, url])
        .filter(F.col(seq) > F.col("__first"))
        .groupBy(group).agg(F.min(seq).alias("__stop"))
    )
    return (
        with_stop(df, revisit, group, [seq, url], "__stop")
        .filter(F.col("__stop").isNull() | (F.col(seq) < F.col("__stop")))
        .drop("__stop")
    )


def latest_file(inventory: DataFrame, path: str = "path", mtime: str = "mtime", group=None,
                ignore=(".crdownload", ".tmp")) -> DataFrame:
    """WIN-5: newest file by mtime (ties: greatest path), ignoring partial downloads."""
    inv = inventory
    for suffix in ignore:
        inv = inv.filter(~F.lower(F.col(path)).endswith(suffix))
    keys = [] if group is None else ([group] if isinstance(group, str) else list(group))
    best = F.max(F.struct(F.col(mtime).alias("m"), F.col(path).alias("p"))).alias("__b")
    out = inv.groupBy(*keys).agg(best)
    return out.select(*keys, F.col("__b.p").alias(path), F.col("__b.m").alias(mtime))


def resolve_attempts(log: DataFrame, key="k", attempt: str = "attempt", status: str = "status", max_tries: int = 3,
                     final=("Downloaded", "Skipped")) -> DataFrame:
    """WIN-6: outcome per key within ``max_tries``: the first final status (success or terminal
    skip), else the last failure.  Columns: key, attempt, status, tries."""
    keys = [key] if isinstance(key, str) else list(key)
    tries = log.filter(F.col(attempt) <= max_tries)
    st = F.struct(F.col(attempt).alias("a"), F.col(status).alias("s"))
    agg = tries.groupBy(*keys).agg(
        F.min(F.when(F.col(status).isin(list(final)), st)).alias("__first_final"),
        F.max(st).alias("__last"),
    )
    out = F.coalesce(F.col("__first_final"), F.col("__last"))
    return agg.select(
        *keys,
        out["a"].cast("int").alias(attempt),
        out["s"].alias(status),
        out["a"].cast("int").alias("tries"),
    )


def number_rows(df: DataFrame, order, partition=None, out: str = "pos") -> DataFrame:
    """WIN-7: 1-based position.  Per partition: a window (bounded groups, e.g. one listing page).
    Global: sort, checkpoint (stable partitions), count per partition, add offsets."""
    ords = [_c(o) for o in ([order] if isinstance(order, (str, Column)) else order)]
    if partition is not None:
        parts = [partition] if isinstance(partition, str) else list(partition)
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*parts).orderBy(*ords)).cast("int"))
    from regesto.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    sorted_df = df.orderBy(*ords).checkpoint()
    # the checkpointed partitions are in order already: the id counts a partition's rows as they lie
    numbered = sorted_df.withColumn("__id", F.monotonically_increasing_id())
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition: bounded by the partition count, never by the data
    counts = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__part",
        (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    )
    return (
        numbered.join(F.broadcast(offsets), part == F.col("__part"))
        .withColumn(out, (F.coalesce(F.col("__off"), F.lit(0)) + local + 1).cast("long"))
        .drop("__part", "__id", "__off")
    )


def top_n_per_group(df: DataFrame, group, order, n: int, out: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  ``row_number() <= n`` is planned with a WindowGroupLimit that
    keeps at most n rows per group in every task *before* the shuffle, so hot groups stay cheap."""
    parts = [group] if isinstance(group, str) else list(group)
    ords = [_c(o) for o in ([order] if isinstance(order, (str, Column)) else order)]
    rn = F.row_number().over(Window.partitionBy(*parts).orderBy(*ords))
    res = df.withColumn("__rn", rn).filter(F.col("__rn") <= n)
    return res.withColumnRenamed("__rn", out) if out else res.drop("__rn")


def page_limit(df: DataFrame, page: str, n: int, per=None, order=None, first_page: int = 1) -> DataFrame:
    """LIM-1: at most ``n`` listing pages (page numbers from ``first_page``), or the first n per group."""
    if per is None:
        return df.filter(F.col(page) < first_page + n)
    return top_n_per_group(df, per, order or page, n)
