"""Operators against brute force on small fixtures, and invariance under repartition."""

import random

from pyspark.sql import functions as F

from regesto.operators import cutoffs as C
from regesto.operators import dedupe as S
from regesto.operators import reports as R


def brute_misses(seq, k):
    """The reference loop in number order: stop at the k-th consecutive miss."""
    kept, run = [], 0
    for n, hit in seq:
        kept.append(n)
        run = 0 if hit else run + 1
        if run >= k:
            break
    return kept


def test_cut_after_misses_vs_loop(spark):
    rnd = random.Random(7)
    data = []
    for y in range(2000, 2006):
        p = rnd.choice([0.1, 0.4, 0.8])
        data += [(y, n, rnd.random() < p) for n in range(1, rnd.randint(5, 120))]
    df = spark.createDataFrame(data, "y int, n int, found boolean").repartition(5)
    got = {(r["y"], r["n"]) for r in C.cut_after_misses(df, "y", "n", "found", k=4).collect()}
    want = set()
    for y in range(2000, 2006):
        seq = sorted((n, f) for yy, n, f in data if yy == y)
        want |= {(y, n) for n in brute_misses(seq, 4)}
    assert got == want


def test_cut_after_empty_pages_vs_loop(spark):
    rnd = random.Random(3)
    data = [(s, p, rnd.choice([0, 0, 3]), rnd.random() < 0.2) for s in range(4) for p in range(1, 60)]
    df = spark.createDataFrame(data, "source int, page int, n_links int, failed boolean")
    got = {(r["source"], r["page"]) for r in C.cut_after_empty_pages(df, k=3).collect()}
    want = set()
    for s in range(4):
        run = 0
        for _, p, n, failed in sorted(x for x in data if x[0] == s):
            want.add((s, p))
            if failed:
                continue
            run = run + 1 if n == 0 else 0
            if run >= 3:
                break
    assert got == want


def test_no_news_and_revisits_vs_loop(spark):
    rnd = random.Random(5)
    links = [("s", p, f"u{rnd.randint(0, 40)}") for p in range(1, 30) for _ in range(5)]
    df = spark.createDataFrame(links, "source string, page int, url string")
    got = {r["page"] for r in C.cut_when_no_news(df, "source", "page", "url").collect()}
    seen, want = set(), set()
    for p in range(1, 30):
        urls = [u for _, pp, u in links if pp == p]
        new = [u for u in urls if u not in seen]
        seen |= set(urls)
        if not new:
            break
        want.add(p)
    assert got == want

    visits = [("y", i, f"p{rnd.randint(0, 15)}") for i in range(1, 40)]
    vdf = spark.createDataFrame(visits, "year string, seq int, url string")
    got = sorted(r["seq"] for r in C.drop_revisits(vdf).collect())
    seen, want = set(), []
    for _, i, u in visits:
        if u in seen:
            break
        seen.add(u)
        want.append(i)
    assert got == want


def test_resolve_attempts(spark):
    log = spark.createDataFrame(
        [("a", 1, "Failed"), ("a", 2, "Downloaded"), ("a", 3, "Failed"),
         ("b", 1, "Failed"), ("b", 2, "Failed"), ("b", 3, "Failed"), ("b", 4, "Downloaded"),
         ("c", 1, "Skipped")], "k string, attempt int, status string")
    got = {r["k"]: (r["attempt"], r["status"]) for r in C.resolve_attempts(log).collect()}
    assert got == {"a": (2, "Downloaded"), "b": (3, "Failed"), "c": (1, "Skipped")}


def test_number_rows_global_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    got = [(r["v"], r["pos"]) for r in C.number_rows(df, "v").orderBy("pos").collect()]
    assert [p for _, p in got] == list(range(1, 5001))
    assert [v for v, _ in got] == sorted(v for v, _ in got)


def test_keep_first_is_order_independent(spark):
    data = [(f"k{i % 13}", i, f"t{i}") for i in range(300)]
    a = spark.createDataFrame(data, "key string, pos int, t string")
    b = spark.createDataFrame(list(reversed(data)), "key string, pos int, t string").repartition(9)
    ra = sorted(map(tuple, S.distinct_ordered(a, "key", "pos").collect()))
    rb = sorted(map(tuple, S.distinct_ordered(b, "key", "pos").collect()))
    assert ra == rb and len(ra) == 13
    assert all(r[1] < 13 for r in ra)
    last = sorted(map(tuple, S.last_writer_wins(b, "key", "pos").collect()))
    assert all(r[1] >= 287 for r in last)


def test_hot_key_plan_has_partial_aggregate(spark):
    """First-occurrence and cut-offs are aggregates: a hot key is pre-reduced map-side."""
    df = spark.range(0, 10000).select(F.lit("hot").alias("key"), F.col("id").alias("pos"))
    plan = S.distinct_ordered(df, "key", "pos")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan or "Partial" in plan


def test_top_n_uses_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = C.top_n_per_group(df, "g", "v", 5)
    assert out.count() == 15
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_laws_per_year_spine(spark):
    df = spark.createDataFrame([(2001,), (2001,), (2003,)], "year int")
    got = {r["year"]: r["n_laws"] for r in R.laws_per_year(df, "year", 2000, 2004).collect()}
    assert got == {2000: 0, 2001: 2, 2002: 0, 2003: 1, 2004: 0}


def test_cut_after_misses_property(spark):
    """Random grids (hypothesis): the join/aggregate form equals the sequential loop, for any k."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.lists(st.booleans(), min_size=1, max_size=40), min_size=1, max_size=4), st.integers(1, 5))
    def check(years, k):
        data = [(y, n + 1, hit) for y, hits in enumerate(years) for n, hit in enumerate(hits)]
        df = spark.createDataFrame(data, "y int, n int, found boolean").repartition(3)
        got = {(r["y"], r["n"]) for r in C.cut_after_misses(df, "y", "n", "found", k=k).collect()}
        want = set()
        for y, hits in enumerate(years):
            want |= {(y, n) for n in brute_misses([(i + 1, h) for i, h in enumerate(hits)], k)}
        assert got == want

    check()


def test_a_hot_group_is_dealt_over_many_tasks(spark):
    """The cut-offs' last join spreads one group of all rows."""
    df = spark.range(0, 20000).select(F.lit(1).alias("y"), (F.col("id") + 1).alias("n"), (F.col("id") < 15000).alias("found"))
    stop = spark.createDataFrame([(1, 15010)], "y int, __cut long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = C.with_stop(df, stop, "y", ["n"], "__cut")
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 8000 and out.filter("__cut = 15010").count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert C.cut_after_misses(df, "y", "n", "found", 10).count() == 15010


def test_number_rows_has_one_shuffle(spark):
    plan = C.number_rows(spark.range(0, 100), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan  # the checkpointed rows are not sorted again


def test_the_key_grid_is_not_broadcast(spark):
    """A few years explode into all keys: sized by the years, the grid went through the driver."""
    from regesto.plans import regions as RG

    keys = spark.range(4000).select((F.col("id") % 4 + 2020).cast("int").alias("y"), (F.col("id") / 4).cast("int").alias("n"))
    headers = F.create_map(F.lit("Content-Disposition"), F.lit('attachment; filename="Legge 3 marzo 2021.pdf"'))
    caps = keys.select("y", (F.col("n") + 1).alias("n"), F.lit(200).alias("status"),
                       headers.alias("headers"), F.encode(F.lit("%PDF-1.4"), "UTF-8").alias("body"), F.lit("LEGGE REGIONALE\nUn titolo lungo della legge").alias("first_page_text"))
    out = RG.extract_calabria(caps)
    assert len(out.collect()) == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    joins = [line for line in final.splitlines() if "SortMergeJoin" in line]
    assert any("LeftAnti" in j for j in joins) and len(joins) >= 2, final
