"""Checks for scans, sinks and the streaming form."""

from __future__ import annotations

from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import keys as K
from regesto.operators import joins as J
from regesto.operators import state as OS
from regesto.plans import regions as RG
from regesto.plans.q_regions import CALABRIA_ORACLE, ORACLE_SELECTS, calabria
from regesto.plans.q_scalars import LAW_HEADERS_ORACLE, law_index_from_headers
from regesto.plans.registry import query
from regesto.sources import readers as R
from regesto.sources import sinks as W
from regesto.sources.fixtures import table, view
from regesto.streaming import stateful as SF
from regesto.streaming import stream as ST


@query("src_read_pages", "SELECT page_id, url, cast(length(html) as int) AS n_chars FROM pages", ops="SRC-1")
def src_read_pages(spark, sf):
    p = R.read_pages(spark, f"{sf}/pages.parquet")
    return p.select("page_id", "url", F.length("html").alias("n_chars"))


@query("snk_index_roundtrip", f"SELECT * FROM ({LAW_HEADERS_ORACLE}) UNION ALL SELECT * FROM ({LAW_HEADERS_ORACLE})",
       views=["law_headers"], ops="SNK-1 SNK-3 SRC-3")
def snk_index_roundtrip(spark, sf):
    idx = law_index_from_headers(view(spark, sf, "law_headers"))
    path = ST.scratch_dir(spark, "index")
    W.write_index(idx, path)
    W.append_index(idx, path)
    back = R.read_index(spark, path, schema=idx.schema)
    return back.select(*idx.columns)


def _record_sql(region):
    """Every record of a region in its own shape, as one string of column=value."""
    present = {c for c, _ in RG.LAW_INDEX}
    cells = [f"'{disp}=' || {f'cast({canon} as varchar)' if canon in present else chr(39) * 2}" for disp, canon in RG.DISPLAY_COLUMNS[region].items()]
    source = CALABRIA_ORACLE if region == "calabria" else ORACLE_SELECTS[region]
    return f"SELECT '{region}' AS region, concat_ws(' | ', {', '.join(cells)}) AS record FROM ({source})"


@query("snk_conform", f"SELECT region, record, count(*) AS n FROM ({' UNION ALL '.join(map(_record_sql, RG.DISPLAY_COLUMNS))}) GROUP BY ALL",
       views=["law_headers", "calabria_captures"], ops="SNK-2 SNK-5")
def snk_conform(spark, sf):
    """All 18 shapes, whole records."""
    parts = []
    for region in RG.DISPLAY_COLUMNS:
        idx = calabria(spark, sf) if region == "calabria" else RG.EXTRACTORS[region](view(spark, sf, f"pages_{region}"))
        shaped = RG.conform(W.drop_internal(idx, ["not_a_column"]), region)
        record = F.concat_ws(" | ", *[F.concat(F.lit(f"{c}="), F.col(f"`{c}`")) for c in shaped.columns])
        parts.append(shaped.select(F.lit(region).alias("region"), record.alias("record")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("region", "record").agg(F.count(F.lit(1)).alias("n"))


@query("src_state_todo", "SELECT y, n FROM probe_grid WHERE NOT found AND y >= 1997", views=["probe_grid"],
       ops="SRC-4 SNK-6 JON-1")
def src_state_todo(spark, sf):
    g = view(spark, sf, "probe_grid").withColumn("key", F.concat_ws("_", "y", "n"))
    path = ST.scratch_dir(spark, "state")
    W.write_state(g.filter("found").select(F.col("key").alias("done_keys")), path, batch_id=0)
    W.write_state(g.filter(F.col("y") < 1997).select(F.col("y").alias("done_years")).distinct(), path, batch_id=1)
    state = R.read_state(spark, path, multiline=False)
    todo = J.todo(g.select("y", "n", "key"), state["done_keys"], on="key", done_years=state["done_years"], year="y")
    return todo.select("y", "n")


@query("src_bitmap_todo", """
SELECT g.y, g.n, c.done FROM probe_grid g JOIN (SELECT y, count(CASE WHEN found THEN 1 END) AS done FROM probe_grid GROUP BY y) c ON c.y = g.y
WHERE NOT g.found""", views=["probe_grid"], ops="JON-1")
def src_bitmap_todo(spark, sf):
    """The same rows as the anti join: three batches of bitmaps, one of them merged twice, then a bit test."""
    g = view(spark, sf, "probe_grid")
    batches = [OS.done_bitmaps(g.filter(F.col("found") & (F.col("n") % 3 == k))) for k in range(3)]
    path = ST.scratch_dir(spark, "bitmaps")
    OS.merge_bitmaps(*batches, batches[0]).write.parquet(path)
    bitmaps = spark.read.parquet(path)
    done = OS.done_counts(bitmaps).select(F.col("year").alias("y"), F.col("n").alias("done"))
    return OS.todo_by_bit(g.select("y", "n"), bitmaps).join(done, "y").select("y", "n", "done")


@query("agg_sketch_links", """
SELECT 'years' AS what, cast(count(DISTINCT d) as bigint) AS exact, true AS close, true AS same FROM law_headers
UNION ALL SELECT 'titles', count(DISTINCT concat(region, cast(no as varchar), cast(d as varchar))), true, true FROM law_headers""",
       views=["law_headers"], ops="AGG-7")
def agg_sketch_links(spark, sf):
    """Sketches per (region, year) that union over runs: the union estimates what a sketch of all rows
    does, within five standard errors of the exact count."""
    lh = view(spark, sf, "law_headers").select("region", F.year("d").alias("year"), F.col("d").cast("string").alias("years"),
                                               F.concat("region", F.col("no").cast("string"), F.col("d").cast("string")).alias("titles"), (F.col("law_id") % 4).alias("run"))
    out = None
    for what in ("years", "titles"):
        runs = OS.distinct_sketches(lh, ["run", "region", "year"], what)
        merged = OS.sketch_estimates(OS.merge_sketches(OS.merge_sketches(runs, ["region", "year"])))
        whole = OS.sketch_estimates(OS.merge_sketches(OS.distinct_sketches(lh, [], what))).select(F.col("n").alias("whole"))
        exact = lh.groupBy(F.lit(what).alias("what")).agg(F.count_distinct(what).alias("exact"))
        merged, whole = merged.withColumn("what", F.lit(what)), whole.withColumn("what", F.lit(what))
        error = 5 * 1.04 / 2 ** (OS.LG_K / 2)
        row = exact.join(merged, "what").join(whole, "what").select(
            "what", "exact", (F.abs(F.col("n") - F.col("exact")) <= F.col("exact") * error + 1).alias("close"),
            (F.abs(F.col("n") - F.col("whole")) <= F.col("whole") * error + 1).alias("same"))
        out = row if out is None else out.unionByName(row)
    return out


@query("src_read_archive", """
SELECT url, cast(200 + page_id % 3 * 102 as int) AS status, 'text/html; charset=utf-8' AS kind, md5(html) AS html_md5, true AS complete
FROM pages WHERE page_id % 2 = 0 OR regexp_matches(url, 'e')""", ops="SRC-1 SRC-2")
def src_read_archive(spark, sf):
    """Archives of many records, read by byte ranges; an address filter at the scan."""
    pages = table(spark, sf, "pages").withColumn("status", (200 + F.col("page_id") % 3 * 102).cast("int"))
    path = ST.scratch_dir(spark, "archive")
    R.write_archive(pages.withColumn("url", F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("#even"))).otherwise(F.col("url"))), path)
    found = R.read_archive(spark, path, "#even$|e")
    return found.select(F.regexp_replace("url", "#even$", "").alias("url"), "status", F.col("headers")["content-type"].alias("kind"), F.md5("html").alias("html_md5"), "complete")


@query("snk_bucketed_index", """
SELECT law_id, concat('https://leggi.example/', cast(law_id as string)) AS source_url, law_id % 3 <> 0 AS known FROM law_headers
WHERE law_id % 3 = 0 OR law_id % 5 <> 0""", views=["law_headers"], ops="SNK-1 JON-1 JON-2")
def snk_bucketed_index(spark, sf):
    """The daily join against a bucketed index: what is new, and what is known but due again."""
    laws = view(spark, sf, "law_headers").select("law_id", F.concat(F.lit("https://leggi.example/"), F.col("law_id").cast("string")).alias("source_url"))
    path = ST.scratch_dir(spark, "bucketed")
    name = "law_index_" + path.rsplit("-", 1)[1]
    index = W.write_bucketed_index(laws.filter("law_id % 3 <> 0"), path, name, buckets=8)
    todo = J.todo(laws, index.filter("law_id % 5 = 0"), on="source_url")
    return J.mark_existing(todo, index, "source_url", "source_url", flag="known")


@query("src_page_grid", """
SELECT y.year, cast(p.range AS int) AS page,
       concat('https://aosta.example/ricerca?anno=', cast(y.year as string), '&page=', cast(p.range as string)) AS url
FROM (SELECT DISTINCT cast(year(d) as int) AS year FROM law_headers) y, range(1, 6) p""", views=["law_headers"], ops="SRC-6")
def src_page_grid(spark, sf):
    years = view(spark, sf, "law_headers").select(F.year("d").alias("year"))
    return R.page_grid(spark, "https://aosta.example/ricerca?anno={year}&page={page}", 1, 5, years=years)


@query("src_file_inventory", "SELECT region, true AS non_empty FROM law_headers GROUP BY region", views=["law_headers"], ops="SRC-7 SNK-1")
def src_file_inventory(spark, sf):
    idx = law_index_from_headers(view(spark, sf, "law_headers"))
    path = ST.scratch_dir(spark, "files")
    W.write_index(idx, path)
    inv = R.file_inventory(spark, path, glob="*.parquet")
    region = F.regexp_extract("path", r"region=([^/]+)", 1).alias("region")
    return inv.groupBy(region).agg(F.bool_and(F.col("length") > 0).alias("non_empty"))


@query("snk_payload", """
SELECT law_id, CASE WHEN law_id % 3 = 0 THEN 'pdf' ELSE 'html' END AS payload_kind,
       concat('Legge_', cast(law_id as string), CASE WHEN law_id % 3 = 0 THEN '.pdf' ELSE '.html' END) AS payload_name,
       md5(CASE WHEN law_id % 3 = 0 THEN concat('%PDF-1.4 ', url) ELSE html END) AS payload_md5
FROM (SELECT page_id AS law_id, url, html FROM law_pages)""", views=["law_pages"], ops="SNK-7")
def snk_payload(spark, sf):
    lh = view(spark, sf, "law_pages")
    df = lh.select(
        F.col("page_id").alias("law_id"), "html",
        F.when(F.col("page_id") % 3 == 0, F.encode(F.concat(F.lit("%PDF-1.4 "), F.col("url")), "UTF-8")).alias("pdf"),
        F.concat(F.lit("Legge_"), F.col("page_id").cast("string")).alias("filename_stem"),
    )
    return W.payload_table(df).select("law_id", "payload_kind", "payload_name", F.md5("payload").alias("payload_md5"))


def _stage_files(df, spark, name, parts=8):
    path = ST.scratch_dir(spark, name)
    df.repartition(parts).write.parquet(path)
    return path


@query("str_dedupe", "SELECT DISTINCT url FROM listing", views=["listing"], ops="STR-1 STR-2")
def str_dedupe(spark, sf):
    li = view(spark, sf, "listing")
    src = _stage_files(li, spark, "stream-in")
    out = ST.scratch_dir(spark, "seen")
    s = ST.stream_dedupe(ST.stream_pages(spark, src, li.schema, max_files=3), "url")
    ST.run_to_parquet(s.select("url"), out, ST.scratch_dir(spark, "ckpt"))  # which copy stays is up to arrival
    return spark.read.schema("url string").parquet(out)


_VERSIONS = 4


@query("str_upsert", f"""
SELECT url, page_no, pos, version, title FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY version DESC, page_no, pos) AS r FROM (
    SELECT url, page_no, pos, cast(page_no % {_VERSIONS} as int) AS version,
           concat('Versione ', cast(page_no % {_VERSIONS} as string), ' da ', cast(page_no as string)) AS title FROM listing))
WHERE r = 1""", views=["listing"], ops="STR-1 STR-3 SNK-4 SET-7")
def str_upsert(spark, sf):
    """Each batch brings other records for URLs met before: the last batch's first record stays."""
    version = (F.col("page_no") % _VERSIONS).cast("int")
    title = F.concat(F.lit("Versione "), version.cast("string"), F.lit(" da "), F.col("page_no").cast("string"))
    li = view(spark, sf, "listing").select("url", "page_no", "pos", version.alias("version"), title.alias("title"))
    src, log, ckpt = (ST.scratch_dir(spark, n) for n in ("versions", "index-log", "ckpt"))
    for v in range(_VERSIONS):  # a folder that gains files between runs of the stream
        li.filter(F.col("version") == v).write.mode("append").parquet(src)
        s = ST.stream_pages(spark, src, li.schema)
        ST.stream_upsert_index(s, log, ckpt, key="url", order=["page_no", "pos"]).awaitTermination()
        if v == 1:
            ST.compact_index(spark, log, "url")
    return ST.read_upserted_index(spark, log, key="url").select("url", "page_no", "pos", "version", "title")


@query("str_merge", f"""
SELECT url, page_no, pos, version, title FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY version DESC, page_no, pos) AS r FROM (
    SELECT url, page_no, pos, cast(page_no % {_VERSIONS} as int) AS version,
           concat('Versione ', cast(page_no % {_VERSIONS} as string), ' da ', cast(page_no as string)) AS title FROM listing))
WHERE r = 1""", views=["listing"], ops="STR-1 STR-3 SNK-4")
def str_merge(spark, sf):
    """As ``str_upsert``, but a batch rewrites only the buckets that it touches and leaves no log."""
    version = (F.col("page_no") % _VERSIONS).cast("int")
    title = F.concat(F.lit("Versione "), version.cast("string"), F.lit(" da "), F.col("page_no").cast("string"))
    li = view(spark, sf, "listing").select("url", "page_no", "pos", version.alias("version"), title.alias("title"))
    src, path, ckpt = (ST.scratch_dir(spark, n) for n in ("versions", "merged-index", "ckpt"))
    for v in range(_VERSIONS):
        li.filter(F.col("version") == v).write.mode("append").parquet(src)
        ST.stream_merge_index(ST.stream_pages(spark, src, li.schema), path, ckpt, key="url", order=["page_no", "pos"], buckets=16).awaitTermination()
    return ST.read_merged_index(spark, path).select("url", "page_no", "pos", "version", "title")


@query("str_status_counts", "SELECT status, count(*) AS n FROM fetch_log GROUP BY status", views=["fetch_log"], ops="STR-4")
def str_status_counts(spark, sf):
    fl = view(spark, sf, "fetch_log")
    src = _stage_files(fl, spark, "status-in")
    s = ST.stream_pages(spark, src, fl.schema, max_files=3)
    out = ST.scratch_dir(spark, "status-out")
    ST.run_counts(ST.stream_status_counts(s, "status"), out, ST.scratch_dir(spark, "ckpt"))
    res = spark.read.parquet(out)
    last = res.agg(F.max("batch_id").alias("b"))
    return res.join(last, res.batch_id == last.b).select("status", "n")


# ---------------------------------------------------------------- keyed state with timers
WAIT = "12 hours"  # longer than a key's attempts take, shorter than the log


def _in_slices(spark, log, start, out_schema: str):
    """The log arrives in three slices of time, the stream starts anew for each; a last row far ahead
    moves the watermark past every timer."""
    SF.use_rocksdb(spark)
    src, out, ckpt = (ST.scratch_dir(spark, n) for n in ("attempts", "outcomes", "ckpt"))
    sliced = log.withColumn("slice", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)))  # the log is of one month
    end = log.limit(0).select(*log.columns).unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("k"), *[
        (F.lit("2100-01-01").cast("timestamp") if c == "ts" else F.lit("Failed") if c == "status" else F.lit(1)).cast(t).alias(c) for c, t in log.dtypes if c != "k"]))
    for k in range(4):
        (sliced.filter(F.col("slice") == k).drop("slice") if k < 3 else end).write.mode("append").parquet(src)
        ST.run_to_parquet(start(ST.stream_pages(spark, src, log.schema)), out, ckpt)
    return spark.read.schema(out_schema).parquet(out)


@query("str_outcomes", """
SELECT k, cast(coalesce(min(CASE WHEN status <> 'Failed' THEN attempt END), max(attempt)) as int) AS attempt,
  arg_min(status, CASE WHEN status <> 'Failed' THEN attempt ELSE 100 - attempt END) AS status,
  CASE WHEN count(CASE WHEN status <> 'Failed' THEN 1 END) > 0 THEN 'final' WHEN max(attempt) = 3 THEN 'tries' ELSE 'timeout' END AS why
FROM attempt_log WHERE attempt <= 3 GROUP BY k""", views=["attempt_log"], ops="STR-1 WIN-6")
def str_outcomes(spark, sf):
    """Outcome per key by state and timers, over three restarts."""
    log = view(spark, sf, "attempt_log")
    return _in_slices(spark, log, lambda s: SF.stream_outcomes(s, wait=WAIT), "k long, attempt int, status string, why string")


@query("str_first_record", """
SELECT k, page_no, event_id, status FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY page_no, event_id) AS r FROM attempt_log) WHERE r = 1""", views=["attempt_log"], ops="STR-1 STR-2")
def str_first_record(spark, sf):
    """The first record of each key by (page, position), whatever the order of arrival."""
    log = view(spark, sf, "attempt_log").drop("attempt")
    found = _in_slices(spark, log, lambda s: SF.first_records(s, "k", ["page_no", "event_id"], wait=WAIT), "k long, page_no int, event_id long, status string, ts timestamp")
    return found.drop("ts")
