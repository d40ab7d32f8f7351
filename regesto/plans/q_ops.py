"""Checks for filters, joins, reports, cut-offs, orderings and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import keys as K
from regesto.functions import text as T
from regesto.operators import cutoffs as C
from regesto.operators import dedupe as S
from regesto.operators import filters as P
from regesto.operators import joins as J
from regesto.operators import reports as R
from regesto.operators import sorting as O
from regesto.plans.q_scalars import law_index_from_headers
from regesto.plans.registry import query
from regesto.sources.fixtures import many, table, view

ISO = "strftime(d, '%Y-%m-%d')"
FILENAME_SQL = f"concat(region, '_', cast(no as string), '_', {ISO}, '.pdf')"


def _filenames(spark, sf):
    lh = view(spark, sf, "law_headers")
    return lh.withColumn("filename", K.law_filename(F.col("region"), "no", D.date_display("d", "iso")))


# ------------------------------------------------------------------ filters

@query("prd_repeal_strict", r"""
SELECT doc_id FROM repeal_text WHERE NOT coalesce(regexp_matches(body, '(?i)\(\s*Abrogata\s*\)'), false)""",
       views=["repeal_text"], ops="PRD-1")
def prd_repeal_strict(spark, sf):
    return P.drop_repealed_strict(view(spark, sf, "repeal_text"), "body").select("doc_id")


_PHRASES_SQL = " OR ".join(f"contains(t, '{p.lower().replace(chr(39), chr(39) * 2)}')" for p in P.REPEAL_PHRASES)


@query("prd_repeal_phrases", f"""
SELECT doc_id FROM (SELECT doc_id, translate(lower(body), '’`‘', '''''''') AS t FROM repeal_text)
WHERE NOT coalesce({_PHRASES_SQL}, false)""", views=["repeal_text"], ops="PRD-2 TXT-6")
def prd_repeal_phrases(spark, sf):
    return P.drop_repealed_phrases(view(spark, sf, "repeal_text"), "body").select("doc_id")


@query("prd_captures", """
SELECT doc_id, cast(strlen(s) as int) AS n_bytes FROM (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 404 ELSE 200 END AS status,
         concat(CASE WHEN doc_id % 3 = 0 THEN '%PDF-1.4 ' ELSE '<html>' END, text) AS s FROM documents)
WHERE status = 200 AND left(s, 4) = '%PDF' AND strlen(s) > 2000""", ops="PRD-3 PRD-4")
def prd_captures(spark, sf):
    d = table(spark, sf, "documents")
    caps = d.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.encode(F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit("%PDF-1.4 ")).otherwise(F.lit("<html>")), "text"), "UTF-8").alias("body"),
    )
    good = P.min_size(P.valid_capture(caps), "body", 2000)
    return good.select("doc_id", F.octet_length("body").cast("int").alias("n_bytes"))


@query("prd_text_filters", r"""
SELECT doc_id FROM documents
WHERE length(text) > 40 AND NOT regexp_matches(text, '^\d') AND NOT starts_with(lower(text), 'the')
  AND contains(lower(text), 'e') AND text IS NOT NULL AND trim(text) <> '' AND lang IS NOT NULL AND trim(lang) <> ''
  AND source IS NOT NULL AND trim(source) <> ''""", ops="PRD-7 PRD-8")
def prd_text_filters(spark, sf):
    d = table(spark, sf, "documents")
    d = P.text_filter(d, "text", contains="e", not_startswith="the", no_leading_digit=True, min_len=40)
    return P.require_fields(d, ["text", "lang", "source"]).select("doc_id")


@query("prd_valid_year", """
SELECT law_id, cast(year(d) as int) AS year FROM law_headers WHERE law_id % 4 <> 3""",
       views=["law_headers"], ops="PRD-5")
def prd_valid_year(spark, sf):
    return P.valid_year(view(spark, sf, "law_headers"), "hdr", 1970, 2025).select("law_id", "year")


@query("prd_success_only", "SELECT k, event_id FROM fetch_log WHERE status = 'Downloaded'", views=["fetch_log"], ops="PRD-9")
def prd_success_only(spark, sf):
    return P.successful_only(view(spark, sf, "fetch_log"), "status", "Downloaded").select("k", "event_id")


@query("prd_in_categories", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')", ops="PRD-6")
def prd_in_categories(spark, sf):
    return P.in_categories(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey")


# ------------------------------------------------------------------ joins

@query("jon_todo", "SELECT y, n FROM probe_grid WHERE NOT found AND y >= 1997", views=["probe_grid"], ops="JON-1")
def jon_todo(spark, sf):
    g = view(spark, sf, "probe_grid").withColumn("key", F.concat_ws("_", "y", "n"))
    done = g.filter("found").select("key")
    done_years = g.filter(F.col("y") < 1997).select("y")
    return J.todo(g.select("y", "n", "key"), done, on="key", done_years=done_years, year="y").select("y", "n")


_INV_SQL = """(SELECT DISTINCT concat('R', lpad(cast(o_custkey % 18 as string), 2, '0'), '_', cast(o_orderkey % 200 + 1 as string),
                 '_', strftime(cast(o_orderdate as date), '%Y-%m-%d'), '.pdf') AS name FROM orders WHERE o_orderstatus = 'F')"""


def _inventory(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return o.select(
        K.law_filename(
            F.concat(F.lit("R"), F.lpad((F.col("o_custkey") % 18).cast("string"), 2, "0")),
            (F.col("o_orderkey") % 200 + 1),
            D.date_display(F.col("o_orderdate").cast("date"), "iso"),
        ).alias("name")
    )


@query("jon_mark_existing", f"""
SELECT law_id, {FILENAME_SQL} AS filename, {FILENAME_SQL} IN (SELECT name FROM {_INV_SQL}) AS exists
FROM law_headers""", views=["law_headers"], ops="JON-2")
def jon_mark_existing(spark, sf):
    laws = _filenames(spark, sf).select("law_id", "filename")
    return J.mark_existing(laws, _inventory(spark, sf), "filename", "name", keep_row=True)


@query("jon_skip_existing", f"""
SELECT law_id FROM law_headers WHERE {FILENAME_SQL} NOT IN (SELECT name FROM {_INV_SQL})""",
       views=["law_headers"], ops="JON-2")
def jon_skip_existing(spark, sf):
    laws = _filenames(spark, sf).select("law_id", "filename")
    return J.mark_existing(laws, _inventory(spark, sf), "filename", "name", keep_row=False).select("law_id")


@query("jon_listing_detail", """
SELECT l.page_no, l.pos, l.url, coalesce(p.p_name, concat('Voce ', cast(l.pos as string))) AS title
FROM listing l LEFT JOIN (SELECT concat('https://x.example/dettaglio?pk_lr=', cast(p_partkey as string)) AS url, p_name
                          FROM part WHERE p_size <= 25) p ON l.url = p.url""", views=["listing"], ops="JON-3")
def jon_listing_detail(spark, sf):
    li = view(spark, sf, "listing").withColumn("list_title", F.concat(F.lit("Voce "), F.col("pos").cast("string")))
    part = table(spark, sf, "part").filter(F.col("p_size") <= 25)
    detail = part.select(
        F.concat(F.lit("https://x.example/dettaglio?pk_lr="), F.col("p_partkey").cast("string")).alias("url"),
        F.col("p_name").alias("title"),
    )
    return J.listing_with_detail(li, detail, on="url", fields=("title",)).select("page_no", "pos", "url", "title")


@query("jon_law_category", """
SELECT DISTINCT o.o_orderkey AS law_id, c.category FROM orders o JOIN (
  SELECT c_custkey AS key, c_mktsegment AS category FROM customer
  UNION SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) c ON o.o_custkey = c.key""",
       ops="JON-4")
def jon_law_category(spark, sf):
    laws = table(spark, sf, "orders").select(F.col("o_orderkey").alias("law_id"), F.col("o_custkey").alias("key"))
    cust = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    cats = cust.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("category")).unionByName(
        cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("key"), F.col("n_name").alias("category"))
    )
    return J.law_with_category(laws, cats, on="key").select("law_id", "category").distinct()


@query("jon_law_documents", """
SELECT h.law_id, h.region, d.pos, d.href FROM law_headers h JOIN law_docs d ON h.law_id = d.law_id""",
       views=["law_headers", "law_docs"], ops="JON-6")
def jon_law_documents(spark, sf):
    laws = view(spark, sf, "law_headers").select("law_id", "region")
    docs = view(spark, sf, "law_docs")
    return J.law_documents(laws, docs, "law_id").select("law_id", "region", "pos", "href")


@query("jon_month_lookup", """
SELECT law_id, CASE WHEN law_id % 4 IN (0, 2) THEN cast(month(d) as int) END AS month FROM law_headers""",
       views=["law_headers"], ops="JON-5")
def jon_month_lookup(spark, sf):
    lh = view(spark, sf, "law_headers").withColumn("mname", F.nullif(F.regexp_extract("hdr", D.IT_DATE_RX, 2), F.lit("")))
    return J.month_lookup(lh, "mname").select("law_id", F.col("month").cast("int").alias("month"))


# ------------------------------------------------------------------ reports

@query("agg_laws_per_year", f"""
SELECT cast(s.range AS int) AS year, cast(coalesce(c.n, 0) as bigint) AS n_laws
FROM range(1990, 2006) s LEFT JOIN (SELECT year(d) AS y, count(*) AS n FROM law_headers GROUP BY 1) c ON s.range = c.y""",
       views=["law_headers"], ops="AGG-1 KEY-4")
def agg_laws_per_year(spark, sf):
    names = _filenames(spark, sf).select(K.parse_filename("filename")["year"].alias("year"))
    return R.laws_per_year(names, "year", 1990, 2005)


@query("agg_status_counts", "SELECT status, count(*) AS n FROM fetch_log GROUP BY status", views=["fetch_log"], ops="AGG-2")
def agg_status_counts(spark, sf):
    return R.status_counts(view(spark, sf, "fetch_log"), "status")


@query("agg_status_wide", """
SELECT cast(count_if(status = 'Downloaded') as bigint) AS downloaded, cast(count_if(status = 'Skipped') as bigint) AS skipped,
       cast(count_if(status = 'Failed') as bigint) AS failed FROM fetch_log""", views=["fetch_log"], ops="AGG-2")
def agg_status_wide(spark, sf):
    return R.status_counts(view(spark, sf, "fetch_log"), "status",
                           wide={"downloaded": ["Downloaded"], "skipped": ["Skipped"], "failed": ["Failed"]})


@query("agg_completeness", """
SELECT region, cast(count_if(law_id % 4 = 3) as bigint) AS missing_number, cast(count_if(law_id % 4 = 3) as bigint) AS missing_date,
       cast(count_if(law_id % 4 <> 3) as bigint) AS complete, count(*) AS total FROM law_headers GROUP BY region""",
       views=["law_headers"], ops="AGG-3")
def agg_completeness(spark, sf):
    idx = law_index_from_headers(view(spark, sf, "law_headers"))
    return R.completeness(idx, "law_number", "law_date", by="region")


def _with_source(li):
    # the listing's portal = the URL host (one portal here; a real listing table holds many)
    return li.withColumn("source", F.regexp_extract("url", r"^https?://([^/?#]+)", 1))


@query("agg_links_per_page", """
WITH f AS (SELECT url, min(page_no) AS p FROM listing GROUP BY url),
     n AS (SELECT p AS page_no, count(*) AS new FROM f GROUP BY p)
SELECT 'x.example' AS source, l.page_no, count(*) AS found, coalesce(max(n.new), 0) AS new
FROM listing l LEFT JOIN n ON l.page_no = n.page_no GROUP BY l.page_no""", views=["listing"], ops="AGG-4")
def agg_links_per_page(spark, sf):
    li = _with_source(view(spark, sf, "listing"))
    return R.links_per_page(li, "source", "page_no", "url")


_LINES_SQL = r"""(SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]'),
         lambda x: regexp_replace(x, '^[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B]+|[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B]+$', '', 'g')),
         lambda x: x <> '') AS ls FROM documents))"""


def _doc_lines(spark, sf):
    d = many(table(spark, sf, "documents"))
    return d.select("doc_id", F.posexplode(T.lines_split("text")).alias("p0", "line")).select(
        "doc_id", (F.col("p0") + 1).alias("pos"), "line")


@query("agg_longest_line", f"""
SELECT doc_id, line FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, pos) AS r
                          FROM {_LINES_SQL} WHERE length(line) > 40) WHERE r = 1""", ops="AGG-5 TXT-12")
def agg_longest_line(spark, sf):
    return R.longest_text(_doc_lines(spark, sf), "doc_id", "line", "pos", floor=40)


@query("agg_first_where", fr"""
SELECT doc_id, line FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r
                          FROM {_LINES_SQL} WHERE length(line) > 20 AND NOT regexp_matches(line, '^\d')) WHERE r = 1""",
       ops="AGG-6")
def agg_first_where(spark, sf):
    pred = (F.length("line") > 20) & ~F.col("line").rlike(r"^\d")
    return R.first_where(_doc_lines(spark, sf), "doc_id", pred, "line", "pos")


@query("agg_distinct_years", "SELECT DISTINCT cast(year(d) as int) AS year FROM law_headers", views=["law_headers"],
       ops="AGG-7 SRT-1")
def agg_distinct_years(spark, sf):
    lh = view(spark, sf, "law_headers").select(F.year("d").cast("int").alias("year"))
    return O.order_years(R.distinct_years(lh, "year"), "year")


# ------------------------------------------------------------------ cut-offs and positions

@query("win_cut_after_misses", """
WITH s AS (SELECT *, n - coalesce(max(CASE WHEN found THEN n END) OVER (PARTITION BY y ORDER BY n
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak FROM probe_grid),
     c AS (SELECT y, coalesce(min(CASE WHEN streak >= 10 THEN n END), max(n)) AS cut FROM s GROUP BY y)
SELECT s.y, count(*) AS probed, cast(count_if(found) as bigint) AS hits FROM s JOIN c ON s.y = c.y AND s.n <= c.cut GROUP BY s.y""",
       views=["probe_grid"], ops="WIN-1")
def win_cut_after_misses(spark, sf):
    kept = C.cut_after_misses(view(spark, sf, "probe_grid"), "y", "n", "found", k=10)
    return kept.groupBy("y").agg(F.count(F.lit(1)).alias("probed"), F.count_if("found").alias("hits"))


@query("win_cut_empty_pages", """
WITH ok AS (SELECT k, attempt, CASE WHEN status = 'Skipped' THEN 0 ELSE 1 END AS n_links FROM fetch_log WHERE status <> 'Failed'),
     s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY attempt) AS i FROM ok),
     s2 AS (SELECT *, i - coalesce(max(CASE WHEN n_links > 0 THEN i END) OVER (PARTITION BY k ORDER BY attempt
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak FROM s),
     st AS (SELECT k, min(attempt) AS stop FROM s2 WHERE streak >= 3 GROUP BY k)
SELECT f.k, f.attempt FROM fetch_log f LEFT JOIN st ON f.k = st.k WHERE st.stop IS NULL OR f.attempt <= st.stop""",
       views=["fetch_log"], ops="WIN-2")
def win_cut_empty_pages(spark, sf):
    fl = view(spark, sf, "fetch_log").select(
        "k", "attempt",
        F.when(F.col("status") == "Skipped", F.lit(0)).otherwise(F.lit(1)).alias("n_links"),
        (F.col("status") == "Failed").alias("failed"),
    )
    return C.cut_after_empty_pages(fl, "k", "attempt", "n_links", "failed", k=3).select("k", "attempt")


@query("win_cut_no_news", """
WITH f AS (SELECT url, min(page_no) AS p FROM listing GROUP BY url),
     pg AS (SELECT l.page_no, count(DISTINCT CASE WHEN f.p = l.page_no THEN l.url END) AS new FROM listing l JOIN f ON l.url = f.url GROUP BY l.page_no),
     st AS (SELECT min(page_no) AS stop FROM pg WHERE new = 0)
SELECT page_no, pos FROM listing, st WHERE st.stop IS NULL OR page_no < st.stop""", views=["listing"], ops="WIN-3")
def win_cut_no_news(spark, sf):
    li = _with_source(view(spark, sf, "listing"))
    return C.cut_when_no_news(li, "source", "page_no", "url").select("page_no", "pos")


@query("win_drop_revisits", """
WITH f AS (SELECT page_no, url, min(pos) AS fp FROM listing GROUP BY page_no, url),
     st AS (SELECT l.page_no, min(l.pos) AS stop FROM listing l JOIN f ON l.page_no = f.page_no AND l.url = f.url
            WHERE l.pos > f.fp GROUP BY l.page_no)
SELECT l.page_no, l.pos FROM listing l LEFT JOIN st ON l.page_no = st.page_no WHERE st.stop IS NULL OR l.pos < st.stop""",
       views=["listing"], ops="WIN-4")
def win_drop_revisits(spark, sf):
    return C.drop_revisits(view(spark, sf, "listing"), "page_no", "pos", "url").select("page_no", "pos")


_INV_EVENTS = """(SELECT event_type, concat('/store/', event_type, '/', cast(event_id as string),
   CASE event_id % 10 WHEN 0 THEN '.crdownload' WHEN 1 THEN '.tmp' ELSE '.pdf' END) AS path, ts AS mtime FROM events)"""


def _events_inventory(spark, sf):
    e = table(spark, sf, "events")
    ext = F.when(F.col("event_id") % 10 == 0, F.lit(".crdownload")).when(F.col("event_id") % 10 == 1, F.lit(".tmp")).otherwise(F.lit(".pdf"))
    return e.select("event_type", F.concat(F.lit("/store/"), "event_type", F.lit("/"), F.col("event_id").cast("string"), ext).alias("path"),
                    F.col("ts").alias("mtime"))


@query("win_latest_file", f"""
SELECT event_type, path, mtime FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY mtime DESC, path DESC) AS r
  FROM {_INV_EVENTS} WHERE NOT (ends_with(lower(path), '.crdownload') OR ends_with(lower(path), '.tmp'))) WHERE r = 1""",
       ops="WIN-5")
def win_latest_file(spark, sf):
    return C.latest_file(_events_inventory(spark, sf), "path", "mtime", group="event_type")


@query("set_new_files", f"""
SELECT path FROM {_INV_EVENTS} WHERE path NOT IN (SELECT path FROM {_INV_EVENTS} WHERE mtime < TIMESTAMP '2024-01-15 00:00:00')""",
       ops="SET-6")
def set_new_files(spark, sf):
    inv = _events_inventory(spark, sf)
    before = inv.filter(F.col("mtime") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return S.new_files(before.select("path"), inv.select("path"), "path")


@query("win_resolve_attempts", """
WITH t AS (SELECT * FROM fetch_log WHERE attempt <= 3),
     ff AS (SELECT k, min(attempt) AS a FROM t WHERE status IN ('Downloaded', 'Skipped') GROUP BY k),
     la AS (SELECT k, max(attempt) AS a FROM t GROUP BY k)
SELECT la.k, cast(coalesce(ff.a, la.a) as int) AS attempt, t.status, cast(coalesce(ff.a, la.a) as int) AS tries
FROM la LEFT JOIN ff ON la.k = ff.k JOIN t ON t.k = la.k AND t.attempt = coalesce(ff.a, la.a)""",
       views=["fetch_log"], ops="WIN-6")
def win_resolve_attempts(spark, sf):
    return C.resolve_attempts(view(spark, sf, "fetch_log"), "k", "attempt", "status", max_tries=3)


@query("win_number_rows", "SELECT law_id, row_number() OVER (ORDER BY d, law_id) AS pos FROM law_headers",
       views=["law_headers"], ops="WIN-7")
def win_number_rows(spark, sf):
    return C.number_rows(view(spark, sf, "law_headers").select("law_id", "d"), ["d", "law_id"]).select("law_id", "pos")


@query("win_number_docs", """
SELECT law_id, pos, href, cast(row_number() OVER (PARTITION BY law_id ORDER BY pos, href) as int) AS doc_no FROM law_docs""",
       views=["law_docs"], ops="WIN-7")
def win_number_docs(spark, sf):
    return C.number_rows(view(spark, sf, "law_docs"), ["pos", "href"], partition="law_id", out="doc_no")


@query("srt_rank_by_date", """
SELECT law_id, row_number() OVER (ORDER BY CASE WHEN law_id % 4 = 3 THEN NULL ELSE d END ASC NULLS LAST, hdr, law_id) AS pos
FROM law_headers""", views=["law_headers"], ops="SRT-3")
def srt_rank_by_date(spark, sf):
    # the same keys as order_by_date, as a distributed position
    lh = view(spark, sf, "law_headers").select("law_id", "hdr")
    return C.number_rows(lh, O.date_order_keys("hdr") + [F.col("law_id")]).select("law_id", "pos")


@query("srt_rank_year_number", """
SELECT law_id, row_number() OVER (ORDER BY CASE WHEN law_id % 4 = 3 THEN 9999 ELSE year(d) END,
                                           CASE WHEN law_id % 4 = 3 THEN 9999 ELSE no END,
                                           CASE WHEN law_id % 4 = 3 THEN 'https://x.example/leggi/altro.html'
                                                ELSE concat('https://x.example/leggi/lr', cast(year(d) as string), '-', cast(no as string), '.html') END,
                                           law_id) AS pos
FROM law_headers""", views=["law_headers"], ops="SRT-2 URL-5")
def srt_rank_year_number(spark, sf):
    lh = view(spark, sf, "law_headers")
    url = F.when(F.col("law_id") % 4 != 3, F.format_string("https://x.example/leggi/lr%d-%d.html", F.year("d"), F.col("no"))) \
        .otherwise(F.lit("https://x.example/leggi/altro.html"))
    return C.number_rows(lh.select("law_id", url.alias("url")), O.year_number_keys("url") + [F.col("law_id")]).select("law_id", "pos")


@query("srt_oldest_laws", """
SELECT law_id, hdr FROM law_headers ORDER BY CASE WHEN law_id % 4 = 3 THEN NULL ELSE d END ASC NULLS LAST, hdr, law_id LIMIT 50""",
       views=["law_headers"], ops="SRT-3")
def srt_oldest_laws(spark, sf):
    """Top-k report: the oldest laws (ties by text, then id)."""
    lh = view(spark, sf, "law_headers").select("law_id", "hdr")
    return O.order_by_date(lh, "hdr", "law_id").limit(50)


@query("srt_first_numbers", """
SELECT law_id, url FROM (SELECT law_id, concat('https://x.example/leggi/lr', cast(year(d) as string), '-', cast(no as string), '.html') AS url, year(d) AS y, no
                         FROM law_headers) ORDER BY y, no, url, law_id LIMIT 50""", views=["law_headers"], ops="SRT-2")
def srt_first_numbers(spark, sf):
    """Top-k report: the first laws by year and number."""
    url = F.format_string("https://x.example/leggi/lr%d-%d.html", F.year("d"), F.col("no"))
    return O.order_year_number(view(spark, sf, "law_headers").select("law_id", url.alias("url")), "url", "law_id").limit(50)


@query("lim_page_limit", "SELECT page_no, pos FROM listing WHERE page_no < 107", views=["listing"], ops="LIM-1")
def lim_page_limit(spark, sf):
    return C.page_limit(view(spark, sf, "listing"), "page_no", 107, first_page=0).select("page_no", "pos")


@query("lim_per_year", """
SELECT law_id, cast(year(d) as int) AS year FROM (SELECT *, row_number() OVER (PARTITION BY year(d) ORDER BY no, law_id) AS r
  FROM law_headers) WHERE r <= 50""", views=["law_headers"], ops="LIM-1")
def lim_per_year(spark, sf):
    lh = view(spark, sf, "law_headers").withColumn("year", F.year("d").cast("int"))
    return C.page_limit(lh, "no", 50, per="year", order=["no", "law_id"]).select("law_id", "year")


# ------------------------------------------------------------------ set operators

@query("set_distinct_ordered", """
SELECT url, page_no, pos FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_no, pos) AS r FROM listing) WHERE r = 1""",
       views=["listing"], ops="SET-1")
def set_distinct_ordered(spark, sf):
    return S.distinct_ordered(view(spark, sf, "listing"), "url", ["page_no", "pos"])


@query("set_distinct_any", "SELECT DISTINCT law_id, pos, href FROM law_docs", views=["law_docs"], ops="SET-2")
def set_distinct_any(spark, sf):
    return S.distinct_any(view(spark, sf, "law_docs"))


@query("set_distinct_across", """
SELECT url, year, law_id AS pos FROM (SELECT concat('https://x.example/legge/', cast(no as string)) AS url, cast(year(d) as int) AS year,
  law_id, row_number() OVER (PARTITION BY no ORDER BY year(d) DESC, law_id) AS r FROM law_headers) WHERE r = 1""",
       views=["law_headers"], ops="SET-3")
def set_distinct_across(spark, sf):
    lh = view(spark, sf, "law_headers").select(
        F.concat(F.lit("https://x.example/legge/"), F.col("no").cast("string")).alias("url"),
        F.year("d").cast("int").alias("year"), F.col("law_id").alias("pos"))
    return S.distinct_across(lh, "url", "year", "pos")


@query("set_dedupe_file", f"""
SELECT filename, law_id FROM (SELECT {FILENAME_SQL} AS filename, law_id,
  row_number() OVER (PARTITION BY {FILENAME_SQL} ORDER BY law_id) AS r FROM law_headers) WHERE r = 1""",
       views=["law_headers"], ops="SET-4")
def set_dedupe_file(spark, sf):
    return S.dedupe_file(_filenames(spark, sf).select("filename", "law_id"), "filename", "law_id")


@query("set_last_writer_wins", f"""
SELECT filename, law_id FROM (SELECT {FILENAME_SQL} AS filename, law_id,
  row_number() OVER (PARTITION BY {FILENAME_SQL} ORDER BY law_id DESC) AS r FROM law_headers) WHERE r = 1""",
       views=["law_headers"], ops="SET-7")
def set_last_writer_wins(spark, sf):
    return S.last_writer_wins(_filenames(spark, sf).select("filename", "law_id"), "filename", "law_id")


@query("set_union_indexes", """
SELECT law_id, region, CASE WHEN law_id % 4 = 3 THEN NULL ELSE cast(no as string) END AS law_number, CAST(NULL AS date) AS law_date
FROM law_headers
UNION ALL
SELECT law_id, region, NULL, CASE WHEN law_id % 4 = 3 THEN NULL ELSE d END FROM law_headers""",
       views=["law_headers"], ops="SET-5")
def set_union_indexes(spark, sf):
    idx = law_index_from_headers(view(spark, sf, "law_headers"))
    return S.union_indexes(idx.select("law_id", "region", "law_number"), idx.select("law_id", "region", "law_date"))


@query("set_purge_repealed", r"""
SELECT doc_id, concat('doc://', cast(doc_id as string)) AS source_url FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM repeal_text WHERE regexp_matches(body, '(?i)\(\s*Abrogata\s*\)'))""",
       views=["repeal_text"], ops="SET-8")
def set_purge_repealed(spark, sf):
    idx = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("source_url"))
    rep = view(spark, sf, "repeal_text").filter(P.is_repealed_strict("body"))
    rep = rep.select(F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("source_url"))
    return S.purge_repealed(idx, rep, "source_url")
