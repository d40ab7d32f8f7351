"""Checks for HTML extraction: regex forms on ``pages``, dom selectors on ``law_pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from regesto.functions import elements as E
from regesto.functions import html as H
from regesto.functions import keys as K
from regesto.functions import urls as U
from regesto.plans.q_scalars import norm_ws_sql
from regesto.plans.registry import ORACLES, query
from regesto.sources.fixtures import VIEW_DEPS, VIEW_SQL, many, table, view


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# the entities that the pages of the test tables hold; each in its own words, not the code's
_KNOWN = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&egrave;", "è"), ("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&mdash;", "—"), ("&amp;", "&"))


def unescape_sql(x: str) -> str:
    for ent, ch in _KNOWN:
        x = f"replace({x}, {sql_str(ent)}, {sql_str(ch)})"
    return x


def inner_text_sql(x: str) -> str:
    return norm_ws_sql(unescape_sql(f"regexp_replace({x}, {sql_str(H.TAG_RX)}, ' ', 'g')"))


BASE = "https://portal.example"


# the links of the test pages, as those are written: one attribute, in double quotes
_PAGE_LINK = r'<a href="([^"]*)">(.*?)</a>'


def _page_links(group: int) -> str:
    return f"regexp_extract_all(html, {sql_str(_PAGE_LINK)}, {group})"


@query("html_links", f"""
SELECT page_id, url, cast(pos as int) AS pos, href,
  CASE WHEN starts_with(href, 'http') THEN href ELSE concat('{BASE}', href) END AS abs_url
FROM (SELECT page_id, url, unnest(arr) AS href, unnest(range(1, len(arr) + 1)) AS pos
      FROM (SELECT page_id, url, {_page_links(1)} AS arr FROM pages))
WHERE NOT (href IS NULL OR trim(href) = '' OR contains(lower(href), 'javascript'))""", ops="HTM-1 URL-1 URL-6")
def html_links(spark, sf):
    links = H.extract_links(many(table(spark, sf, "pages")))
    return U.drop_script_links(links).select(
        "page_id", "url", "pos", "href", U.absolutise("href", BASE).alias("abs_url")
    )


@query("html_anchors", f"""
SELECT page_id, url, cast(pos as int) AS pos, nullif(href, '') AS href, {inner_text_sql('t')} AS text,
  cast(NULL as varchar) AS title, cast(NULL as varchar) AS cls
FROM (SELECT page_id, url, unnest(aa) AS href, unnest(tt) AS t, unnest(range(1, len(aa) + 1)) AS pos
      FROM (SELECT page_id, url, {_page_links(1)} AS aa, {_page_links(2)} AS tt FROM pages))""", ops="HTM-2")
def html_anchors(spark, sf):
    return H.extract_anchors(many(table(spark, sf, "pages")))


# four anchors per law, with every kind of quote; what a browser reads stands beside them
_ATTR_ROWS = """
SELECT law_id AS page_id, 1 AS pos, concat('/u/', cast(law_id as string)) AS href, 'Testo' AS text,
       concat('L', chr(39), 'atto > n. ', cast(no as string)) AS title, 'b x' AS cls FROM law_headers
UNION ALL SELECT law_id, 2, concat('/v?a=1&b=', cast(law_id as string)), concat('B & ', region),
       concat('detto ', chr(34), region, chr(34), ' è'), NULL FROM law_headers
UNION ALL SELECT law_id, 3, NULL, 'senza', NULL, 'first' FROM law_headers
UNION ALL SELECT law_id, 4, concat('/l', chr(39), 'acqua'), hdr, NULL, NULL FROM law_headers"""
VIEW_SQL["attr_pages"] = """
SELECT law_id AS page_id, concat('https://x.example/', cast(law_id as string)) AS url,
  concat('<p><!-- <a href="/no">no</a> --><script>var a = "<a href=/no2>";</script><a class=', chr(39), 'b x', chr(39),
         ' title="L', chr(39), 'atto > n. ', cast(no as string), '" href=/u/', cast(law_id as string), '>Testo</a>',
         '<A data-href="/z" HREF = ', chr(39), '/v?a=1&amp;b=', cast(law_id as string), chr(39), ' title=', chr(39), 'detto ', chr(34), region, chr(34),
         ' &egrave;', chr(39), '>B &amp; ', region, '</A><a name="n" disabled class=first class="second">senza</a>',
         '<a href="/l', chr(39), 'acqua"title>', hdr, '</a></p>') AS html
FROM law_headers"""
VIEW_DEPS["attr_pages"] = ("law_headers",)


@query("html_quotes", _ATTR_ROWS, views=["law_headers"], ops="HTM-2")
def html_quotes(spark, sf):
    """Attributes in double quotes, in single quotes, in none, in any case, twice and without a value."""
    return H.extract_anchors(view(spark, sf, "attr_pages"), keep=("page_id",))


@query("html_attr_values", f"""
SELECT page_id, string_agg(href, ' | ' ORDER BY pos) AS hrefs, regexp_extract(max(CASE WHEN pos = 2 THEN href END), 'b=([0-9]+)', 1) AS second
FROM ({_ATTR_ROWS}) x WHERE href IS NOT NULL GROUP BY page_id""", views=["law_headers"], ops="HTM-1 HTM-10")
def html_attr_values(spark, sf):
    p = view(spark, sf, "attr_pages")
    links = H.extract_links(p, keep=("page_id", "html"))
    hrefs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "href"))), lambda x: x["href"]), " | ")
    return links.groupBy("page_id").agg(hrefs.alias("hrefs"), F.min(H.attr_regex("html", "a", "href", r"b=(\d+)")).alias("second"))


_PT = "html"
for _rx in (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->"):
    _PT = f"regexp_replace({_PT}, {sql_str(_rx)}, ' ', 'g')"


def _elem_sql(tag: str) -> str:
    inner = f"nullif(regexp_extract(html, {sql_str(rf'(?is)<{tag}\b[^>]*[^>]*>(.*?)</{tag}\s*>')}, 1), '')"
    return f"nullif({inner_text_sql(inner)}, '')"


@query("html_page_text", f"""
SELECT page_id, {inner_text_sql(_PT)} AS page_text, strlen(html) > 2000 AS big_enough
FROM pages""", ops="HTM-3")
def html_page_text(spark, sf):
    p = many(table(spark, sf, "pages"))
    return p.select("page_id", H.page_text("html").alias("page_text"), (F.octet_length("html") > 2000).alias("big_enough"))


_H1_INNER = f"nullif(regexp_extract(html, {sql_str(r'(?is)<h1\b[^>]*[^>]*>(.*?)</h1\s*>')}, 1), '')"
_LANG_VALS = f"regexp_extract_all(html, {sql_str(r'''(?is)<html\b[^>]*?\blang\s*=\s*["']([^"']*)["']''')}, 1)"


@query("html_elements", f"""
SELECT page_id,
  {_elem_sql('h1')} AS h1,
  coalesce({_elem_sql('h1')}, {_elem_sql('h2')}, {_elem_sql('h3')}, {_elem_sql('h4')}) AS heading,
  trim(regexp_replace({_H1_INNER}, {sql_str(H.TAG_RX)}, '', 'g')) AS h1_stripped,
  list_filter(list_transform({_LANG_VALS}, lambda v: nullif(regexp_extract(v, '^([a-z]+)', 1), '')), lambda v: v IS NOT NULL)[1] AS lang
FROM pages""", ops="HTM-4 HTM-5 HTM-8 HTM-10")
def html_elements(spark, sf):
    p = many(table(spark, sf, "pages"))
    return p.select(
        "page_id",
        H.element_text("html", "h1").alias("h1"),
        H.first_heading("html").alias("heading"),
        H.strip_tags(H.element_html("html", "h1")).alias("h1_stripped"),
        H.attr_regex("html", "html", "lang", r"^([a-z]+)").alias("lang"),
    )


@query("dom_page_links", f"""
SELECT page_id, cast(pos as int) AS pos, {unescape_sql('href')} AS href
FROM (SELECT page_id, unnest(arr) AS href, unnest(range(1, len(arr) + 1)) AS pos
      FROM (SELECT page_id, {_page_links(1)} AS arr FROM pages))""", ops="HTM-0")
def dom_page_links(spark, sf):
    """The one Arrow pass over the given pages."""
    dom = H.parse_dom(many(table(spark, sf, "pages")), parts=("links",))
    return dom.select("page_id", F.explode("dom.links").alias("l")).select("page_id", F.col("l.pos").cast("int").alias("pos"), F.col("l.href").alias("href"))


@query("url_join_depth", """
SELECT law_id, concat('https://leggi.example/', CASE law_id % 4
    WHEN 0 THEN concat('x', cast(law_id as string)) WHEN 1 THEN concat('a/b/x', cast(law_id as string))
    WHEN 2 THEN concat('c/', cast(law_id as string), '/') ELSE concat('a/b/c/d/e/f/g/h/x?q=../', cast(law_id as string)) END) AS url
FROM law_headers""", views=["law_headers"], ops="URL-2")
def url_join_depth(spark, sf):
    """Dot segments to any depth, above the root, in rooted references, and none in a query."""
    n = F.col("law_id").cast("string")
    href = (
        F.when(F.col("law_id") % 4 == 0, F.concat(F.lit("../../../../../../../../../../x"), n))
        .when(F.col("law_id") % 4 == 1, F.concat(F.lit("../../../../../../x"), n))
        .when(F.col("law_id") % 4 == 2, F.concat(F.lit("/z/../c/./"), n, F.lit("/y/..")))
        .otherwise(F.concat(F.lit("./x?q=../"), n))
    )
    return view(spark, sf, "law_headers").select("law_id", U.url_join("https://leggi.example/a/b/c/d/e/f/g/h/pagina.html", href).alias("url"))


# ---------------------------------------------------------------- dom selectors on law_pages

_DMY = "concat(lpad(cast(day(d) as string), 2, '0'), '/', lpad(cast(month(d) as string), 2, '0'), '/', cast(year(d) as string))"


@query("dom_law_fields", f"""
SELECT law_id AS page_id, concat('Legge ', cast(law_id as string)) AS title, hdr AS h1,
  concat('Testo introduttivo ', cast(law_id as string)) AS after_h1,
  concat('Titolo ', cast(law_id as string)) AS title_clean,
  concat('Titolo ', cast(law_id as string), ' BUR 1') AS title_raw,
  cast(no as string) AS number_label, {_DMY} AS date_label, true AS has_doc
FROM law_headers""", views=["law_headers"], ops="HTM-0 HTM-7 HTM-9 HTM-11 HTM-12")
def dom_law_fields(spark, sf):
    dom = H.parse_dom(view(spark, sf, "law_pages"), parts=("title", "headings", "blocks", "labels", "links"))
    return dom.select(
        "page_id",
        F.col("dom.title").alias("title"),
        H.heading_text("dom", "h1").alias("h1"),
        H.neighbour_text("dom", "next_text", "h1").alias("after_h1"),
        H.text_without("dom", id_="titoloAtto").alias("title_clean"),
        H.block_text("dom", id_="titoloAtto", clean=False).alias("title_raw"),
        H.label_value("dom", "Numero", digits=True).alias("number_label"),
        H.label_value("dom", "Data", exclude=("BUR",)).alias("date_label"),
        H.has_document("dom").alias("has_doc"),
    )


@query("dom_table_cells", f"""
SELECT law_id AS page_id, 1 AS tbl, 2 AS row, c0.col AS col,
  CASE c0.col WHEN 1 THEN concat('n. ', cast(no as string)) WHEN 2 THEN {_DMY}
              WHEN 3 THEN concat('Disposizioni per la legge numero ', cast(no as string), ' della regione ', region)
              ELSE 'Seleziona' END AS text,
  c0.btn AS has_button
FROM law_headers,
     (SELECT 1 AS col, false AS btn UNION ALL SELECT 2, false UNION ALL SELECT 3, false UNION ALL SELECT 4, true) AS c0""",
       views=["law_headers"], ops="HTM-6")
def dom_table_cells(spark, sf):
    dom = H.parse_dom(view(spark, sf, "law_pages"), parts=("cells",))
    cells = H.table_cells(dom)
    return cells.select(
        "page_id", F.col("tbl").cast("int").alias("tbl"), F.col("row").cast("int").alias("row"),
        F.col("col").cast("int").alias("col"), "text", "has_button",
    )


@query("dom_documents", """
SELECT law_id AS page_id, d.doc_pos AS doc_pos, concat('/doc/', cast(law_id as string), d.suffix) AS href,
  d.doc_type AS doc_type
FROM law_headers, (SELECT 1 AS doc_pos, '_it.pdf' AS suffix, 'IT' AS doc_type UNION ALL SELECT 2, '_de.pdf', 'DE') AS d""",
       views=["law_headers"], ops="HTM-13 KEY-3")
def dom_documents(spark, sf):
    dom = H.parse_dom(view(spark, sf, "law_pages"), parts=("links",))
    docs = H.explode_documents(dom)
    return docs.select("page_id", "doc_pos", "href", K.doc_language("href").alias("doc_type"))


# ---------------------------------------------------------------- the same rows from the element table


def _scanned(spark, sf, name):
    pages = view(spark, sf, name) if name in VIEW_SQL else many(table(spark, sf, name))
    return pages.select("page_id", E.once(E.scan("html")).alias("page"))


@query("el_page_links", ORACLES["dom_page_links"], ops="HTM-0")
def el_page_links(spark, sf):
    """The native scan over the given pages."""
    links = F.filter(F.transform(E.elements("page", "a"), lambda a: E.attr("page", a, "href")), lambda h: h.isNotNull())
    return _scanned(spark, sf, "pages").select("page_id", F.posexplode(links).alias("p0", "href")).select("page_id", (F.col("p0") + 1).alias("pos"), "href")


@query("el_law_fields", ORACLES["dom_law_fields"], ops="HTM-0 HTM-7 HTM-9 HTM-11")
def el_law_fields(spark, sf):
    page = "page"
    h1 = E.first(E.elements(page, "h1"))
    title = E.first(E.elements(page, where=lambda e: E.has_attr(page, e, "id", "titoloAtto")))
    x = _scanned(spark, sf, "law_pages").select("page_id", page, h1.alias("h1"), title.alias("t"))
    return x.select(
        "page_id",
        E.text(page, E.first(E.elements(page, "title"))).alias("title"),
        E.text(page, F.col("h1")).alias("h1"),
        E.next_text(page, F.col("h1")).alias("after_h1"),
        E.text_without(page, F.col("t"), "bur").alias("title_clean"),
        E.text(page, F.col("t")).alias("title_raw"),
        E.label_value(page, "Numero", digits=True).alias("number_label"),
        E.label_value(page, "Data", exclude=("BUR",)).alias("date_label"),
        F.exists(E.elements(page, "a"), lambda a: F.coalesce(E.attr(page, a, "href"), F.lit("")).rlike(H.DOCUMENT_RX)).alias("has_doc"),
    )


@query("el_table_cells", ORACLES["dom_table_cells"], ops="HTM-6")
def el_table_cells(spark, sf):
    return _scanned(spark, sf, "law_pages").select("page_id", F.explode(E.cells("page")).alias("c")).select("page_id", "c.*")


@query("el_documents", ORACLES["dom_documents"], ops="HTM-13 KEY-3")
def el_documents(spark, sf):
    hrefs = F.transform(E.documents("page", "download-list", "card-teaser"), lambda a: E.attr("page", a, "href"))
    x = _scanned(spark, sf, "law_pages").select("page_id", F.posexplode(hrefs).alias("p0", "href"))
    return x.select("page_id", (F.col("p0") + 1).alias("doc_pos"), "href", K.doc_language("href").alias("doc_type"))
