"""Checks of the listing loops: listing pages -> laws -> details -> index.

The listing pages are made from ``law_headers``: a listing has a fixed number of laws, so with more
laws there are more listings, never larger pages.  The oracles tell from a law's id alone on which
page it stands and whether the loop gets there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions import elements as E
from regesto.plans import flows as FL
from regesto.plans import regions as RG
from regesto.plans.q_regions import ORACLE_SELECTS
from regesto.plans.registry import query
from regesto.sources import region_pages as RP
from regesto.sources.fixtures import many, table, tasks, view

COLS = [c for c, _ in RG.LAW_INDEX if c not in ("page_no", "category")]


def _html(*parts) -> Column:
    return F.concat(F.lit("<html><body>"), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("</body></html>"))


def _text(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _link(url: Column, text: Column | None = None, more: str = "") -> Column:
    return F.concat(F.lit(f"<li><a{more} href=\""), F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit('">'), F.lit("Legge") if text is None else text, F.lit("</a></li>"))


def _tasks(spark, sf) -> int:
    """Tasks for the listing pages: they grow in number with the laws."""
    return tasks(table(spark, sf, "orders"))


def _joined(rows: DataFrame, by, order: str = "page_id", n: int | None = None) -> DataFrame:
    """(by, items): the ``a`` of the rows of each page, in order; a page has a fixed number at most.
    The pages are made, and read, by ``n`` tasks: the rows are small, so Spark would take few."""
    dealt = rows if n is None else rows.repartition(n, *by)
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "a"))), lambda x: x["a"]), "")
    return dealt.groupBy(*by).agg(items.alias("items"))


def _oracle(region: str, page: str, keep: str, key: str = "id=", category: str = "category") -> str:
    """The region's records with the page number ``page`` where ``keep`` holds, both by the law's ``id``."""
    return f"""
SELECT {', '.join(COLS)}, cast({category} as varchar) AS category, cast(page_no as int) AS page_no FROM (
  SELECT *, {page} AS page_no FROM (
    SELECT * EXCLUDE (page_no), cast(regexp_extract(source_url, '{key}([0-9]+)', 1) as bigint) AS id FROM ({ORACLE_SELECTS[region]}) x) y) z
WHERE {keep}"""


# ------------------------------------------------------------------ numbered listings

PER_PAGE, FLOW_PAGES, EMPTY_FROM, EMPTY_TO = 10, 120, 100, 102  # pages of a listing, and those without a link
OF_LISTING = PER_PAGE * FLOW_PAGES
FLOW_REGIONS = ("campania", "umbria", "molise", "friuli", "veneto", "aosta", "lazio", "puglia", "trentino")
LAST_OFFERED = 90  # the pager of every third listing ends there


def _listing(spark, sf, region):
    """Listing pages (source, page_no, url, html, category): the laws' links by page, noise, and every
    fifth law again on the next page."""
    rule = FL.LISTINGS[region]
    pages = view(spark, sf, f"pages_{region}")
    pages = pages.withColumn("source", F.floor(F.col("page_id") / OF_LISTING)).withColumn("page_no", F.floor(F.col("page_id") % OF_LISTING / PER_PAGE).cast("int") + 1)
    link = F.col("html") if region == "aosta" else _link(F.col("url"), F.col("link_text") if "link_text" in pages.columns else None)
    once = pages.select("source", "page_no", "page_id", link.alias("a"))
    again = once.filter("page_id % 5 = 0").withColumn("page_no", F.least(F.col("page_no") + 1, F.lit(FLOW_PAGES)))
    both = once.unionByName(again).filter(~F.col("page_no").between(EMPTY_FROM, EMPTY_TO))
    numbers = pages.select("source").distinct().select("source", F.explode(F.sequence(F.lit(1), F.lit(FLOW_PAGES))).alias("page_no"))
    # a page without a law has a row too, so the pages come from one grouping
    rows = both.unionByName(numbers, allowMissingColumns=True).repartition(_tasks(spark, sf), "source", "page_no")
    laws = F.array_sort(F.collect_list(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "a"))))
    made = rows.groupBy("source", "page_no").agg(laws.alias("laws"))
    items = F.when(F.size("laws") > 0, F.array_join(F.transform("laws", lambda x: x["a"]), ""))
    offered = (F.col("source") % 3 != 0) | (F.col("page_no") < LAST_OFFERED)
    number = _text(F.col("page_no") + 1)
    pager = F.when(offered & (F.col("page_no") % 10 == 0), _link(F.lit("?"), F.lit(FL.ELLIPSIS))).when(offered, _link(F.lit("?"), number)).otherwise("")
    return made.select(
        "source",
        "page_no",
        F.concat(F.lit(f"https://{rule.host}/elenco?s="), _text("source"), F.lit("&page="), _text("page_no")).alias("url"),
        _html('<a href="/home">Home</a>', F.coalesce(items, F.lit("Nessun risultato")), pager if rule.stop == "pager" else "").alias("html"),
        F.concat(F.lit("Materia "), _text(F.col("page_no") % 5)).alias("category"),
    )


def _details(spark, sf, region):
    if region != "aosta":
        return view(spark, sf, f"pages_{region}")
    lh = many(view(spark, sf, "law_headers").select("law_id"))
    gone = F.when(F.col("law_id") % 17 == 0, F.lit("<p>Legge (abrogata dall’art. 1)</p>")).otherwise(F.lit(""))
    url = F.concat(F.lit("https://aosta.example/dettaglio?pk_lr="), _text("law_id"))
    # from a generator, so that what is asked of a page is not asked before the rows are dealt
    return lh.select(F.col("law_id").alias("page_id"), url.alias("url"), E.once(_html("Testo", gone)).alias("html"))


def _flow_oracle(region):
    # a law is met first on its own page, unless that page is empty: then on the next, if it is every fifth
    rule = FL.LISTINGS[region]
    own = f"((id % {OF_LISTING}) // {PER_PAGE} + 1)"
    first = f"""CASE WHEN {own} NOT BETWEEN {EMPTY_FROM} AND {EMPTY_TO} THEN {own}
                     WHEN id % 5 = 0 AND {own} = {EMPTY_TO} THEN {own} + 1 END"""
    keep = "page_no IS NOT NULL"
    if rule.stop in ("empty", "no_news"):
        keep += f" AND page_no < {EMPTY_FROM}"
    if rule.stop == "pager":
        keep += f" AND (page_no <= {LAST_OFFERED} OR (id // {OF_LISTING}) % 3 <> 0)"
    if rule.limit is not None:
        keep += f" AND page_no <= {rule.limit}"
    if region == "aosta":
        keep += " AND id % 17 <> 0"
    category = "concat('Materia ', cast(page_no % 5 as varchar))" if region == "friuli" else "category"
    return _oracle(region, first, keep, {"aosta": "pk_lr=", "trentino": "full/"}.get(region, "id="), category)


def _register_flow(region):
    def fn(spark, sf):
        return FL.index_listing(region, _listing(spark, sf, region), _details(spark, sf, region))

    more = {"campania": "JON-3 WIN-2 LIM-1", "friuli": "JON-3 JON-4", "aosta": "WIN-3 SET-8", "veneto": "JON-3 WIN-3", "lazio": "JON-3 WIN-3 LIM-1",
            "puglia": "JON-3 LIM-1"}.get(region, "JON-3")
    name = "flow_lazio_listing" if region == "lazio" else f"flow_{region}"
    query(name, _flow_oracle(region), views=["law_headers"], ops=f"shape A: REG {region} HTM-2 SET-1 URL-2 {more}")(fn)


for _key in FLOW_REGIONS:
    _register_flow(_key)


# a record of this region has the address of its listing page, so the law's own address names it here
_BASILICATA = f"""
SELECT {', '.join(c for c in COLS if c != 'source_url')}, category, cast(page_no as int) AS page_no,
  cast(concat('https://basilicata.example/elenco?s=', cast(id // {OF_LISTING} as varchar), '&page=', cast(page_no as varchar)) as varchar) AS source_url
FROM (SELECT *, ((id % {OF_LISTING}) // {PER_PAGE} + 1) AS page_no FROM (
  SELECT * EXCLUDE (page_no), cast(regexp_extract(source_url, 'p=([0-9]+)', 1) as bigint) AS id FROM ({ORACLE_SELECTS['basilicata']}) x) y) z
WHERE page_no <= {LAST_OFFERED} OR (id // {OF_LISTING}) % 3 <> 0"""


@query("flow_basilicata", _BASILICATA, views=["law_headers"], ops="shape A: REG basilicata")
def flow_basilicata(spark, sf):
    """Ten rows of the grid per page; the pager offers the next number, at the end of a block an ellipsis."""
    laws = view(spark, sf, "law_headers")
    laws = laws.select(F.col("law_id").alias("page_id"), F.expr(RP.BASILICATA_ROW).alias("a"))
    laws = laws.withColumn("source", F.floor(F.col("page_id") / OF_LISTING)).withColumn("page_no", F.floor(F.col("page_id") % OF_LISTING / PER_PAGE).cast("int") + 1)
    offered = (F.col("source") % 3 != 0) | (F.col("page_no") < LAST_OFFERED)
    cell = F.when(offered & (F.col("page_no") % 10 == 0), F.lit(FL.ELLIPSIS)).when(offered, _text(F.col("page_no") + 1))
    pager = F.coalesce(F.concat(F.lit('<tr><td><a href="#">'), cell, F.lit("</a></td></tr>")), F.lit(""))
    pages = _joined(laws, ["source", "page_no"], n=_tasks(spark, sf)).select(
        "source", "page_no", F.concat(F.lit("https://basilicata.example/elenco?s="), _text("source"), F.lit("&page="), _text("page_no")).alias("url"),
        _html('<table id="ctl00_GVElenco"><tr><th>Numero</th></tr>', F.col("items"), pager, "</table>").alias("html"),
    )
    return FL.index_listing("basilicata", pages)


# ------------------------------------------------------------------ listings along next links

CHAIN = 200  # pages of a chain: more than the cap
OF_CHAIN = PER_PAGE * CHAIN
LOOP_AT, LOOP_TO, LOST_AT, EMPTY_AT, SAME_AT, END_AT = 30, 10, 20, 25, 35, 60
STARTS = 50  # chains that a start page names

_CHAIN_PAGE = f"((id % {OF_CHAIN}) // {PER_PAGE} + 1)"
_CHAIN_KIND = f"((id // {OF_CHAIN}) % 5)"


def _chain(pages: DataFrame, a: Column, base: str, next_text: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(start pages, listing pages) of chains: 0 is long, 1 turns back, 2 leads to a page that is not
    there, 3 ends and has an empty page, 4 shows a page twice."""
    x = pages.withColumn("source", F.floor(F.col("page_id") / OF_CHAIN)).withColumn("page_no", F.floor(F.col("page_id") % OF_CHAIN / PER_PAGE).cast("int") + 1)
    kind = F.col("source") % 5
    shown = x.select("source", "page_no", "page_id", a.alias("a"))
    same = shown.filter((kind == 4) & (F.col("page_no") == SAME_AT - 1)).withColumn("page_no", F.lit(SAME_AT))
    empty = (kind == 3) & (F.col("page_no") == EMPTY_AT)
    shown = shown.withColumn("a", F.when(empty, F.lit("")).otherwise(F.col("a"))).filter(~((kind == 4) & (F.col("page_no") == SAME_AT))).unionByName(same)
    url = lambda n: F.concat(F.lit(base), _text("source"), F.lit("&pag="), _text(n))
    to = F.when((kind == 1) & (F.col("page_no") == LOOP_AT), F.lit(LOOP_TO)).when((kind == 2) & (F.col("page_no") == LOST_AT), F.lit(9999)).otherwise(F.col("page_no") + 1)
    more = F.when((F.col("page_no") == CHAIN) | ((kind == 3) & (F.col("page_no") == END_AT)), "").otherwise(_link(url(to), F.lit(next_text)))
    listing = _joined(shown, ["source", "page_no"], n=n).select(url(F.col("page_no")).alias("url"), _html('<a href="/home">»  Home</a>', F.col("items"), more).alias("html"))
    names = x.select("source").distinct().withColumn("a", _link(url(F.lit(1)), _text("source")))
    starts = _joined(names.withColumn("at", F.floor(F.col("source") / STARTS)), ["at"], "source")
    return starts.select(F.concat(F.lit(base), F.lit("indice-"), _text("at")).alias("url"), _html(F.col("items")).alias("html")), listing


def _piemonte(spark, sf):
    pages = view(spark, sf, "pages_piemonte")
    a = F.concat(_link(F.col("url"), None, ' class="dettaglio"'), _link(F.concat(F.col("url"), F.lit("&stampa=1"))))
    starts, listing = _chain(pages.select("page_id", "url"), a, "https://piemonte.example/elencoLeggi.do?anno=", "»", _tasks(spark, sf))
    return starts, listing, pages


_KEPT = (
    f"CASE {_CHAIN_KIND} WHEN 0 THEN page_no <= 100 WHEN 1 THEN page_no <= {LOOP_AT} WHEN 2 THEN page_no <= {LOST_AT} "
    f"WHEN 3 THEN page_no < {EMPTY_AT} ELSE page_no < {SAME_AT} END"
)


@query("flow_piemonte", _oracle("piemonte", _CHAIN_PAGE, _KEPT), views=["law_headers"], ops="shape A: REG piemonte HTM-2 WIN-3 SET-1 URL-2 JON-3")
def flow_piemonte(spark, sf):
    starts, listing, details = _piemonte(spark, sf)
    return FL.index_walk("piemonte", starts, listing, details)


@query("walk_piemonte", f"""
SELECT source, cast(count(*) as bigint) AS pages, max(stop) AS stop FROM (
  SELECT DISTINCT cast(id // {OF_CHAIN} as varchar) AS source, {_CHAIN_PAGE} AS page_no,
    CASE {_CHAIN_KIND} WHEN 1 THEN 'cycle' WHEN 2 THEN 'missing' WHEN 3 THEN 'last' ELSE 'cap' END AS stop,
    CASE {_CHAIN_KIND} WHEN 1 THEN {LOOP_AT} WHEN 2 THEN {LOST_AT} WHEN 3 THEN {END_AT} ELSE 100 END AS n
  FROM (SELECT law_id AS id FROM law_headers)) WHERE page_no <= n GROUP BY source""", views=["law_headers"], ops="REG piemonte URL-2")
def walk_piemonte(spark, sf):
    """Pages and stop reason of every chain: a turn back, a page that was not captured, an end, the cap."""
    starts, listing, _ = _piemonte(spark, sf)
    pages, _ = FL.walk_listing("piemonte", starts, listing)
    return pages.groupBy("source").agg(F.count("*").alias("pages"), F.max("stop").alias("stop"))


@query("flow_emilia", _oracle("emilia", _CHAIN_PAGE, f"""CASE {_CHAIN_KIND} WHEN 1 THEN page_no <= {LOOP_AT} WHEN 2 THEN page_no <= {LOST_AT}
    WHEN 3 THEN page_no <= {END_AT} AND page_no <> {EMPTY_AT} WHEN 4 THEN page_no <> {SAME_AT} ELSE true END""", "doc/"), views=["law_headers"], ops="shape A: REG emilia HTM-2 URL-2")
def flow_emilia(spark, sf):
    """Records in the listing; no page cap: a chain ends with its last page or where it turns back."""
    laws = view(spark, sf, "law_headers").select(F.col("law_id").alias("page_id"), F.expr(RP.EMILIA_BUTTON).alias("b"))
    starts, listing = _chain(laws, F.col("b"), "https://emilia.example/ricerca?anno=", "Succ. >>", _tasks(spark, sf))
    return FL.index_walk("emilia", starts, listing)


# ------------------------------------------------------------------ categories, trees, years

OF_CATEGORY, PAGES_OF_CATEGORY = 500, 20
LISTED = 15  # pages that the first page of every fourth category lists
CATEGORY_PAGE = OF_CATEGORY // PAGES_OF_CATEGORY


@query("flow_marche", _oracle(
    "marche", f"CASE WHEN id % 5 = 0 THEN 0 ELSE (id % {OF_CATEGORY}) // {CATEGORY_PAGE} END",
    f"page_no < {LISTED} OR (id // {OF_CATEGORY}) % 4 <> 3"), views=["law_headers"], ops="shape A: REG marche HTM-2 SET-1 URL-2 JON-3")
def flow_marche(spark, sf):
    """Start pages -> categories -> the pages that the first one lists -> laws; every fifth law is on the first page too."""
    details = view(spark, sf, "pages_marche")
    x = details.select("page_id", _link(F.col("url")).alias("a"), F.floor(F.col("page_id") / OF_CATEGORY).alias("cat"),
                       F.floor(F.col("page_id") % OF_CATEGORY / CATEGORY_PAGE).cast("int").alias("page_no"))
    shown = x.unionByName(x.filter("page_id % 5 = 0 AND page_no > 0").withColumn("page_no", F.lit(0)))
    cat = F.concat(F.lit("classificazioni.php?arc=vig&cat="), _text("cat"))
    url = F.when(F.col("page_no") == 0, cat).otherwise(F.concat(cat, F.lit("&page="), _text("page_no")))
    listed = F.when(F.col("cat") % 4 == 3, F.lit(LISTED - 1)).otherwise(F.lit(PAGES_OF_CATEGORY - 1))
    others = F.array_join(F.transform(F.sequence(F.lit(1), listed), lambda p: _link(F.concat(cat, F.lit("&page="), _text(p)), _text(p))), "")
    base = "https://marche.example/"
    listing = _joined(shown, ["cat", "page_no"], n=_tasks(spark, sf)).select(F.concat(F.lit(base), url).alias("url"), _html(F.col("items"), F.when(F.col("page_no") == 0, others).otherwise("")).alias("html"))
    names = x.select("cat").distinct().select(F.floor(F.col("cat") / STARTS).alias("at"), "cat", _link(cat, F.concat(F.lit("Materia "), _text("cat"))).alias("a"))
    starts = _joined(names, ["at"], "cat").select(F.concat(F.lit(base + "indice.php?n="), _text("at")).alias("url"), _html(F.col("items")).alias("html"))
    return FL.index_categories(starts, listing, details)


OF_TREE, OF_YEAR, FIRST_YEAR = 400, 50, 2044
YEARS_OF_TREE = OF_TREE // OF_YEAR
_TREE_YEAR = f"({FIRST_YEAR} + (id % {OF_TREE}) // {OF_YEAR})"
NEWEST = FIRST_YEAR + YEARS_OF_TREE - 1


def _tree(spark, sf, region):
    """A tree unfolds newest year first; each snapshot shows the years so far, and every twentieth
    law already under the newest year.  One tree in three has a folder that cannot be opened."""
    details = view(spark, sf, f"pages_{region}")
    x = details.select("page_id", _link(F.col("url")).alias("a"), F.floor(F.col("page_id") / OF_TREE).alias("tree"),
                       (F.floor(F.col("page_id") % OF_TREE / OF_YEAR) + FIRST_YEAR).cast("int").alias("own"))
    x = x.withColumn("own", F.when(F.col("page_id") % 20 == 0, F.lit(NEWEST)).otherwise(F.col("own")))
    shown = x.withColumn("year", F.explode(F.sequence(F.lit(FIRST_YEAR), F.col("own"))))  # also under all older years
    base = f"https://{region}.example/"
    snapshots = _joined(shown, ["tree", "year"], n=_tasks(spark, sf)).select("tree", "year", F.lit(base).alias("url"), _html('<a href="javascript:view()">x</a>', F.col("items")).alias("html"))
    snapshots = snapshots.filter(~((F.col("tree") % 3 == 2) & (F.col("year") == FIRST_YEAR + 1)))
    names = F.array_join(F.transform(F.sequence(F.lit(FIRST_YEAR), F.lit(NEWEST)), lambda y: _link(F.lit("#"), _text(y))), "")
    starts = x.select("tree").distinct().select("tree", F.lit(base).alias("url"), _html(names, '<a href="#">Indice 1</a>').alias("html"))
    return starts, snapshots, details


def _tree_oracle(region, key):
    after, until = FL.TREES[region][1:]
    year = f"CASE WHEN id % 20 = 0 THEN {NEWEST} ELSE {_TREE_YEAR} END"
    # a law shows first under its year; one beyond the limit, or in a folder that does not open, under the next older
    page = f"""CASE WHEN {year} > {until} THEN {until} ELSE {year} END"""
    page = f"CASE WHEN (id // {OF_TREE}) % 3 = 2 AND {page} = {FIRST_YEAR + 1} THEN {FIRST_YEAR} ELSE {page} END"
    return _oracle(region, page, f"page_no > {after}", key)


@query("flow_toscana", _tree_oracle("toscana", "legge:"), views=["law_headers"], ops="shape A: REG toscana HTM-2 SET-3 URL-2 URL-6 JON-3")
def flow_toscana(spark, sf):
    return FL.index_tree("toscana", *_tree(spark, sf, "toscana"))


@query("flow_liguria", _tree_oracle("liguria", "id="), views=["law_headers"], ops="shape A: REG liguria HTM-2 SET-3 URL-2 URL-6 JON-3")
def flow_liguria(spark, sf):
    """Years after 2050 are no years of this portal: what only they show comes from the next one."""
    return FL.index_tree("liguria", *_tree(spark, sf, "liguria"))


OF_LEAF, LEAF_FIRST, LEAF_YEARS = 40, 1966, 64  # laws of a year's page; some years lie before and after the portal's
_LEAF_YEAR = f"({LEAF_FIRST} + (id // {OF_LEAF}) % {LEAF_YEARS})"


@query("flow_lombardia", f"""
SELECT * EXCLUDE (id) FROM (
  SELECT *, cast(regexp_extract(source_url, 'iddoc=([0-9]+)', 1) as bigint) AS id FROM ({ORACLE_SELECTS['lombardia']}) x) y
WHERE {_LEAF_YEAR} BETWEEN 1970 AND 2025""", views=["law_headers"], ops="shape A: REG lombardia HTM-2 URL-2")
def flow_lombardia(spark, sf):
    """A tree page names its years in words; the first link of a year opens the page with its laws."""
    laws = view(spark, sf, "law_headers")
    a = F.concat(F.lit('<li><a href="/web/leggi?view=showdoc&amp;iddoc='), _text("law_id"), F.lit('">'), F.col("hdr"), F.lit("</a></li>"))
    x = laws.select(F.col("law_id").alias("page_id"), a.alias("a"), F.floor(F.col("law_id") / OF_LEAF).alias("leaf"))
    url = F.concat(F.lit("https://lombardia.example/leggi?anno="), _text("leaf"))
    listing = _joined(x, ["leaf"], n=_tasks(spark, sf)).select("leaf", url.alias("url"), F.col("leaf").alias("page_id"), _html(F.col("items")).alias("html"))
    year = _text(F.col("leaf") % LEAF_YEARS + LEAF_FIRST)
    folder = F.concat(_link(url, F.concat(F.lit("Anno "), year, F.lit(" (40)")), ' class="nodo treelink"'), _link(F.lit("/altro?anno=0"), F.concat(F.lit("ancora "), year), " class='treelinkselected'"),
                      _link(F.lit("/vecchio?anno=1"), year))
    names = x.select("leaf").distinct().select(F.floor(F.col("leaf") / LEAF_YEARS).alias("tree"), "leaf", folder.alias("a"))
    starts = _joined(names, ["tree"], "leaf").select(F.concat(F.lit("https://lombardia.example/albero?n="), _text("tree")).alias("url"), _html(F.col("items")).alias("html"))
    return FL.index_years(starts, listing.drop("leaf"))
