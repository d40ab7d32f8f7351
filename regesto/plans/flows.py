"""The lifecycle shapes of SURVEY §3 as single lazy plans.

Shape A (list, then detail, then index): pages -> drop what is done (anti join on the
law id, *before* the Python pass) -> region extractor -> flag files already stored ->
one row per file name -> index.  Shape B (key probe) is ``regions.extract_calabria``;
shape C (stream) is ``streaming.stream``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions import html as H
from regesto.functions import keys as K
from regesto.functions import urls as U
from regesto.functions._util import let
from regesto.operators import cutoffs as C
from regesto.operators import dedupe as S
from regesto.operators import joins as J
from regesto.operators import traversal as V
from regesto.plans.regions import EXTRACTORS
from regesto.session import ensure_checkpoint_dir


def index_pages(region: str, pages: DataFrame, done_ids: DataFrame | None = None, id_param: str = "id",
                inventory: DataFrame | None = None) -> DataFrame:
    """Shape A for one region.  ``done_ids`` has one column of law ids taken from the page URL's
    ``id_param``; ``inventory`` has a ``name`` column of stored files (their rows are kept and
    marked ``Skipped (Exists)``, the others ``Pending``)."""
    p = pages
    if done_ids is not None:
        p = p.withColumn("__id", U.query_param("url", id_param))
        done = done_ids.select(F.col(done_ids.columns[0]).cast("string").alias("__id"))
        p = J.todo(p, done, on="__id").drop("__id")
    idx = EXTRACTORS[region](p)
    if inventory is not None:
        idx = J.mark_existing(idx, inventory, "filename", "name", keep_row=True, flag="__exists")
        idx = idx.withColumn("status", K.derive_status(exists=F.col("__exists"))).drop("__exists")
    return S.dedupe_file(idx, "filename", "source_url")


@dataclass(frozen=True)
class Listing:
    """How a region's listing is walked: what its links hold, when it stops, how many pages count.

    ``stop``: "empty" (three empty pages in a row), "no_news" (a page without a new link), "pager" (a
    page that offers no later one)."""

    host: str
    link: str
    stop: str | None = None
    limit: int | None = None
    by_category: bool = False
    in_listing: bool = False  # the records stand in the listing itself


# Link patterns, stop rules and page limits of the regional listings.
LISTINGS = {
    "campania": Listing("campania.example", "dettaglio-documento", "empty", 149),
    "umbria": Listing("umbria.example", "mostra_atto.php"),
    "molise": Listing("molise.example", "OpenDocument"),
    "friuli": Listing("fvg.example", "IndiceLex", by_category=True),
    "veneto": Listing("veneto.example", "dettaglio-legge", "no_news"),
    "aosta": Listing("aosta.example", "dettaglio?pk_lr=", "no_news", in_listing=True),
    "lazio": Listing("lazio.example", "leggiregionalidettaglio", "no_news", 251),
    "puglia": Listing("puglia.example", "LeggeNavscroll.aspx", None, 107),
    "trentino": Listing("taa.example", "/content/view/full/", "pager"),
    "basilicata": Listing("basilicata.example", "", "pager", in_listing=True),
}
ELLIPSIS = "..."


@dataclass(frozen=True)
class Walk:
    """A listing that is walked along next links, one chain per start link of the start pages.

    ``start``: what the address of a start link holds (its text, a number, names the source);
    ``next_rx``: the text of a next link; ``link`` and ``cls``: the address and class of a law's link."""

    host: str
    start: str
    next_rx: str
    link: str
    cls: str | None = None
    limit: int | None = None
    stop: str | None = None
    in_listing: bool = False


# As above, for listings that are walked along next links.
WALKS = {
    "piemonte": Walk("piemonte.example", "elencoLeggi.do", "^»$", "dettaglioLegge.do", "dettaglio", 100, "no_news"),
    "emilia": Walk("emilia.example", "ricerca", r"Succ\.", "", in_listing=True),
}
MARCHE_CATEGORY, MARCHE_PAGE_RX, MARCHE_LAW = "classificazioni.php?arc=vig", r"classificazioni\.php\?.+page=\d+", "dettaglio.php?arc=vig"
#: Link pattern and years of the listings that unfold as a tree.
TREES = {"toscana": (r"articolo\?urndoc=", 0, 9999), "liguria": ("articolo|view|id=", 1950, 2050)}
LOMBARDIA_TREE_CLASSES, LOMBARDIA_YEAR_RX, LOMBARDIA_YEARS = ("treelink", "treelinkselected"), r"\b(19\d{2}|20\d{2})\b", (1970, 2025)


def _sourced(listing: DataFrame, region: str) -> DataFrame:
    return listing if "source" in listing.columns else listing.withColumn("source", F.lit(region))


def _limited(region: str, listing: DataFrame) -> DataFrame:
    """The pages of ``listing`` ([source,] page_no, url, html) within the region's page limit."""
    pages, limit = _sourced(listing, region), LISTINGS[region].limit
    return pages if limit is None else C.page_limit(pages, "page_no", limit)


def _offers_later() -> Column:
    """Whether an anchor (page_no, text) is the pager's link to a later page."""
    return (F.trim("text") == (F.col("page_no") + 1).cast("string")) | (F.trim("text") == ELLIPSIS)


def _up_to_last(rows: DataFrame, pages: DataFrame, later: DataFrame) -> DataFrame:
    """The ``rows`` of the pages up to the first that has no link in ``later``."""
    more = later.select("source", "page_no").distinct().withColumn("has_next", F.lit(True))
    offers = pages.select("source", "page_no").distinct().join(more, ["source", "page_no"], "left")
    kept = C.cut_after_last_page(offers, offers, "source", "page_no", "has_next").select("source", "page_no")
    return rows.join(kept, ["source", "page_no"], "left_semi")


def walked_pages(region: str, listing: DataFrame) -> DataFrame:
    """The pages of ``listing`` ([source,] page_no, url, html) within the region's page limit and up to
    the end of its pager."""
    pages = _limited(region, listing)
    if LISTINGS[region].stop == "pager":
        later = H.extract_anchors(pages, keep=("source", "page_no")).filter(_offers_later())
        pages = _up_to_last(pages, pages, later)
    return pages


def listing_links(region: str, listing: DataFrame) -> DataFrame:
    """The first link to each law in (source, page_no, pos) order, as far as the region's listing is walked.

    ``listing``: ([source,] page_no, url, html[, category])."""
    rule = LISTINGS[region]
    ensure_checkpoint_dir(listing.sparkSession)
    pages = _limited(region, listing)
    keep = ("source", "page_no", "url", *(("category",) if rule.by_category else ()))
    found, is_law = H.extract_anchors(pages, keep=keep), F.col("href").contains(rule.link)
    # each page is read once: the anchors travel, the pages do not
    if rule.stop == "pager":
        found = found.filter(is_law | _offers_later()).checkpoint()
        found = _up_to_last(found, pages, found.filter(_offers_later())).filter(is_law)
    else:
        found = found.filter(is_law).checkpoint()
    links = found.select(
        *[c for c in keep if c != "url"], "pos", U.url_join(F.col("url"), F.col("href")).alias("url"), F.col("text").alias("link_text")
    )
    if rule.stop == "empty":
        counts = links.groupBy("source", "page_no").agg(F.count(F.lit(1)).alias("n_links"))
        seen = pages.select("source", "page_no", F.col("html").isNull().alias("failed")).join(counts, ["source", "page_no"], "left")
        seen = seen.withColumn("n_links", F.coalesce("n_links", F.lit(0)))
        walked = C.cut_after_empty_pages(seen, "source", "page_no", "n_links", "failed", 3).select("source", "page_no")
        links = links.join(walked, ["source", "page_no"], "left_semi")
    elif rule.stop == "no_news":
        links = C.cut_when_no_news(links, "source", "page_no", "url", pages=pages)
    return S.distinct_ordered(links, "url", ["source", "page_no", "pos"])


def first_pages(region: str, listing: DataFrame) -> DataFrame:
    """(url, source, page_no): the page where each law is met first, as far as the region's listing is
    walked.  Of ``listing`` ([source,] page_no, url, html) only the addresses of the laws travel."""
    rule = LISTINGS[region]
    ensure_checkpoint_dir(listing.sparkSession)
    urls = let(U.base_parts(F.col("url")), lambda b: F.transform(H.hrefs_with("html", rule.link), lambda h: U.resolve(b, h)))
    pages = _limited(region, listing).select("source", "page_no", urls.alias("urls")).checkpoint()
    links = pages.select("source", "page_no", F.explode("urls").alias("url"))
    if rule.stop == "no_news":
        links = C.cut_when_no_news(links, "source", "page_no", "url", pages=pages)
    return S.distinct_ordered(links, "url", ["source", "page_no"]).checkpoint()


def open_details(region: str, links: DataFrame, details: DataFrame) -> DataFrame:
    """The records of the detail pages (url, html, ...) that ``links`` (url, page_no, link_text, ...) lead to,
    with the page that each was found on."""
    ensure_checkpoint_dir(links.sparkSession)
    links = links.checkpoint()  # read here and for the page numbers
    extra = [c for c in details.columns if c not in ("url", "page_id", *links.columns)]
    # pages are larger than Spark takes them for, so they are not broadcast
    opened = J.listing_with_detail(links.withColumns({f"list_{c}": F.lit(None) for c in extra}), details.hint("merge"), on="url", fields=extra)
    opened = opened.filter(F.col("html").isNotNull()).withColumn("page_id", F.xxhash64("url"))
    idx = EXTRACTORS[region](opened.drop("source", "category", *[f"list_{c}" for c in extra]))
    return _with_page(idx, links.select(F.col("url").alias("source_url"), "page_no"))


def _with_page(idx: DataFrame, places: DataFrame) -> DataFrame:
    """``idx`` with the page number of ``places`` (source_url, page_no), which has one row per address."""
    order = idx.columns
    found = idx.drop("page_no").join(places.select("source_url", F.col("page_no").cast("int").alias("page_no")), "source_url")
    return found.select(*order)


def index_listing(region: str, listing: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Shape A from its listing on: walk the listing, open each law's detail page (``details``: url,
    html, ...), extract, and note the page (and category) that the law was found on."""
    rule = LISTINGS[region]
    if rule.in_listing and not rule.link:  # every row of a listing page is a record
        pages = walked_pages(region, listing)
        return _with_page(EXTRACTORS[region](pages), pages.select(F.col("url").alias("source_url"), "page_no"))
    if rule.in_listing:  # records by links; details only tell repeals
        links = first_pages(region, listing)
        walked = _sourced(listing, region).join(links.select("source", "page_no").distinct(), ["source", "page_no"], "left_semi")
        idx = EXTRACTORS[region](walked.withColumn("page_id", F.col("page_no")), details)
        return _with_page(idx, links.select(F.col("url").alias("source_url"), "page_no"))
    links = listing_links(region, listing)
    idx = open_details(region, links, details)
    if rule.by_category:
        order = idx.columns
        cats = links.select(F.col("url").alias("source_url"), "category")
        idx = J.law_with_category(idx.drop("category"), cats, on="source_url").select(*order)
    return idx


# ------------------------------------------------------------------ listings along next links


def start_links(starts: DataFrame, holds: str) -> DataFrame:
    """(source, url): the numbered links of the start pages (url, html) whose address holds ``holds``."""
    found = V.page_anchors(starts).filter(F.col("to").contains(holds) & F.trim("text").rlike("^[0-9]+$"))
    return found.select(F.trim("text").alias("source"), F.col("to").alias("url")).distinct()


def walk_listing(region: str, starts: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, links) of a listing that is walked along next links.

    ``starts``: start pages (url, html); ``listing``: captured listing pages (url, html).  Pages are
    (source, page_no, url, stop); links are (source, page_no, pos, url, link_text), each law once."""
    rule = WALKS[region]
    is_next, is_law = F.trim("text").rlike(rule.next_rx), F.col("to").contains(rule.link)
    if rule.cls:
        is_law = is_law & F.array_contains(F.split("cls", r"\s+"), rule.cls)
    # the anchors travel, the pages do not
    anchors = V.page_anchors(listing).filter(is_next | is_law).checkpoint()
    pages = V.walk(start_links(starts, rule.start), V.next_pages(listing, anchors, is_next), rule.limit)
    links = anchors.filter(is_law).join(pages.select("source", "page_no", "url"), "url")
    links = links.select("source", "page_no", "pos", F.col("to").alias("url"), F.col("text").alias("link_text"))
    if rule.stop == "no_news":
        links = C.cut_when_no_news(links, "source", "page_no", "url", pages=pages)
    return pages, S.distinct_ordered(links, "url", ["source", "page_no", "pos"])


def index_walk(region: str, starts: DataFrame, listing: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Shape A along next links: walk every chain of the start pages, then open the details."""
    pages, links = walk_listing(region, starts, listing)
    if not WALKS[region].in_listing:
        return open_details(region, links, details)
    first = pages.groupBy("url").agg(F.min("page_no").alias("page_no"))
    # the law's page is the first that shows it
    marked = listing.join(first.select("url"), "url", "left_semi").withColumn("page_id", F.xxhash64("url"))
    # a page that shows a law again adds nothing
    idx = S.distinct_ordered(EXTRACTORS[region](marked), "source_url", ["law_title"])
    return _with_page(idx, links.select(F.col("url").alias("source_url"), "page_no"))


def index_categories(starts: DataFrame, listing: DataFrame, details: DataFrame) -> DataFrame:
    """Marche: category links of the start pages -> the pages that each category's first page lists ->
    law links -> details.  Several categories may list a law; it counts once."""
    anchors = V.page_anchors(listing).filter(F.col("to").rlike(MARCHE_PAGE_RX) | F.col("to").contains(MARCHE_LAW)).checkpoint()
    categories = V.page_anchors(starts).filter(F.col("to").contains(MARCHE_CATEGORY)).select(F.col("to").alias("source"), F.col("to").alias("url")).distinct()
    number = U.query_param("to", "page", "0").try_cast("int")
    pages = anchors.filter(F.col("to").rlike(MARCHE_PAGE_RX)).join(categories, "url").select("source", number.alias("page_no"), F.col("to").alias("url"))
    first = categories.select("source", F.lit(0).alias("page_no"), "url")
    pages = S.distinct_ordered(first.unionByName(pages), ["source", "url"], "page_no")
    links = anchors.filter(F.col("to").contains(MARCHE_LAW)).join(pages, "url")
    links = links.select("source", "page_no", "pos", F.col("to").alias("url"), F.col("text").alias("link_text"))
    return open_details("marche", S.distinct_ordered(links, "url", ["source", "page_no", "pos"]), details)


def index_tree(region: str, starts: DataFrame, snapshots: DataFrame, details: DataFrame) -> DataFrame:
    """A tree that unfolds year by year, newest first: ``starts`` (tree, url, html) name the years,
    ``snapshots`` (tree, year, url, html) are the page after each year was unfolded and hold the
    links of all years so far.  A law belongs to the first year that shows it (``page_no``)."""
    pattern, after, until = TREES[region]
    years = H.extract_anchors(starts, keep=("tree",)).filter(F.trim("text").rlike("^[0-9]{1,9}$")).select("tree", F.trim("text").try_cast("int").alias("year"))
    years = years.filter((F.col("year") > after) & (F.col("year") <= until)).distinct()
    shown = V.page_anchors(snapshots, keep=("tree", "year", "url")).filter(F.col("to").rlike(pattern) & ~U.is_script_link("to"))
    links = shown.join(years, ["tree", "year"], "left_semi").select("tree", "year", "pos", F.col("to").alias("url"), F.col("text").alias("link_text"))
    links = S.distinct_across(links, "url", "year", "pos").drop("tree").withColumnRenamed("year", "page_no")
    return open_details(region, links, details)


def index_years(starts: DataFrame, listing: DataFrame) -> DataFrame:
    """Lombardia: the tree links of the start pages (url, html) that name a year -> the listing page
    (url, html) behind the first link of each year -> records."""
    cls, (after, until) = LOMBARDIA_TREE_CLASSES, LOMBARDIA_YEARS
    tree = V.page_anchors(starts).filter(F.arrays_overlap(F.split("cls", r"\s+"), F.array(*[F.lit(c) for c in cls])))
    tree = tree.withColumn("year", F.regexp_extract("text", LOMBARDIA_YEAR_RX, 1)).filter(F.col("year") != "")
    tree = tree.filter(F.col("year").cast("int").between(after, until))
    opened = S.distinct_ordered(tree.select("url", "year", "pos", "to"), ["url", "year"], "pos").select(F.col("to").alias("url")).distinct()
    return EXTRACTORS["lombardia"](listing.join(opened, "url", "left_semi"))
