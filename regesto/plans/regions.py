"""Region jobs: ``extract_<region>(pages) -> law_index``.

Each job is one lazy plan of built-in functions: URL filters at the scan, then regex
forms over the html (flat selectors) or selectors over the page's element table
(``functions/elements.py``), then the region's display rules.  The output always has the canonical ``law_index``
schema, so REG-ALL is a ``unionByName`` and the index can be partitioned by
region when written.  Where a script had a bug, the corrected rule is built
(quirks Q1-Q9 in SURVEY); the region's display values are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import elements as E
from regesto.functions import html as H
from regesto.functions import keys as K
from regesto.functions import numbers as N
from regesto.functions import text as T
from regesto.functions import urls as U
from regesto.functions._util import let, nz, rx
from regesto.operators import cutoffs as C
from regesto.operators import dedupe as S
from regesto.operators import filters as P
from regesto.sources import sinks as W
from regesto.sources.readers import LAW_INDEX_SCHEMA, key_grid

LAW_INDEX = [(f.name, f.dataType.simpleString()) for f in LAW_INDEX_SCHEMA.fields]

# The patterns of the regional profiles (what each portal's pages say, as the
# region scripts read them; ``°`` is accepted after a day everywhere, quirk Q7).
SELECT_BUTTON_RX = rf"""(?i)<input(?=[\s/]){H.attr_is("src", r"[^\"'>]*Btn_Selezione[.]png")}"""
DATE_CELL_RX = r"(\d{2})/(\d{2})/(\d{4})"
ROW_RX = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
CELL_RX = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"
CAMPANIA_DATE_RX = r"(?iU)(\d{1,2}°?\s+[a-zàèìòù]+\s+\d{4})"
FVG_TITLE_RX = r"""PageBody_lbOggettolegge|[^"'>]*(?:lblOggetto|lblTitolo)[^"'>]*"""
FVG_CATEGORY_RX = r"""[^"'>]*Lista\.aspx\?materia=[^"'>]*"""
FVG_PDF_ID = "PageBody_aPdf"
FVG_DATE_RX = r"(\d{1,2})°?[\s.\-/]+([a-zA-Z]+)[\s.\-/]+(\d{4})"
LAZIO_NO_BODY_RX = r"(?i)Numero(?: della legge)?[:\s]*([0-9]+)"
LAZIO_DATE_BODY_RX = r"(?iU)Data[:\s]*([0-3]?\d\s+[A-Za-zàèéìòù]+\s+\d{4}|[0-3]?\d[/\-][0-1]?\d[/\-]\d{2,4})"
LOMBARDIA_RX = rf"(\d{{1,2}})°?\s+({D.IT_MONTH_ALT})\s+(\d{{4}}).*?n\.?\s*(\d+)"
MARCHE_TITLE_RX = r"(?s)<td>\s*([^<]*?)\s*</td>\s*</tr>"
MARCHE_NO_RX = N.ONE_SPACE_NO_RX
MARCHE_DATE_RX = rf"(?i)(\d{{1,2}}°?\s+(?:{D.IT_MONTH_ALT})\s+\d{{4}})"
PIEMONTE_DATE_RX = r"(?i)del\s+(\d{1,2})°?\s+([a-zA-Z]+)\s+(\d{4})"
SARD_HDR1 = r"(?i)Legge regionale\s+(.*?),\s*n\.\s*(\d+)"
SARD_HDR2 = r"(?i)Legge regionale\s+n\.\s*(\d+)\s+del\s+(.*)"
UMBRIA_DATE_RX = rf"(?iU)(\d{{1,2}}°?\s+(?:{D.IT_MONTH_ALT})\s+\d{{4}})"
VENETO_RX = r"(?i)Legge\s+regionale\s+(.*?)(?:,|\s+)\s+n\.\s+(\d+)"
AOSTA_LINK = "dettaglio?pk_lr="
AOSTA_TITLE_CLASS = "elemento_lista_paginata_banche_dati"
AOSTA_DATE_RX = rf"(?iU)(\d{{1,2}})°?\s+({D.IT_MONTH_ALT})\s+(\d{{4}})"
EMILIA_RX = r"(?i)Legge regionale\s+(.*?),\s+n\.(\d+)"

# The record shape each region's table has (column names in order).
_BASE = {"Region": "region", "Law Title": "law_title", "Law Number": "law_number", "Date": "date_text", "Filename": "filename"}
DISPLAY_COLUMNS = {
    "basilicata": _BASE,
    "calabria": _BASE,
    "campania": _BASE,
    "friuli": {"Category": "category", **_BASE, "Status": "status"},
    "lazio": {"Law Title": "law_title", "Law Number": "law_number", "Date": "date_text", "Filename": "filename", "URL": "source_url"},
    "liguria": {**_BASE, "Source URL": "source_url"},
    "lombardia": {**_BASE, "Source URL": "source_url"},
    "marche": {"region": "region", "title": "law_title", "law_number": "law_number", "date": "date_text", "file": "filename", "url": "source_url", "path": "path"},
    "molise": {"Region": "region", "Law Title": "law_title", "Law Number": "law_number", "Date": "date_text", "Date_ISO": "law_date", "Filename": "filename"},
    "piemonte": _BASE,
    "puglia": {**_BASE, "URL": "source_url"},
    "sardinia": _BASE,
    "trentino": {"Page": "page_no", "Region": "region", "Law Title": "law_title", "Law Number": "law_number", "Date": "date_text", "Type": "doc_type", "Filename": "filename", "Status": "status", "URL": "source_url"},
    "toscana": {**_BASE, "Source URL": "source_url"},
    "umbria": {**_BASE, "URL": "source_url"},
    "veneto": {"Region": "region", "Law Number": "law_number", "Date": "date_text", "Law Title": "law_title", "Filename": "filename"},
    "aosta": {**_BASE, "Status": "status", "URL": "source_url"},
    "emilia": {**_BASE, "Status": "status"},
}
#: Regions whose table keeps only the columns that the records have.
ONLY_PRESENT = ("veneto", "piemonte")


def to_law_index(df: DataFrame, **cols: Column) -> DataFrame:
    """Project to the canonical schema; ``law_number_int`` defaults to the typed ``law_number``."""
    if "law_number_int" not in cols and "law_number" in cols:
        cols["law_number_int"] = T.to_int_or_null(cols["law_number"])
    out = []
    for name, typ in LAW_INDEX:
        c = cols.get(name)
        out.append((c if c is not None else F.lit(None)).cast(typ).alias(name))
    return df.select(*out)


def conform(df: DataFrame, region: str, fill_missing: bool | None = None) -> DataFrame:
    """SNK-2: the region's record shape; missing columns as '', or left out where the region's table
    keeps only what is present.  An unknown region is an error."""
    if region not in DISPLAY_COLUMNS:
        raise ValueError(f"no record shape for region {region!r}")
    shape = DISPLAY_COLUMNS[region]
    fill = region not in ONLY_PRESENT if fill_missing is None else fill_missing
    named = df.select(*[F.col(canon).cast("string").alias(disp) for disp, canon in shape.items() if canon in df.columns])
    return W.conform(named, list(shape), fill)


def _page(pages: DataFrame, url_filter: str | None = None, keep=("url",)) -> DataFrame:
    """The element table of each page as column ``page``; the URL filter reaches the scan."""
    if url_filter:
        pages = pages.filter(F.col("url").rlike(url_filter))
    return pages.select(*keep, E.once(E.scan("html")).alias("page"))


def _text_of(page, *tags: str, where=None) -> Column:
    """Text of the first such element."""
    return let(E.first(E.elements(page, *tags, where=where)), lambda e: E.text(page, e))


def _flat(pages: DataFrame, url_filter: str | None = None, contains: bool = False) -> DataFrame:
    """Pages for the regex-form extractors (no Python pass); the URL filter reaches the scan."""
    if url_filter:
        pages = pages.filter(F.col("url").contains(url_filter) if contains else F.col("url").rlike(url_filter))
    return pages


def _given(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column that a listing may have added to the pages, else NULL."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def _span(id_: str, prefix: bool = False, shown: Column | None = None) -> Column:
    """Text of the first ``<span>`` with this id (or id prefix), regex form; ``shown`` is the visible html."""
    rx_ = H.attr_is("id", id_ + ("[^\"'>]*" if prefix else ""))
    return H.element_text("html", "span", rx_) if shown is None else H.shown_text(shown, "span", rx_)


def _iso_or(d: Column, default: str) -> Column:
    return F.coalesce(D.date_display(d, "iso"), F.lit(default))


# ---------------------------------------------------------------------------------- REG-01


def extract_basilicata(pages: DataFrame) -> DataFrame:
    """Rows of the ``GVElenco`` grid with a select button: longest plain cell = title, last number cell, last date cell.
    The grid is flat markup, so rows and cells are regex forms (no Python pass)."""
    p = _flat(pages)
    grid = H.element_html("html", "table", H.attr_is("id", "[^\"'>]*GVElenco[^\"'>]*"))
    rows = F.filter(F.regexp_extract_all(grid, F.lit(ROW_RX), F.lit(1)), lambda r: r.rlike(SELECT_BUTTON_RX))
    x = p.select("url", F.explode(rows).alias("row"))
    texts = F.transform(F.regexp_extract_all("row", F.lit(CELL_RX), F.lit(1)), H.inner_text)
    # the cells once, in a projection of their own: three expressions read them
    x = x.select("url", F.filter(F.transform(texts, lambda t, i: F.struct(t.alias("text"), (i + 1).alias("col"))), lambda c: c["text"] != "").alias("cells"))
    cells = F.col("cells")

    def is_date(c):
        return c["text"].rlike(r"\d{2}/\d{2}/\d{4}")

    def is_num(c):
        return N.cell_number(c["text"]).isNotNull()

    date_txt = F.try_element_at(F.filter(cells, is_date), F.lit(-1))["text"]
    num_txt = F.try_element_at(F.filter(cells, lambda c: ~is_date(c) & is_num(c)), F.lit(-1))["text"]
    cands = F.filter(cells, lambda c: ~is_date(c) & ~is_num(c))
    title = F.array_max(F.transform(cands, lambda c: F.struct(F.length(c["text"]).alias("l"), (-c["col"]).alias("o"), c["text"].alias("t"))))["t"]
    x = x.select(
        "url",
        F.coalesce(title, F.lit("Unknown")).alias("title"),
        F.coalesce(N.cell_number(num_txt), F.lit("0")).alias("no"),
        rx(date_txt, DATE_CELL_RX, 0).alias("dmy"),
        D.slash_date(date_txt, strict=True).alias("d"),
    )
    return to_law_index(
        x, region=F.lit("Basilicata"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.coalesce(F.col("dmy"), F.lit("Unknown")), law_date=F.col("d"), source_url=F.col("url"),
        filename=K.law_filename("Basilicata", F.col("no"), _iso_or(F.col("d"), "0000-00-00")),
    )


# ---------------------------------------------------------------------------------- REG-02
date_from_sources = H.date_from_sources


def extract_calabria(captures: DataFrame, k: int = 10) -> DataFrame:
    """Key probe: grid of the captured years -> captures -> valid PDF -> stop after k misses per
    year -> records.  Captures are (y, n, status, headers, body, first_page_text); the file name
    stands in the ``Content-Disposition`` header.

    Bodies are read by the scan alone, and texts meet only the keys that the cut leaves."""
    spark = captures.sparkSession
    header = F.try_element_at("headers", F.lit("Content-Disposition"))
    facts = captures.select("y", "n", P.is_valid_capture("status", "body").alias("found"), header.alias("content_disposition"), "first_page_text")
    grid = key_grid(spark, None, None, captures.groupBy("y").agg(F.max("n").alias("n_max")), k).select("y", "n")
    # a few rows of years explode into all keys: Spark would size the grid by the years and broadcast it
    probes = grid.hint("merge").join(facts.select("y", "n", "found"), ["y", "n"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    hits = C.cut_after_misses(probes, "y", "n", "found", k).filter("found").select("y", "n")
    kept = facts.drop("found").join(hits, ["y", "n"])
    dtext = date_from_sources(F.col("content_disposition"), F.col("first_page_text"))
    parsed = D.it_date(dtext)
    x = kept.select(
        "y", "n",
        F.when(parsed.isNotNull(), dtext).otherwise(F.col("y").cast("string")).alias("date_text"),
        D.date_or_year(parsed, year=F.col("y")).alias("d"),
        F.coalesce(F.nullif(T.first_title_line("first_page_text"), F.lit("")),
                   F.concat(F.lit("Legge Regionale n. "), F.col("n").cast("string"))).alias("title"),
    )
    return to_law_index(
        x, region=F.lit("Calabria"), law_title=F.col("title"), law_number=F.col("n").cast("string"),
        law_number_int=F.col("n"), date_text=F.col("date_text"), law_date=F.col("d"),
        filename=K.law_filename("Calabria", F.col("n"), D.date_display("d", "iso")),
    )


# ---------------------------------------------------------------------------------- REG-03


def extract_campania(pages: DataFrame) -> DataFrame:
    """h1, number, textual date and a document link are all required; one row per law id."""
    p = _flat(pages, "dettaglio-documento", contains=True)
    law_id = rx("url", r"id=(\d+)")
    p = p.filter(law_id.isNotNull())  # a page without an id is no law
    # from a generator: the filters are not pushed below, where few tasks would make and read the pages once more
    read = let(H.page_text("html"), lambda text: F.struct(
        H.element_text("html", "h1").alias("title"),
        N.law_no(text).alias("no"),
        rx(text, CAMPANIA_DATE_RX).alias("date_text"),
        F.exists(H.attr_values("html", "a", "href"), lambda h: h.contains("prendiDocumento")).alias("has_pdf"),
    ))
    x = p.select("url", "page_id", law_id.alias("law_id"), E.once(read).alias("x")).select("url", "page_id", "law_id", "x.*")
    x = P.require_fields(x.filter("has_pdf"), ["title", "no", "date_text"])
    x = S.distinct_ordered(x, "law_id", ["page_id", "url"])
    return to_law_index(
        x, region=F.lit("Campania"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.col("date_text"), law_date=D.it_date("date_text"), source_url=F.col("url"),
        filename=T.safe_name_underscore(F.concat(F.lit("Campania_"), F.col("no"), F.lit("_"), F.col("date_text"), F.lit(".pdf"))),
    )


# ---------------------------------------------------------------------------------- REG-04


def fvg_date_display(raw: Column) -> Column:
    """``25 marzo 1968`` -> ``25/03/1968``; anything else passes through cleaned; empty -> UnknownDate."""
    clean = T.norm_ws(raw)
    m = D.month_number(rx(clean, FVG_DATE_RX, 2))
    formatted = F.when(m.isNotNull(), F.concat_ws("/", T.zfill2(rx(clean, FVG_DATE_RX, 1)), F.lpad(m.cast("string"), 2, "0"), rx(clean, FVG_DATE_RX, 3)))
    return F.when(clean == "", F.lit("UnknownDate")).otherwise(F.coalesce(formatted, clean))


def extract_friuli(pages: DataFrame) -> DataFrame:
    """Category pages with IndiceLex rows; Success rows only."""
    p = _flat(pages, "IndiceLex", contains=True)
    # the button is known by its id or by what it says, whatever its link ends with
    anchors = F.regexp_extract_all("html", F.lit(H.ANCHOR_RX), F.lit(0))
    by_id = F.col("html").rlike(rf"(?i)<a(?=[\s/]){H.attr_is('id', FVG_PDF_ID)}")
    has_pdf = by_id | F.exists(anchors, lambda a: F.contains(H.inner_text(a), F.lit("PDF")))

    def read(shown):
        title = F.coalesce(H.shown_text(shown, "span", H.attr_is("id", FVG_TITLE_RX)), F.lit("Title Not Found"))
        category = H.shown_text(shown, "a", H.attr_is("href", FVG_CATEGORY_RX))
        return let(title, lambda t: F.struct(
            t.alias("title"),
            F.coalesce(_span("PageBody_lbNumLegge", shown=shown), N.law_no(t), F.lit("0")).alias("no"),
            F.coalesce(_span("lblData", prefix=True, shown=shown), F.lit("")).alias("raw_date"),
            F.coalesce(_given(p, "category"), category).alias("category"),
        ))

    # from generators: the filter is not pushed below, where few tasks would make and read the pages once more
    status = F.when(has_pdf, F.lit("Success")).otherwise(F.lit("Failed"))
    x = P.successful_only(p.select("*", E.once(status).alias("__status")), "__status", "Success")
    x = x.select("url", F.col("__status").alias("status"), E.once(let(H.visible("html"), read)).alias("x")).select("url", "status", "x.*")
    x = x.withColumn("shown", fvg_date_display(F.col("raw_date")))
    return to_law_index(
        x, region=F.lit("Friuli Venezia Giulia"), law_title=F.col("title"), law_number=F.col("no"), date_text=F.col("shown"),
        law_date=D.any_date(F.regexp_replace("raw_date", "°", "")), status=F.col("status"), category=F.col("category"),
        source_url=F.col("url"),
        filename=K.law_filename("FVG", F.col("no"), D.dash_date(F.col("shown"), "/")),
    )


# ---------------------------------------------------------------------------------- REG-05


def extract_lazio(pages: DataFrame) -> DataFrame:
    """First heading; bold labels Numero / Data (not BUR), body regexes as fallback; ID_ key."""
    p = _page(pages, "leggiregionalidettaglio")
    heads = [E.first(F.filter(F.transform(E.elements("page", t), lambda e: E.text("page", e)), lambda x: x != "")) for t in ("h1", "h2", "h3", "h4")]
    body = E.page_text("page")
    no = F.coalesce(E.label_value("page", "numero", digits=True), rx(body, LAZIO_NO_BODY_RX))
    date = F.coalesce(E.label_value("page", "data", exclude=("bur",)), rx(body, LAZIO_DATE_BODY_RX))
    x = p.select("url", F.coalesce(*heads, F.lit("N/A")).alias("title"), no.alias("no"), date.alias("date"))
    key = K.fallback_key(F.col("no"), F.col("url"), "id")
    return to_law_index(
        x, region=F.lit("Lazio"), law_title=F.col("title"), law_number=F.coalesce("no", F.lit("N/A")),
        date_text=F.coalesce("date", F.lit("N/A")), law_date=D.any_date(F.col("date")), source_url=F.col("url"),
        filename=F.concat(F.lit("Lazio_"), T.safe_name_spaces(key), F.lit("_"),
                          F.when(F.col("date").isNull(), F.lit("unknown_date")).otherwise(T.safe_name_spaces(F.col("date"))), F.lit(".pdf")),
    )


# ---------------------------------------------------------------------------------- REG-06 / REG-14
def _header_law(x: DataFrame, text: Column, region: str, prefix: str, title: Column, title_default: str) -> DataFrame:
    h = N.header_fields(F.replace(F.lower(text), F.lit("\n"), F.lit(" ")))
    y = x.select("url", F.coalesce(nz(title), F.lit(title_default)).alias("title"), h.alias("h"))
    return to_law_index(
        y, region=F.lit(region), law_title=F.col("title"), law_number=F.coalesce("h.law_no", F.lit("Unknown")),
        date_text=F.coalesce(D.date_display("h.law_date", "d_english"), F.lit("")), law_date=F.col("h.law_date"),
        source_url=F.col("url"), filename=K.law_filename(prefix, F.coalesce("h.law_no", F.lit("Unknown")), _iso_or(F.col("h.law_date"), "0000-00-00")),
    )


def extract_liguria(pages: DataFrame) -> DataFrame:
    """h1 title; HDR-1 then HDR-2 on the page text; display ``d Month yyyy`` (English month, Q4).
    Flat selectors only, so regex forms on the html column (no Python pass)."""
    p = _flat(pages, "articolo|view|id=")
    return _header_law(p, H.page_text("html"), "Liguria", "Liguria", H.element_text("html", "h1"), "Unknown Title")


def extract_toscana(pages: DataFrame) -> DataFrame:
    """As Liguria with the ``#titolo_doc`` title; Region Toscana, file prefix Tuscany."""
    p = _flat(pages, "articolo\\?urndoc=")
    title = H.element_text("html", "div", H.attr_is("id", "titolo_doc"))
    return _header_law(p, H.page_text("html"), "Toscana", "Tuscany", title, "Unknown Title")


# ---------------------------------------------------------------------------------- REG-07


def extract_lombardia(pages: DataFrame, base: str = "https://www.lombardia.example/") -> DataFrame:
    """Year listing links (``view=showdoc``); date and number from the link text."""
    links = H.extract_anchors(_flat(pages, "anno=", contains=True), keep=("page_id", "url"))
    links = links.filter(F.col("href").contains("view=showdoc"))
    t = F.lower(F.trim("text"))
    d = D.make_date(rx(t, LOMBARDIA_RX, 3), D.month_number(rx(t, LOMBARDIA_RX, 2)), rx(t, LOMBARDIA_RX, 1))
    x = links.select(F.col("text").alias("title"), U.url_join(F.col("url"), F.col("href")).alias("src"),
                     rx(t, LOMBARDIA_RX, 4).alias("no"), d.alias("d"))
    return to_law_index(
        x, region=F.lit("Lombardia"), law_title=F.col("title"), law_number=F.coalesce("no", F.lit("Unknown")),
        date_text=F.coalesce(D.date_display("d", "d_month"), F.lit("")), law_date=F.col("d"), source_url=F.col("src"),
        filename=K.law_filename("Lombardia", F.coalesce("no", F.lit("Unknown")), _iso_or(F.col("d"), "0000-00-00")),
    )


# ---------------------------------------------------------------------------------- REG-08


def extract_marche(pages: DataFrame) -> DataFrame:
    """Regexes on the raw html (no dom); one row per source URL (Q9: never collapse NA_NA names)."""
    p = _flat(pages, "dettaglio.php?arc=vig", contains=True)
    h1 = H.strip_tags(H.element_html("html", "h1"))
    x = p.select(
        "url",
        "page_id",
        F.coalesce(F.trim(H.unescape(rx("html", MARCHE_TITLE_RX))), H.unescape(h1), F.lit("NA")).alias("title"),
        F.coalesce(rx("html", MARCHE_NO_RX), F.lit("NA")).alias("no"),
        F.coalesce(rx("html", MARCHE_DATE_RX), F.lit("NA")).alias("date_text"),
    )
    x = S.distinct_ordered(x, "url", ["page_id"])
    return to_law_index(
        x, region=F.lit("Marche"), law_title=F.col("title"), law_number=F.col("no"), date_text=F.col("date_text"),
        law_date=D.it_date("date_text"), source_url=F.col("url"),
        filename=K.law_filename("Marche", F.col("no"), D.dash_date(F.col("date_text"), " ")),
    )


# ---------------------------------------------------------------------------------- REG-09
def _molise_date(text: Column) -> Column:
    """struct(d, shown): the text is searched once."""
    def dated(d):
        shown = F.concat_ws(" ", F.day(d).cast("string"), F.initcap(D.it_month_name(d)), F.year(d).cast("string"))
        return F.struct(d.alias("d"), F.when(d.isNotNull(), shown).alias("shown"))

    return let(D.any_date(F.lower(text)), dated)


def extract_molise(pages: DataFrame) -> DataFrame:
    """Title: longest of cells > 40, li with 'legge regionale', p > 40, headings; number: NUM-2 on the body."""
    p = _flat(pages, "OpenDocument", contains=True)

    def texts(rx_, group=1):
        return F.transform(F.regexp_extract_all("html", F.lit(rx_), F.lit(group)), H.inner_text)

    cells = F.filter(texts(r"(?is)<td\b[^>]*>(.*?)</td\s*>"), lambda t: F.length(t) > 40)
    lis = F.filter(texts(r"(?is)<li\b[^>]*>(.*?)</li\s*>"), lambda t: F.lower(t).contains("legge regionale"))
    ps = F.filter(texts(r"(?is)<p\b[^>]*>(.*?)</p\s*>"), lambda t: F.length(t) > 40)
    hs = texts(r"(?is)<(h[1-4])\b[^>]*>(.*?)</\1\s*>", 2)
    cands = F.concat(cells, lis, ps, hs)
    # strictly longer replaces: the longest, earliest in that source order
    best = F.array_max(F.transform(cands, lambda t, i: F.struct(F.length(t).alias("l"), (-i).alias("o"), t.alias("t"))))["t"]
    # bound once: the longest text is looked for once per page
    title = let(F.coalesce(nz(best), H.element_text("html", "title")), lambda t: F.when(t != "NA", t))
    x = p.select("url", F.coalesce(title, _given(p, "link_text")).alias("title"), H.page_text("html").alias("body"))
    x = x.select("url", "title", N.law_no_text_chain(F.lower("body")).alias("no"), E.once(_molise_date(F.col("body"))).alias("x")).select("url", "title", "no", "x.*")
    return to_law_index(
        x, region=F.lit("Molise"), law_title=F.col("title"), law_number=F.coalesce("no", F.lit("NA")),
        date_text=F.coalesce("shown", F.lit("NA")), law_date=F.col("d"), source_url=F.col("url"),
        filename=T.safe_name_underscore(K.law_filename("Molise", F.coalesce("no", F.lit("NA")), _iso_or(F.col("d"), "NA"))),
    )


# ---------------------------------------------------------------------------------- REG-10
def extract_piemonte(pages: DataFrame, payload: str | None = None, min_bytes: int = 2000) -> DataFrame:
    """``#titoloAtto`` minus ``.bur``; lead span loose ``n.``; ``del <data>``; strict repeal rule; the
    saved file (column ``payload``, where the pages have one) is over 2 KB."""
    p = pages.filter(F.col("url").contains("dettaglioLegge.do"))
    if payload is not None:
        p = P.min_size(p, payload, min_bytes)
    p = _page(p)
    p = P.drop_repealed_strict(p.select("*", E.once(E.page_text("page")).alias("__t")), "__t")
    lead = F.coalesce(_text_of("page", where=lambda e: E.has_class("page", e, "lead")), F.col("__t"))
    title = E.text_without("page", E.first(E.elements("page", where=lambda e: E.has_attr("page", e, "id", "titoloAtto"))), "bur")
    p = p.select("url", nz(title).alias("title"), lead.alias("lead"))
    day, mon, yr = rx("lead", PIEMONTE_DATE_RX, 1), rx("lead", PIEMONTE_DATE_RX, 2), rx("lead", PIEMONTE_DATE_RX, 3)
    x = p.select(
        "url", F.coalesce("title", F.lit("Title Not Found")).alias("title"),
        F.coalesce(N.law_no("lead", loose=True), F.lit("Unknown")).alias("no"),
        F.when(day.isNotNull(), F.concat_ws(" ", day, mon, yr)).alias("shown"), D.make_date(yr, D.month_number(mon), day).alias("d"),
    )
    return to_law_index(
        x, region=F.lit("Piemonte"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.coalesce("shown", F.lit("00/00/0000")), law_date=F.col("d"), source_url=F.col("url"),
        filename=K.law_filename("Piemonte", T.safe_name_50(F.col("no")), _iso_or(F.col("d"), "0000-00-00")),
    )


# ---------------------------------------------------------------------------------- REG-11
def extract_puglia(pages: DataFrame) -> DataFrame:
    """Fields by element id; title = first centred paragraph over 15 characters."""
    p = _flat(pages, "LeggeNavscroll.aspx", contains=True)
    centred = F.transform(F.regexp_extract_all("html", F.lit(rf"(?is)<p(?=[\s/]){H.attr_is('align', 'center')}{H.START_TAG_END}(.*?)</p\s*>"), F.lit(1)), H.inner_text)
    title = F.try_element_at(F.filter(centred, lambda t: F.length(t) > 15), F.lit(1))

    def read(shown):
        return F.struct(
            F.coalesce(_span("ContentPlaceHolder1_lblNumero", shown=shown), F.lit("Unknown")).alias("no"),
            F.coalesce(_span("ContentPlaceHolder1_lblData", shown=shown), F.lit("01/01/1900")).alias("raw"))

    x = p.select("url", F.coalesce(title, F.lit("Title Not Found")).alias("title"), E.once(let(H.visible("html"), read)).alias("x")).select("url", "title", "x.*")
    d = F.when(F.col("raw").rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), D.slash_date("raw"))
    d = F.when(d != F.lit("1900-01-01").cast("date"), d)
    return to_law_index(
        x, region=F.lit("Puglia"), law_title=F.col("title"), law_number=F.col("no"), date_text=F.col("raw"),
        law_date=d, source_url=F.col("url"),
        filename=K.law_filename("Puglia", T.safe_name_50(F.col("no")), _iso_or(d, "0000-00-00")),
    )


# ---------------------------------------------------------------------------------- REG-12


def extract_sardinia(pages: DataFrame) -> DataFrame:
    """Every ``.pdf`` link; HDR-1 then HDR-2 on the link text, else the row is dropped."""
    pdf = E.elements("page", "a", where=lambda a: F.lower(F.coalesce(E.attr("page", a, "href"), F.lit(""))).endswith(".pdf"))

    def link(x):
        a, p = x["e"], x["box"]
        # only a paragraph's own text belongs to its links
        inside = F.when(p["depth"] == a["depth"] - 1, E.text("page", p))
        return F.struct(E.attr("page", a, "href").alias("href"), E.text("page", a).alias("text"), inside.alias("paragraph"))

    linked = E.with_container(pdf, E.elements("page", "p"))
    links = _page(pages).select("url", F.explode(F.transform(linked, link)).alias("l"))
    t = F.trim(F.col("l.text"))
    m1 = t.rlike(SARD_HDR1)
    no = F.when(m1, rx(t, SARD_HDR1, 2)).otherwise(rx(t, SARD_HDR2, 1))
    dtext = F.trim(F.when(m1, rx(t, SARD_HDR1, 1)).otherwise(rx(t, SARD_HDR2, 2)))
    x = links.select(F.coalesce("l.paragraph", t).alias("title"), no.alias("no"), dtext.alias("dtext"), U.url_join(F.col("url"), F.col("l.href")).alias("src"))
    x = x.filter(F.col("no").isNotNull())
    d = D.any_date("dtext")
    return to_law_index(
        x, region=F.lit("Sardinia"), law_title=F.col("title"), law_number=F.col("no"), date_text=F.col("dtext"),
        law_date=d, source_url=F.col("src"),
        filename=T.safe_name_delete(K.law_filename("Sardinia", F.col("no"), _iso_or(d, "Unknown_Date"))),
    )


# ---------------------------------------------------------------------------------- REG-13
def extract_trentino(pages: DataFrame) -> DataFrame:
    """Title after h1; dates from candidates (numeric, IT/EN textual), else the title's year; 1:N documents."""
    pages = pages.withColumn("page_no", _given(pages, "page_no", "int"))
    p = _page(pages, "/content/view/full/", keep=("url", "page_no"))
    h1 = E.first(E.elements("page", "h1"))
    font = _text_of("page", "font", where=lambda e: E.has_attr("page", e, "dir", "auto"))
    strongs = F.transform(E.elements("page", "strong", where=lambda e: E.has_class("page", e, "text-nowrap")), lambda e: E.text("page", e))
    boxes = E.elements("page", "div", where=lambda e: E.holds("page", e, "class", "col-md-3"))
    divs = F.filter(F.transform(boxes, lambda e: E.text("page", e)), lambda t: t.contains("Data"))
    docs = F.transform(E.documents("page", "card-teaser", "download-list"), lambda a: E.attr("page", a, "href"))
    # from generators: pages without a document go, which would otherwise find the documents anew for each use
    p = p.select("*", E.once(docs).alias("docs")).filter(F.size("docs") > 0)
    read = let(h1, lambda h: F.struct(nz(E.text("page", h)).alias("h1"), E.next_text("page", h).alias("after"), nz(font).alias("font"),
                                      F.concat(strongs, F.slice(divs, 1, 1)).alias("dates")))
    p = p.select("url", "page_no", "docs", E.once(read).alias("x")).select("url", "page_no", "docs", "x.*")
    title = F.when(F.length(F.coalesce("after", F.lit(""))) > 5, F.col("after")).otherwise(F.coalesce("h1", "font", F.lit("Unknown")))
    p = p.withColumn("title", title)
    d = D.date_or_year(D.first_date(F.col("dates"), D.bilingual_date), title=F.col("title"))
    docs = p.select("url", "page_no", "title", F.coalesce(N.law_no("h1", loose=True), F.lit("0")).alias("no"), d.alias("d"), F.explode("docs").alias("href"))
    x = docs.withColumn("kind", K.doc_language("href"))
    return to_law_index(
        x, region=F.lit("Trentino-Alto Adige"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.coalesce(D.date_display("d", "dmy"), F.lit("Unknown")), law_date=F.col("d"),
        doc_type=F.col("kind"), source_url=F.col("url"), page_no=F.col("page_no"), status=F.lit("Pending"),
        filename=F.concat(F.lit("TrentinoAA_"), F.col("no"), F.lit("_"), _iso_or(F.col("d"), "0000-00-00"), F.lit("_"), F.col("kind"), F.lit(".pdf")),
    )


# ---------------------------------------------------------------------------------- REG-15


def extract_umbria(pages: DataFrame) -> DataFrame:
    """First long td not starting with a digit, else heading; strict ``n.``, else ``-(N).`` of the
    listing's link text (column ``link_text``, where the pages have one)."""
    p = _flat(pages, "mostra_atto.php", contains=True)
    tds = F.transform(F.regexp_extract_all("html", F.lit(r"(?is)<td\b[^>]*>(.*?)</td\s*>"), F.lit(1)), H.inner_text)
    td = F.try_element_at(F.filter(tds, lambda t: (F.length(t) > 20) & ~t.rlike(r"^\d")), F.lit(1))
    head = F.try_element_at(F.transform(F.regexp_extract_all("html", F.lit(r"(?is)<(h[123])\b[^>]*>(.*?)</\1\s*>"), F.lit(2)), H.inner_text), F.lit(1))
    title = F.coalesce(td, head, F.lit("No Title Found"))
    x = p.select("url", _given(p, "link_text").alias("link_text"), title.alias("title"), H.page_text("html").alias("body")).select(
        "url", "title", F.coalesce(N.law_no("body"), rx("link_text", N.LINK_NO_RX), F.lit("Unknown")).alias("no"),
        rx("body", UMBRIA_DATE_RX).alias("dtext"))
    d = D.it_date("dtext")
    return to_law_index(
        x, region=F.lit("Umbria"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.coalesce("dtext", F.lit("Unknown Date")), law_date=d, source_url=F.col("url"),
        filename=K.law_filename("Umbria", F.col("no"), _iso_or(d, "0000-00-00")),
    )


# ---------------------------------------------------------------------------------- REG-16


def extract_veneto(pages: DataFrame) -> DataFrame:
    """``p.font-18`` title; number and date from the h2 pattern; no PDF button -> 'No PDF'."""
    p = _flat(pages, "dettaglio-legge", contains=True)
    anchor_texts = F.transform(F.regexp_extract_all("html", F.lit(H.ANCHOR_RX), F.lit(2)), H.inner_text)
    has_pdf = F.exists(anchor_texts, lambda t: F.lower(t).contains("pdf testo"))

    def read(shown):
        title = H.shown_text(shown, "p", H.has_class("font-18"))
        return let(rx(H.shown_text(shown, "h2", H.has_class("title")), VENETO_RX, 0), lambda h2: F.struct(
            F.coalesce(title, F.lit("No Title")).alias("title"),
            F.coalesce(F.trim(rx(h2, VENETO_RX, 2)), F.lit("Unknown")).alias("no"),
            F.coalesce(F.trim(rx(h2, VENETO_RX, 1)), F.lit("Unknown")).alias("dtext")))

    x = p.select("url", E.once(let(H.visible("html"), read)).alias("x"), has_pdf.alias("has_pdf"),
                   F.coalesce(_given(p, "download_failed", "boolean"), F.lit(False)).alias("failed")).select("url", "x.*", "has_pdf", "failed")
    d = D.it_date("dtext")
    name = K.law_filename("Veneto", F.col("no"), F.coalesce(D.date_display(d, "iso"), F.replace(T.safe_name_delete(F.col("dtext"), trim=True), F.lit(" "), F.lit("-"))))
    return to_law_index(
        x, region=F.lit("Veneto"), law_title=F.col("title"), law_number=F.col("no"), date_text=F.col("dtext"),
        law_date=d, source_url=F.col("url"),
        filename=F.when(~F.col("has_pdf"), F.lit("No PDF")).when(F.col("failed"), F.lit("Failed Download")).otherwise(name),
    )


# ---------------------------------------------------------------------------------- REG-17


def extract_aosta(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Search listing links ``dettaglio?pk_lr=``: header text -> date and number, next paragraph ->
    title (its first 1000 characters are kept); the first record of a URL stays.

    A law is dropped when a repeal phrase stands anywhere in its whole title, or in the text of its
    detail page (``details``: url, html)."""
    paras = E.elements("page", "p", where=lambda e: E.holds("page", e, "class", AOSTA_TITLE_CLASS))
    # a page's later links to a law are no records, so their texts are not built
    found = F.struct(E.first_holding("page", "a", "href", AOSTA_LINK).alias("laws"), U.base_parts(F.col("url")).alias("base"))
    pairs = let(found, lambda f: F.transform(E.with_following(F.transform(f["laws"], lambda x: x["e"]), paras), lambda x, i: F.struct(
        x["e"]["open"].alias("pos"), let(F.get(f["laws"], i)["value"], lambda h: U.resolve(f["base"], h)).alias("src"),
        F.trim(E.text("page", x["e"])).alias("hdr"), E.text("page", x["next"]).alias("next_para"))))
    links = _page(pages, keep=("page_id", "url")).select("page_id", F.inline(pairs))
    hdr, title = F.col("hdr"), F.trim(F.coalesce("next_para", "hdr"))

    def dated(m):
        return let(F.struct(*[rx(m, AOSTA_DATE_RX, k).alias(c) for k, c in enumerate(("day", "mon", "yr"), 1)]), lambda p: F.struct(
            F.concat_ws(" ", p["day"], p["mon"], p["yr"]).alias("shown"), D.make_date(p["yr"], D.month_number(p["mon"]), p["day"]).alias("d")))

    # the header is searched once, the short match again for its parts
    date = E.once(let(rx(hdr, AOSTA_DATE_RX, 0), lambda m: F.when(m.isNotNull(), dated(m))))
    x = links.select("page_id", "pos", "src", title.alias("title"), F.coalesce(N.law_no_alt(hdr), F.lit("0")).alias("no"), date.alias("date"))
    x = x.select("page_id", "pos", "src", "title", "no", "date.shown", "date.d")
    x = S.distinct_ordered(x, "src", ["page_id", "pos"])
    x = P.drop_repealed_phrases(x, "title")
    if details is not None:
        gone = details.filter(P.is_repealed_phrase(H.page_text("html"))).select(F.col("url").alias("src"))
        x = S.purge_repealed(x, gone, "src")
    x = x.withColumn("title", T.truncate_title("title", 1000))
    pk = U.query_param(F.col("src"), "pk_lr", "0")
    name = F.when(F.col("d").isNotNull(), K.law_filename("ValleAosta", F.col("no"), D.date_display("d", "iso"))) \
        .otherwise(F.concat(F.lit("ValleAosta_ID_"), pk, F.lit(".pdf")))
    return to_law_index(
        x, region=F.lit("Valle d'Aosta"), law_title=F.col("title"), law_number=F.col("no"),
        date_text=F.coalesce("shown", F.lit("Unknown")), law_date=F.col("d"), source_url=F.col("src"),
        status=F.lit("Pending"), filename=name,
    )


# ---------------------------------------------------------------------------------- REG-18


def extract_emilia(pages: DataFrame, base: str = "https://emilia.example") -> DataFrame:
    """``a.hitelement_button`` titles less the prefix; ``Legge regionale <date>, n.<no>``; zero-padded display."""
    a = H.anchors_with(_flat(pages), "hitelement_button")
    button = F.array_contains(F.split(F.coalesce("cls", F.lit("")), r"\s+"), "hitelement_button")
    a = a.filter(F.col("title").isNotNull() & button)
    full = T.strip_phrase(F.col("title"), "Accedi al documento ")
    read = lambda t: F.struct(t.alias("full"), rx(t, EMILIA_RX, 2).alias("no"), rx(t, EMILIA_RX, 1).alias("raw"))
    x = a.select(U.absolutise(F.col("href"), base).alias("src"), E.once(let(full, read)).alias("x")).select("src", "x.*")
    no, raw = F.col("no"), F.col("raw")
    parts = F.split(F.trim(F.coalesce(raw, F.lit(""))), r"\s+")
    day = F.regexp_replace(F.try_element_at(parts, F.lit(1)), "°", "")
    mon = F.lower(F.try_element_at(parts, F.lit(2)))
    yr = F.regexp_replace(F.try_element_at(parts, F.lit(3)), r"[,.]", "")
    x = x.select("full", "src", "no", "raw", E.once(F.struct(day.alias("day"), mon.alias("mon"), yr.alias("yr"), D.make_date(yr, D.month_number(mon), day).alias("d"))).alias("x"))
    x = x.select("full", "src", "no", "raw", "x.*")
    day, mon, yr, d = (F.col(c) for c in ("day", "mon", "yr", "d"))
    shown = F.when(d.isNotNull(), F.concat_ws(" ", T.zfill2(day), mon, yr)).otherwise(F.coalesce(raw, F.lit("Unknown")))
    return to_law_index(
        x, region=F.lit("Emilia-Romagna"), law_title=F.col("full"), law_number=F.coalesce(no, F.lit("Unknown")),
        date_text=shown, law_date=d, source_url=F.col("src"), status=F.lit("Pending"),
        filename=T.safe_name_delete(K.law_filename("Emilia-Romagna", F.coalesce(no, F.lit("Unknown")), _iso_or(d, "0000-00-00"))),
    )


EXTRACTORS = {
    "basilicata": extract_basilicata, "campania": extract_campania, "friuli": extract_friuli,
    "lazio": extract_lazio, "liguria": extract_liguria, "lombardia": extract_lombardia, "marche": extract_marche,
    "molise": extract_molise, "piemonte": extract_piemonte, "puglia": extract_puglia, "sardinia": extract_sardinia,
    "trentino": extract_trentino, "toscana": extract_toscana, "umbria": extract_umbria, "veneto": extract_veneto,
    "aosta": extract_aosta, "emilia": extract_emilia,
}
