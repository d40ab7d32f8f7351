"""HTML and document extraction.

Two layers:

* regex forms on the ``html`` column (links, anchors, page text, first element,
  attributes) -- built-in expressions, no Python;
* ``parse_dom``: ONE Arrow pass (``mapInArrow``) that turns a page into a nested
  ``dom`` column; every tree-shaped selector after it is a native higher-order
  function over that column.  Filters on url/id should be applied *before*
  ``parse_dom`` (pushdown does not cross a Python boundary).
"""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regesto.functions._util import col_of, let, nz
from regesto.functions.text import norm_ws

# ----------------------------------------------------------------------------- regex forms

# A start tag as a browser reads it: a value in double quotes, in single quotes or in none, and a
# quote or ``>`` inside a quoted value ends nothing.  Possessive, so no page makes a match slow.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_NAME = r"[^\s/>][^\s=/>]*+"
NAME_REST = r"[^\s/>]*+"
ATTR = rf"(?:[\s/]*+{_NAME}(?:\s*+=\s*+{VALUE})?+)"
START_TAG_END = rf"{ATTR}*+[\s/]*+>"
ANCHOR_RX = rf"(?is)<a(?=[\s/>])({ATTR}*+)[\s/]*+>(.*?)</a\s*+>"
HIDDEN_RX = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
TAG_RX = r"(?s)<[^>]*>"
#: A run of tags and white space that is not one plain space already.
_GAP_RX = r"(?U)(?: (?=[\s<])|[\s&&[^ ]]|<[^>]*>)(?:\s|<[^>]*>)*+"


#: Every named entity of the Latin, symbol and Greek sets; a no-break space counts as a space.
ENTITIES = {name: " " if code == 0xA0 else chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
_CHARREF = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _char(code: Column) -> Column:
    """The character of a code point; NULL beyond Unicode (and a space for the no-break space)."""
    ok = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code == 0xA0, F.lit(" ")).when(ok, char)


def unescape(c) -> Column:
    """Named and numeric character references decoded once, as a browser shows them."""
    # one constant, folded when the plan is made
    names = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))

    def one(part):
        ref = F.regexp_extract(part, _CHARREF, 1)
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.substr(ref, F.lit(3)), 16, 10)).when(ref.startswith("#"), F.substr(ref, F.lit(2)))
        char = F.coalesce(_char(number.try_cast("int")), names[ref])
        return F.coalesce(F.concat(char, F.substr(part, F.length(ref) + 2)), F.concat(F.lit("&"), part))

    def decoded(x):
        return F.array_join(F.transform(F.split(x, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")

    return let(c, lambda x: F.when(F.contains(x, F.lit("&")), decoded(x)).otherwise(x))


def strip_tags(c) -> Column:
    """HTM-8: remove ``<...>`` and trim."""
    return F.trim(F.regexp_replace(col_of(c), TAG_RX, ""))


def inner_text(c) -> Column:
    """Tags out, entities decoded, whitespace collapsed."""
    # without a reference, which may stand for white space, one search finds tags and white space
    referring = lambda x: norm_ws(unescape(F.regexp_replace(x, TAG_RX, " ")))
    return let(c, lambda x: F.when(F.contains(x, F.lit("&")), referring(x)).otherwise(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), _GAP_RX, " "))))


def page_text(html="html") -> Column:
    """HTM-3 (regex form): visible text, scripts, styles and comments out, whitespace-joined."""
    def less(x):
        x = F.regexp_replace(x, r"(?is)<script\b.*?</script\s*>", " ")
        x = F.regexp_replace(x, r"(?is)<style\b.*?</style\s*>", " ")
        return F.regexp_replace(x, r"(?s)<!--.*?-->", " ")

    return inner_text(let(html, lambda x: F.when(_held(x, "!--", "script", "style"), less(x)).otherwise(x)))


def attr_is(name: str, value_rx: str) -> str:
    """Regex for the attributes of a start tag up to the first ``name``, whose whole value must match
    ``value_rx`` (which matches no quote)."""
    v = rf"(?:{value_rx})"
    return rf"""(?:(?![\s/]*+{name}[\s=/>]){ATTR})*+[\s/]*+{name}\s*+=\s*+(?:"{v}"|'{v}'|{v}(?=[\s>]))"""


def has_class(cls: str) -> str:
    """``attr_is`` for a class among others."""
    return attr_is("class", rf"""(?:[^"'>]*\s)?{cls}(?:\s[^"'>]*)?""")


def unquote(c) -> Column:
    """An attribute's value without its quotes, character references decoded once."""
    x = col_of(c)
    quoted = F.substring(x, 1, 1).isin('"', "'")
    return let(F.when(quoted, F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x), unescape)


def attr_value(attrs, name: str) -> Column:
    """The value of an attribute in a start tag's attribute text, in any case of letters; of two with
    one name the first counts; one without a value, or none at all, is ''."""
    rx_ = rf"(?is)^(?:(?![\s/]*+{name}(?:[\s=/]|\z)){ATTR})*+[\s/]*+{name}(?=[\s=/]|\z)\s*+=\s*+({VALUE})"
    return unquote(F.regexp_extract(col_of(attrs), rx_, 1))


def visible(html) -> Column:
    """The html without comments, scripts and styles."""
    return without(html, HIDDEN_RX, "!--", "script", "style")


def without(html, rx_: str, *marks: str) -> Column:
    """The html less what the pattern finds; most pages hold none of its ``marks`` (what follows a ``<``) and need no search."""
    return let(html, lambda x: F.when(_held(x, *marks), F.regexp_replace(x, rx_, " ")).otherwise(x))


def _held(x: Column, *marks: str) -> Column:
    """Whether one of the marks follows a ``<``: a search for bytes, before that for a pattern."""
    names = [m for m in marks if m[0].isalpha()]
    begins = sorted({f"<{c}" for m in names for c in (m[0], m[0].upper())})
    named = reduce(or_, [F.contains(x, F.lit(b)) for b in begins]) & x.rlike(rf"(?i)<(?:{'|'.join(names)})")
    return reduce(or_, [*(F.contains(x, F.lit(f"<{m}")) for m in marks if m not in names), named])


def element_html(html, tag: str, attr_rx: str = "") -> Column:
    """Inner html of the first ``<tag>`` up to its own end tag; NULL if there is none.  ``attr_rx``
    is what ``attr_is`` gives; comments, scripts and styles are no content."""
    return let(visible(html), lambda h: shown_html(h, tag, attr_rx))


def shown_html(h: Column, tag: str, attr_rx: str = "") -> Column:
    """``element_html`` of what ``visible`` has left: found once for all elements of a page."""
    start = rf"(?is)<{tag}(?=[\s/>]){attr_rx}{START_TAG_END}"
    border = rf"(?is)</?{tag}\b[^>]*>"
    def balanced(tail):
        """What stands before the end tag that closes more than was opened."""
        tags = F.regexp_extract_all(tail, F.lit(border), F.lit(0))

        def step(acc, t):
            depth = acc["depth"] + F.when(t.startswith("</"), -1).otherwise(F.when(t.endswith("/>"), 0).otherwise(1))
            open_ = acc["end"] < 0
            return F.struct(
                F.when(open_, depth).otherwise(acc["depth"]).alias("depth"),
                (acc["n"] + 1).alias("n"),
                F.when(open_ & (depth < 0), acc["n"]).otherwise(acc["end"]).alias("end"),
            )

        zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(-1).alias("end"))
        end = F.aggregate(tags, zero, step, lambda acc: acc["end"])
        texts = F.split(tail, border, -1)

        def join(e):
            kept = F.transform(F.slice(texts, F.lit(1), e + 1), lambda x, i: F.concat(x, F.when(i < e, F.get(tags, i)).otherwise("")))
            return F.when(e >= 0, F.array_join(kept, ""))

        return let(end, join)

    nested = let(F.regexp_extract(h, rf"{start}(.*)", 1), balanced)
    begins = reduce(or_, [F.contains(h, F.lit(f"<{c}")) for c in sorted({tag[0], tag[0].upper()})])
    first = F.when(begins, F.regexp_extract(h, rf"{start}(.*?)</{tag}\s*>", 1))
    return nz(let(first, lambda f: F.when(F.contains(f, F.lit("<")) & f.rlike(rf"(?i)<{tag}\b"), nested).otherwise(f)))


def element_text(html, tag: str, attr_rx: str = "") -> Column:
    """HTM-4: text of the first element chosen by tag (and an optional attribute regex)."""
    return nz(inner_text(element_html(html, tag, attr_rx)))


def shown_text(h: Column, tag: str, attr_rx: str = "") -> Column:
    """``element_text`` of what ``visible`` has left."""
    return nz(inner_text(shown_html(h, tag, attr_rx)))


def first_heading(html="html", tags=("h1", "h2", "h3", "h4")) -> Column:
    """HTM-5: first non-empty heading, trying the tags in order."""
    return F.coalesce(*[element_text(html, t) for t in tags])


def attr_values(html, tag: str, attr: str) -> Column:
    """All values of ``attr`` on ``tag`` elements, in page order; comments and scripts hold no element."""
    rx_ = rf"(?is)<{tag}(?=[\s/>])(?:(?![\s/]*+{attr}[\s=/>]){ATTR})*+[\s/]*+{attr}\s*+=\s*+({VALUE}?)"
    return F.transform(F.regexp_extract_all(visible(html), F.lit(rx_), F.lit(1)), unquote)


def attr_regex(html, tag: str, attr: str, value_rx: str) -> Column:
    """HTM-10: group 1 of ``value_rx`` in the first ``tag``/``attr`` value it matches."""
    vals = F.transform(attr_values(html, tag, attr), lambda v: nz(F.regexp_extract(v, value_rx, 1)))
    return F.try_element_at(F.filter(vals, lambda v: v.isNotNull()), F.lit(1))


def extract_links(pages: DataFrame, pattern: str | None = None, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """HTM-1: one row per ``<a href>`` (regex form), 1-based ``pos`` in page order, optional href regex."""
    out = pages.select(*keep, F.posexplode(attr_values(html, "a", "href")).alias("pos0", "href"))
    out = out.withColumn("pos", (F.col("pos0") + 1).cast("int")).drop("pos0")
    if pattern:
        out = out.filter(F.col("href").rlike(pattern))
    return out


def extract_anchors(pages: DataFrame, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """HTM-2: href with anchor text, ``title`` and ``class`` attributes, 1-based ``pos``."""
    def both(h):
        return F.arrays_zip(F.regexp_extract_all(h, F.lit(ANCHOR_RX), F.lit(1)).alias("a"), F.regexp_extract_all(h, F.lit(ANCHOR_RX), F.lit(2)).alias("t"))

    value = lambda attrs, name: nz(attr_value(attrs, name))
    # the address comes out of the generator: filters on it are not pushed below and computed anew
    found = F.transform(let(visible(html), both), lambda z: F.struct(value(z["a"], "href").alias("href"), z["a"].alias("a"), z["t"].alias("t")))
    z = pages.select(*keep, F.posexplode(found).alias("pos0", "z"))
    z = z.select(*keep, (F.col("pos0") + 1).cast("int").alias("pos"), F.col("z.href").alias("href"), F.col("z.a").alias("__attrs"), F.col("z.t").alias("__inner"))
    return z.select(*keep, "pos", "href", inner_text("__inner").alias("text"), value("__attrs", "title").alias("title"), value("__attrs", "class").alias("cls"))


def anchors_with(pages: DataFrame, mark: str, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """HTM-2: (href, title, cls) of the anchors whose attributes hold ``mark``: the others' are not read."""
    value = lambda attrs, name: nz(attr_value(attrs, name))
    # a reference may hide the mark, so what holds one is read as well
    tags = F.filter(F.regexp_extract_all(visible(html), F.lit(ANCHOR_RX), F.lit(1)), lambda a: F.contains(a, F.lit(mark)) | F.contains(a, F.lit("&")))
    found = F.transform(tags, lambda a: F.struct(value(a, "href").alias("href"), value(a, "title").alias("title"), value(a, "class").alias("cls")))
    return pages.select(*keep, F.inline(found)).filter(reduce(or_, [F.contains(c, F.lit(mark)) for c in ("href", "title", "cls")]))


def hrefs_with(html, mark: str) -> Column:
    """The distinct addresses of a page's anchors that hold ``mark``, in page order: other tags are not read."""
    tags = F.filter(F.regexp_extract_all(visible(html), F.lit(ANCHOR_RX), F.lit(1)), lambda a: F.contains(a, F.lit(mark)) | F.contains(a, F.lit("&")))
    return F.array_distinct(F.filter(F.transform(tags, lambda a: attr_value(a, "href")), lambda h: F.contains(h, F.lit(mark))))


# ----------------------------------------------------------------------------- parse_dom (one Arrow pass)

_STR = T.StringType()
DOM_SCHEMA = T.StructType([
    T.StructField("title", _STR),
    T.StructField("text", _STR),
    T.StructField("headings", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("tag", _STR), T.StructField("id", _STR),
        T.StructField("cls", _STR), T.StructField("text", _STR), T.StructField("next_text", _STR),
    ]))),
    T.StructField("links", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("href", _STR), T.StructField("text", _STR),
        T.StructField("title", _STR), T.StructField("cls", _STR), T.StructField("parent_tag", _STR),
        T.StructField("parent_text", _STR), T.StructField("next_para", _STR), T.StructField("in_cls", _STR),
    ]))),
    T.StructField("cells", T.ArrayType(T.StructType([
        T.StructField("tbl", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
        T.StructField("text", _STR), T.StructField("has_button", T.BooleanType()), T.StructField("is_header", T.BooleanType()),
        T.StructField("href", _STR),
    ]))),
    T.StructField("paras", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("align", _STR), T.StructField("cls", _STR), T.StructField("text", _STR),
    ]))),
    T.StructField("items", T.ArrayType(_STR)),
    T.StructField("labels", T.ArrayType(T.StructType([
        T.StructField("label", _STR), T.StructField("block_text", _STR),
    ]))),
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("tag", _STR), T.StructField("id", _STR), T.StructField("cls", _STR),
        T.StructField("text", _STR), T.StructField("clean_text", _STR),
    ]))),
    T.StructField("fonts", T.ArrayType(_STR)),
])


def parse_dom(pages: DataFrame, drop_classes=("bur",), key: str = "page_id", html: str = "html", keep=(),
              parts=None) -> DataFrame:
    """HTM-0: ``(key, *keep, html)`` -> ``(key, *keep, dom)`` in one Arrow pass (``mapInArrow``).

    ``drop_classes``: elements with one of these classes are left out of their
    ancestors' ``clean_text`` (HTM-7, e.g. the bulletin line inside a title).
    ``parts``: the dom parts a job reads (default all); the others come back empty.
    """
    from pyspark import cloudpickle
    from pyspark.sql.pandas.types import to_arrow_type

    from regesto.functions import _dom

    # ship the per-page helper with the task (by value), so executors need no copy of this package
    cloudpickle.register_pickle_by_value(_dom)
    keep = tuple(keep)
    cols = (key, *keep)
    fields = [pages.schema[c] for c in cols]
    out_schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("dom", DOM_SCHEMA)])
    drops = tuple(drop_classes)
    want = _dom.ALL_PARTS if parts is None else frozenset(parts)
    arrow_type = to_arrow_type(DOM_SCHEMA)
    parse_batch = _dom.parse_batch

    def run(batches):
        # Arrow in, Arrow out: no pandas objects; a few hundred pages at a time bound what a task holds
        for batch in batches:
            for lo in range(0, batch.num_rows, _dom.PAGES_AT_ONCE):
                yield parse_batch(batch.slice(lo, _dom.PAGES_AT_ONCE), cols, html, drops, want, arrow_type)

    return pages.select(*cols, html).mapInArrow(run, out_schema)


# ----------------------------------------------------------------------------- selectors over dom

def table_cells(dom_df: DataFrame, skip_header: bool = True, keep=("page_id",)) -> DataFrame:
    """HTM-6: one row per table cell (tbl, row, col, text); header rows skipped if asked."""
    cells = F.col("dom.cells")
    if skip_header:
        cells = F.filter(cells, lambda c: ~c["is_header"])
    return dom_df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*")


def block_text(dom="dom", id_: str | None = None, cls: str | None = None, clean: bool = True) -> Column:
    """HTM-4/HTM-7: text of the first block with the given id/class (``clean`` drops marked sub-elements)."""
    def pick(b):
        cond = F.lit(True)
        if id_ is not None:
            cond = cond & (b["id"] == id_)
        if cls is not None:
            cond = cond & F.array_contains(F.split(F.coalesce(b["cls"], F.lit("")), " "), cls)
        return cond

    hit = F.try_element_at(F.filter(col_of(dom)["blocks"], pick), F.lit(1))
    return hit["clean_text" if clean else "text"]


def value_of_label(hit: Column, digits: bool) -> Column:
    """What stands in a label's block (label, block_text) after the first ':', or after the label."""
    block, name = hit["block_text"], hit["label"]
    first_colon = F.instr(block, ":")
    named = F.instr(block, name)
    after = F.when(first_colon > 0, block.substr(first_colon + 1, F.lit(1 << 30))).when(
        named > 0, block.substr(named + F.length(name), F.lit(1 << 30))
    )
    after = F.trim(F.coalesce(after, block))
    return F.coalesce(nz(F.regexp_extract(after, r"([0-9]+)", 1)), nz(after)) if digits else nz(after)


def label_value(dom="dom", label: str = "Numero", exclude: tuple[str, ...] = (), digits: bool = False) -> Column:
    """HTM-9: value in the block of the first bold label containing ``label`` (case-insensitive)
    and none of ``exclude``: what stands after the first ':', or else after the label itself;
    ``digits`` keeps the first run of digits, or the whole value where there is none."""
    def ok(l):
        cond = F.lower(l["label"]).contains(label.lower())
        for w in exclude:
            cond = cond & ~F.lower(l["label"]).contains(w.lower())
        return cond

    return let(F.try_element_at(F.filter(col_of(dom)["labels"], ok), F.lit(1)), lambda hit: value_of_label(hit, digits))


#: What the address or the class of a document's link shows.
DOCUMENT_RX = r"(?i)(\.pdf$|download|scarica)"


def has_document(dom="dom", pattern: str = DOCUMENT_RX) -> Column:
    """HTM-12: does the page offer a downloadable document (a link whose href or class matches)?"""
    return F.exists(
        col_of(dom)["links"],
        lambda l: F.coalesce(l["href"], F.lit("")).rlike(pattern) | F.coalesce(l["cls"], F.lit("")).rlike(pattern),
    )


def explode_documents(dom_df: DataFrame, primary_cls=("download-list", "card-teaser"), keep=("page_id",)) -> DataFrame:
    """HTM-13: every link inside an element of a class of ``primary_cls``; only if there is none,
    every link whose href ends with ``.pdf``.  One row per document, 1-based ``doc_pos``."""
    links = F.col("dom.links")
    wanted = F.array(*[F.lit(c) for c in ([primary_cls] if isinstance(primary_cls, str) else primary_cls)])
    primary = F.filter(links, lambda l: F.arrays_overlap(F.split(F.coalesce(l["in_cls"], F.lit("")), " "), wanted))
    fallback = F.filter(links, lambda l: F.lower(F.coalesce(l["href"], F.lit(""))).endswith(".pdf"))
    chosen = F.when(F.size(primary) > 0, primary).otherwise(fallback)
    return dom_df.select(*keep, F.posexplode(chosen).alias("p0", "l")).select(
        *keep, (F.col("p0") + 1).cast("int").alias("doc_pos"), F.col("l.href").alias("href"), F.col("l.text").alias("link_text")
    )


def heading_next_text(dom="dom", tag: str = "h1") -> Column:
    """HTM-11: the text node right after the first ``tag`` heading."""
    hit = F.try_element_at(F.filter(col_of(dom)["headings"], lambda h: h["tag"] == tag), F.lit(1))
    return hit["next_text"]


def heading_text(dom="dom", tag: str = "h1") -> Column:
    hit = F.try_element_at(F.filter(col_of(dom)["headings"], lambda h: h["tag"] == tag), F.lit(1))
    return nz(hit["text"])


def neighbour_text(dom="dom", how: str = "next_text", tag: str = "h1", href_rx: str | None = None) -> Column:
    """HTM-11: text next to an element: ``next_text`` = the node right after the first ``tag``
    heading; ``parent`` / ``next_para`` = the parent's text / the following paragraph of the first
    link whose href matches ``href_rx``."""
    if how == "next_text":
        return heading_next_text(dom, tag)
    links = col_of(dom)["links"]
    if href_rx:
        links = F.filter(links, lambda l: F.coalesce(l["href"], F.lit("")).rlike(href_rx))
    hit = F.try_element_at(links, F.lit(1))
    return hit["parent_text" if how == "parent" else "next_para"]


def text_without(dom="dom", id_: str | None = None, cls: str | None = None) -> Column:
    """HTM-7: text of an element minus the sub-elements whose class was given to ``parse_dom``
    as ``drop_classes``."""
    return block_text(dom, id_=id_, cls=cls, clean=True)


# The date pattern of a capture's Content-Disposition and first page.
CD_DATE_RX = r"\d{1,2}\s+[a-zà]+\s+\d{4}"


def date_from_sources(header, text) -> Column:
    """HTM-15: date text from the Content-Disposition header first, then from the first-page text
    (both lower-cased)."""
    from regesto.functions._util import rx

    return F.coalesce(rx(F.lower(col_of(header)), f"({CD_DATE_RX})"), rx(F.lower(col_of(text)), f"({CD_DATE_RX})"))
