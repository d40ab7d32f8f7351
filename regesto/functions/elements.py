"""The interval-numbered element table of a page (HTM-0).

``scan(html)`` numbers a page's tokens (tags and the texts between them) and gives every element
the numbers of its first and last token::

    struct<tokens array<string>, els array<struct<open int, close int, depth int, tag string>>>

An element is inside another if its numbers lie between the other's; what follows it has greater
numbers; its text is what stands between its numbers.  So selectors are comparisons of numbers,
and a text is built for the elements that a selector picks, not for every ancestor or link.

The scan is one regex over the page and one walk over its tag names with the stack of open elements
(``_scan``, an Arrow function); pages with the same tags share the walk.  What an unclosed ``<p>``,
``<li>``, cell or row ends at is a table (``_ENDS``); a stray end tag ends nothing.  Selectors are
built-in functions; keep the result in a projection of its own and select from that.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from regesto.functions import html as H
from regesto.functions._util import col_of, let
from regesto.functions.text import norm_ws

# Element names of HTML by the way they nest.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
INLINE = "a span b strong i em u small sup sub font abbr code label".split()
BLOCKS = "p div table ul ol dl h1 h2 h3 h4 h5 h6 pre form section article nav header footer blockquote aside".split()
LABEL_BLOCKS = "p div li td dd th section".split()
#: start tag -> (open elements that it ends, elements that keep them open)
_ENDS = {
    **{t: (["p"], ["td", "th", "li", "div", "table"]) for t in BLOCKS},
    "li": (["li"], ["ul", "ol"]),
    "td": (["td", "th"], ["tr", "table"]),
    "th": (["td", "th"], ["tr", "table"]),
    "tr": (["tr"], ["table"]),
}

TOKEN_RX = rf"(?s)[^<]++|</[a-zA-Z][^>]*+>|<[a-zA-Z]{H.NAME_REST}{H.START_TAG_END}|<[!?][^>]*+>|<"
_NAME_RX = r"(?s)^</?([a-zA-Z][^\s/>]*)"
_INLINE_RX = rf"(?i)^</?(?:{'|'.join(INLINE)})(?=[\s/>])"
_UNSEEN_RX = r"(?is)<(template|noscript)\b[^>]*+>.*?(?:</\1\s*+>|\z)"


_ELEMENT = "struct<open:int,close:int,depth:int,tag:string>"


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def scan(html="html") -> Column:
    """The element table of a page; comments, scripts, styles and hidden templates are not in it."""
    from pyspark import cloudpickle

    from regesto.functions import _scan

    # ship the per-page helper with the task (by value), so executors need no copy of this package
    cloudpickle.register_pickle_by_value(_scan)
    shown = H.without(H.visible(html), _UNSEEN_RX, "template", "noscript")
    return F.arrow_udf(_scan.scanner(TOKEN_RX, frozenset(VOID), _ENDS), f"struct<tokens:array<string>,els:array<{_ELEMENT}>>")(shown)


def once(c: Column) -> Column:
    """The same value from a generator: what reads it later is not pushed below, where it would compute
    the value anew for each use."""
    return F.explode(F.array(c))


# ------------------------------------------------------------------ conditions on an element


def _attr_rx(name: str) -> str:
    return rf"(?is)^<[a-z]{H.NAME_REST}(?:(?![\s/]*+{name}[\s=/>]){H.ATTR})*+[\s/]*+{name}(?=[\s=/>])(?:\s*+=\s*+({H.VALUE}))?+"


def attr(page, e: Column, name: str) -> Column:
    """The value of an attribute of an element, NULL if it has none."""
    tag, rx = F.get(col_of(page)["tokens"], e["open"] - 1), _attr_rx(name)
    return let(tag, lambda t: F.when(t.rlike(rx), H.unquote(F.regexp_extract(t, rx, 1))))


def value(page, e: Column, name: str) -> Column:
    """The value of an attribute of an element, '' if it has none: one search."""
    return H.unquote(F.regexp_extract(F.get(col_of(page)["tokens"], e["open"] - 1), _attr_rx(name), 1))


def classes(page, e: Column) -> Column:
    return F.split(F.coalesce(attr(page, e, "class"), F.lit("")), r"\s+")


def _mentions(page, e: Column, *words: str) -> Column:
    """Whether the start tag holds one of the words: most do not, and need no closer look."""
    def any_of(t):
        return reduce(or_, [F.contains(t, F.lit(w)) for w in words], F.lit(False))

    tag = F.get(col_of(page)["tokens"], e["open"] - 1)
    return any_of(tag) if len(words) < 2 else let(tag, any_of)


def has_class(page, e: Column, *names: str) -> Column:
    """Whether the element has one of these classes."""
    return _mentions(page, e, *names) & F.arrays_overlap(classes(page, e), _strings(names))


def has_attr(page, e: Column, name: str, value: str) -> Column:
    """Whether an attribute has exactly this value."""
    return _mentions(page, e, value) & F.coalesce(attr(page, e, name) == value, F.lit(False))


def holds(page, e: Column, name: str, part: str) -> Column:
    """Whether an attribute's value holds ``part``; a reference may hide it, so a tag with one is read as well."""
    return _mentions(page, e, part, "&") & F.contains(value(page, e, name), F.lit(part))


def contains(outer: Column, e: Column) -> Column:
    """Whether ``e`` lies inside ``outer``."""
    return (outer["open"] < e["open"]) & (e["open"] < outer["close"])


def elements(page, *tags: str, where=None) -> Column:
    """The page's elements of these tags (all without), in page order, for which ``where`` holds."""
    els = col_of(page)["els"]
    if tags:
        els = F.filter(els, lambda e: e["tag"].isin(list(tags)))
    return els if where is None else F.filter(els, where)


def first(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))


def first_holding(page, tag: str, name: str, part: str) -> Column:
    """struct(e, value) of the elements of a tag whose attribute ``name`` holds ``part``, in page order; of
    those with one value the first.  Two sorts, whatever their number."""
    read = F.transform(elements(page, tag, where=lambda e: _mentions(page, e, part, "&")), lambda e: F.struct(value(page, e, name).alias("value"), e.alias("e")))
    sorted_ = F.array_sort(F.filter(read, lambda x: F.contains(x["value"], F.lit(part))))
    news = lambda xs: F.filter(xs, lambda x, i: (i == 0) | (F.get(xs, i - 1)["value"] != x["value"]))
    return F.array_sort(F.transform(let(sorted_, news), lambda x: F.struct(x["e"].alias("e"), x["value"].alias("value"))))


def following(page, e: Column, *tags: str, where=None) -> Column:
    """The first element of these tags that begins after ``e`` has ended."""
    def after(x):
        cond = x["open"] > e["close"]
        return cond & where(x) if where is not None else cond

    return first(elements(page, *tags, where=after))


def _matched(els: Column, others: Column, key: str, backwards: bool, name: str) -> Column:
    """struct(e, <name>): each of ``els`` with the last of ``others`` that a walk over the page met before it."""
    def keyed(xs, field, own: bool):
        return F.transform(xs, lambda x: F.struct(x[field].alias("key"), F.lit(own).alias("own"), x.alias("e")))

    merged = F.array_sort(F.concat(keyed(els, key, True), keyed(others, "open", False)))
    pair = f"array<struct<e:{_ELEMENT},{name}:{_ELEMENT}>>"

    def step(acc, x):
        found = F.concat(acc["found"], F.array(F.struct(x["e"].alias("e"), acc["met"].alias(name))))
        return F.struct(F.when(x["own"], acc["met"]).otherwise(x["e"]).alias("met"), F.when(x["own"], found).otherwise(acc["found"]).alias("found"))

    zero = F.struct(F.lit(None).cast(_ELEMENT).alias("met"), F.array().cast(pair).alias("found"))
    return F.array_sort(F.aggregate(F.reverse(merged) if backwards else merged, zero, step, lambda acc: acc["found"]))


def with_following(els: Column, targets: Column) -> Column:
    """struct(e, next) of every element of ``els``: the first of ``targets`` that begins after it has
    ended.  One walk from the page's end, whatever the number of both."""
    return _matched(els, targets, "close", True, "next")


def with_container(els: Column, boxes: Column) -> Column:
    """struct(e, box) of every element of ``els``: the one of ``boxes``, which do not nest, around it, or NULL."""
    met = _matched(els, boxes, "open", False, "box")
    return F.transform(met, lambda x: F.struct(x["e"].alias("e"), F.when(contains(x["box"], x["e"]), x["box"]).alias("box")))


def nearest(page, e: Column, *tags: str) -> Column:
    """The innermost element of these tags around ``e``."""
    return F.try_element_at(elements(page, *tags, where=lambda x: contains(x, e)), F.lit(-1))


# ------------------------------------------------------------------ texts


def text_between(page, lo: Column, hi: Column, without: Column | None = None) -> Column:
    """Visible text of the tokens between two numbers (both exclusive), leaving out the elements
    ``without``; white space collapsed, '' where there is none."""
    tokens = F.slice(col_of(page)["tokens"], lo + 1, F.greatest(hi - lo - 1, F.lit(0)))

    # an inline tag joins what it parts; a sign of its own, so no reference grows together
    def piece(t):
        return F.when(~t.startswith("<") | (t == "<"), t).when(t.rlike(_INLINE_RX), F.lit("\x00")).otherwise(F.lit(" "))

    def less(out):
        at = lambda i: lo + 1 + i
        return F.transform(tokens, lambda t, i: F.when(F.exists(out, lambda x: at(i).between(x["open"], x["close"])), F.lit("\x00")).otherwise(piece(t)))

    shown = F.transform(tokens, piece) if without is None else let(without, less)
    return norm_ws(F.replace(H.unescape(F.array_join(shown, "")), F.lit("\x00"), F.lit("")))


def text(page, e: Column, without: Column | None = None) -> Column:
    """Text of an element, NULL if there is no element."""
    return let(e, lambda x: F.when(x.isNotNull(), text_between(page, x["open"], x["close"], without)))


def page_text(page) -> Column:
    return text_between(page, F.lit(0), F.size(col_of(page)["tokens"]) + 1)


def text_without(page, e: Column, *cls: str) -> Column:
    """HTM-7: text of an element less that of the elements in it with one of these classes."""
    return let(e, lambda x: text(page, x, elements(page, where=lambda y: contains(x, y) & has_class(page, y, *cls))))


def next_text(page, e: Column) -> Column:
    """HTM-11: text of the node right after an element (a text or an element), NULL if an end tag follows."""
    tokens = col_of(page)["tokens"]

    def after(x):
        ended = F.get(tokens, x["close"] - 1)
        own = ended.startswith("</") & (F.lower(F.regexp_extract(ended, _NAME_RX, 1)) == x["tag"])
        return let(F.when(own | (x["open"] == x["close"]), x["close"] + 1).otherwise(x["close"]), lambda at: let(F.get(tokens, at - 1), lambda t: node(at, t)))

    def node(at, t):
        element = first(elements(page, where=lambda y: y["open"] == at))
        return F.when(t.startswith("</"), F.lit(None)).when(t.startswith("<") & (t != "<"), text(page, element)).otherwise(norm_ws(H.unescape(t)))

    return let(e, after)


def label_value(page, label: str, exclude: tuple[str, ...] = (), digits: bool = False) -> Column:
    """HTM-9: value in the block around the first bold label that contains ``label`` and none of
    ``exclude``; see ``html.label_value``."""
    def entry(e):
        return F.struct(text(page, e).alias("label"), let(nearest(page, e, *LABEL_BLOCKS), lambda b: F.coalesce(text(page, b), page_text(page))).alias("block_text"))

    def wanted(e):
        def named(name):
            cond = name.contains(label.lower())
            for w in exclude:
                cond = cond & ~name.contains(w.lower())
            return cond

        return let(F.lower(text(page, e)), named)

    hit = first(elements(page, "strong", "b", where=wanted))
    return let(F.transform(F.filter(F.array(hit), lambda e: e.isNotNull()), entry), lambda found: H.value_of_label(F.try_element_at(found, F.lit(1)), digits))


def documents(page, *cls: str) -> Column:
    """HTM-13: the links inside an element with one of these classes; only without any, the links that end with ``.pdf``."""
    links = elements(page, "a", where=lambda a: attr(page, a, "href").isNotNull())
    boxes = elements(page, where=lambda e: has_class(page, e, *cls))

    def chosen(p):
        primary = F.filter(p["links"], lambda a: F.exists(p["boxes"], lambda b: contains(b, a)))
        other = F.filter(p["links"], lambda a: F.lower(attr(page, a, "href")).endswith(".pdf"))
        return let(primary, lambda p: F.when(F.size(p) > 0, p).otherwise(other))

    return let(F.struct(links.alias("links"), boxes.alias("boxes")), chosen)


def cells(page, skip_header: bool = True) -> Column:
    """HTM-6: struct(tbl, row, col, text, has_button) of every table cell; ``tbl`` counts the page's
    tables, a row belongs to the innermost table around it, header rows are left out if asked."""
    any_button = lambda y: (y["tag"] == "button") | attr(page, y, "type").isin("button", "submit", "image")
    parts = F.struct(  # found once, not for every row and cell
        elements(page, "table").alias("tables"), elements(page, "tr").alias("rows"), elements(page, "td", "th").alias("cells"),
        elements(page, "thead").alias("heads"), elements(page, "button", "input", where=any_button).alias("buttons"),
    )

    def of_table(p, t, k):
        # no table in this one holds the row
        own = F.filter(p["rows"], lambda r: contains(t, r) & ~F.exists(p["tables"], lambda x: contains(t, x) & contains(x, r)))
        return F.flatten(F.transform(own, lambda r, i: of_row(p, k, r, i)))

    def of_row(p, k, r, i):
        tds = F.filter(p["cells"], lambda c: contains(r, c) & (c["depth"] == r["depth"] + 1))
        header = lambda cs: ((F.size(cs) > 0) & F.forall(cs, lambda c: c["tag"] == "th")) | F.exists(p["heads"], lambda h: contains(h, r))

        def described(c, j):
            button = F.exists(p["buttons"], lambda y: contains(c, y))
            return F.struct((k + 1).alias("tbl"), (i + 1).alias("row"), (j + 1).alias("col"), text(page, c).alias("text"), button.alias("has_button"))

        keep = (lambda cs: F.when(header(cs), F.slice(cs, 1, 0)).otherwise(cs)) if skip_header else (lambda cs: cs)
        return let(tds, lambda cs: F.transform(keep(cs), described))

    return let(parts, lambda p: F.flatten(F.transform(p["tables"], lambda t, k: of_table(p, t, k))))
