"""Per-page helper for ``parse_dom``: one regex scan of a page -> the nested ``dom`` value.

Runs inside Spark tasks (``mapInArrow``); Spark partitions the pages.  It does
the small amount of tree repair real pages need: void tags, unclosed ``<p>``,
``<li>``, ``<td>``/``<tr>``, stray end tags, and script/style content.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pyarrow as pa

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "p div table ul ol dl h1 h2 h3 h4 h5 h6 pre form section article nav header footer blockquote aside".split()
)
SKIP_TEXT = frozenset(("script", "style", "template", "noscript"))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
INLINE = frozenset("a span b strong i em u small sup sub font abbr code label".split())
LABEL_BLOCKS = frozenset(("p", "div", "li", "td", "dd", "th", "section"))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "order", "text", "classes")

    def __init__(self, tag, attrs, parent, order):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent
        self.order = order
        self.text = None  # once asked for
        self.classes = None

    def cls(self):
        return self.attrs.get("class") or ""


# One scan over the page.  Groups: 1 end tag, 2 start tag, 3 its attributes, 4 self-closing
# slash, 5 text.  Comments, declarations and processing instructions match with no group set.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>"
    r"|</\s*([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:\s+[^\s=/>]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+))?)*)\s*(/?)\s*>"
    r"|([^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# script and style hold raw text, never markup: dropped whole before the scan
_RAW = re.compile(r"<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)", re.S | re.I)


def _attrs(raw: str):
    out = []
    for name, v1, v2, v3 in _ATTR.findall(raw):
        v = v1 or v2 or v3
        out.append((name.lower(), unescape(v) if v else ("" if v is not None else None)))
    return out


def feed(builder, html: str) -> None:
    """Tokenise ``html`` into ``builder``: start/end tags and text with entities decoded."""
    start, end, data = builder.handle_starttag, builder.handle_endtag, builder.handle_data
    for end_tag, start_tag, raw_attrs, slash, text in _TOKEN.findall(_RAW.sub("", html)):
        if start_tag:
            tag = start_tag.lower()
            attrs = _attrs(raw_attrs) if raw_attrs else []
            if slash:
                builder.handle_startendtag(tag, attrs)
            else:
                start(tag, attrs)
        elif end_tag:
            end(end_tag.lower())
        elif text:
            data(unescape(text) if "&" in text else text)


class _Builder:
    def __init__(self):
        self.root = Node("#root", {}, None, 0)
        self.stack = [self.root]
        self.n = 0
        self.elements = []

    # -- tree repair helpers
    def _open_index(self, tag, stop=()):
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                return i
            if t in stop:
                return -1
        return -1

    def _close_to(self, i):
        if i > 0:
            del self.stack[i:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_to(self._open_index("p", stop=("td", "th", "li", "div", "table")))
        if tag == "li":
            self._close_to(self._open_index("li", stop=("ul", "ol")))
        elif tag in ("td", "th"):
            self._close_to(max(self._open_index("td", stop=("tr", "table")), self._open_index("th", stop=("tr", "table"))))
        elif tag == "tr":
            self._close_to(self._open_index("tr", stop=("table",)))
        self.n += 1
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1], self.n)
        self.stack[-1].children.append(node)
        self.elements.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        self._close_to(self._open_index(tag))

    def handle_data(self, data):
        if self.stack[-1].tag in SKIP_TEXT:
            return
        self.stack[-1].children.append(data)


def text_of(node, drop=()) -> str:
    """Text below ``node``, white space collapsed; an explicit stack, so any depth will do."""
    if not drop and node.text is not None:
        return node.text
    out, stack = [], [iter(node.children)]
    ends = [""]
    while stack:
        ch = next(stack[-1], None)
        if ch is None:
            stack.pop()
            out.append(ends.pop())
        elif isinstance(ch, str):
            out.append(ch)
        elif ch.tag not in SKIP_TEXT and not (drop and any(c in drop for c in ch.cls().split())):
            gap = "" if ch.tag in INLINE else " "
            out.append(gap)
            ends.append(gap)
            stack.append(iter(ch.children))
    text = " ".join("".join(out).split())
    if not drop:
        node.text = text
    return text


def _next_text(node):
    """Text of the node right after this one (a text node or an element), whitespace-collapsed."""
    parent = node.parent
    if parent is None:
        return None
    sibs = parent.children
    i = next(k for k, ch in enumerate(sibs) if ch is node)
    if i + 1 >= len(sibs):
        return None
    ch = sibs[i + 1]
    return " ".join(ch.split()) if isinstance(ch, str) else text_of(ch)


def _ancestor_classes(node):
    """The distinct classes above ``node``, nearest first; kept on each parent for its other children."""
    chain, p = [], node.parent
    while p is not None and p.tag != "#root" and p.classes is None:
        chain.append(p)
        p = p.parent
    above = p.classes if p is not None and p.tag != "#root" else ""
    for p in reversed(chain):
        own = p.cls()
        p.classes = above = " ".join(dict.fromkeys(f"{own} {above}".split())) if own else above
    return above


#: Pages whose nested values are built and converted together.
PAGES_AT_ONCE = 500

ALL_PARTS = frozenset(("title", "text", "headings", "links", "cells", "paras", "items", "labels", "blocks", "fonts"))


def parse_html(html: str, drop=("bur",), want=ALL_PARTS) -> dict:
    """``want``: the dom parts to build (the others come back empty), so a job pays only for
    the selectors it uses."""
    b = _Builder()
    feed(b, html or "")
    els = b.elements
    title = next((text_of(e) for e in els if e.tag == "title"), None) if "title" in want else None
    headings, links, cells, paras, items, labels, blocks = [], [], [], [], [], [], []
    w_head, w_links, w_cells = "headings" in want, "links" in want, "cells" in want
    fonts, w_fonts = [], "fonts" in want
    w_paras, w_items, w_labels, w_blocks = "paras" in want, "items" in want, "labels" in want, "blocks" in want
    ps = [e for e in els if e.tag == "p"] if w_links else []
    p_orders = [e.order for e in ps]
    tbl_no = 0
    for e in els:
        t = e.tag
        if t in HEADINGS and w_head:
            headings.append({"pos": len(headings) + 1, "tag": t, "id": e.attrs.get("id"), "cls": e.attrs.get("class"),
                             "text": text_of(e), "next_text": _next_text(e)})
        elif t == "a" and w_links and "href" in e.attrs:
            par = e.parent
            k = bisect_right(p_orders, e.order)
            nxt = ps[k] if k < len(ps) else None
            links.append({
                "pos": len(links) + 1, "href": e.attrs.get("href"), "text": text_of(e), "title": e.attrs.get("title"),
                "cls": e.attrs.get("class"), "parent_tag": par.tag if par is not None else None,
                # only a paragraph's own text belongs to its links; a list's would be copied into each
                "parent_text": text_of(par) if par is not None and par.tag == "p" else None,
                "next_para": text_of(nxt) if nxt is not None else None, "in_cls": _ancestor_classes(e),
            })
        elif t == "table" and w_cells:
            tbl_no += 1
            rows = [r for r in _descendants(e) if r.tag == "tr" and _nearest(r, "table") is e]
            for ri, r in enumerate(rows, 1):
                tds = [c for c in r.children if not isinstance(c, str) and c.tag in ("td", "th")]
                header = bool(tds) and all(c.tag == "th" for c in tds) or _nearest(r, "thead") is not None
                for ci, c in enumerate(tds, 1):
                    desc = list(_descendants(c))
                    btn = any(d.tag == "button" or (d.tag == "input" and d.attrs.get("type") in ("button", "submit", "image"))
                              for d in desc)
                    href = next((d.attrs.get("href") for d in desc if d.tag == "a" and "href" in d.attrs), None)
                    cells.append({"tbl": tbl_no, "row": ri, "col": ci, "text": text_of(c), "has_button": btn,
                                  "is_header": header, "href": href})
        elif t == "p" and w_paras:
            style = e.attrs.get("style", "")
            align = e.attrs.get("align") or ("center" if "text-align:center" in style.replace(" ", "") else None)
            paras.append({"pos": len(paras) + 1, "align": align, "cls": e.attrs.get("class"), "text": text_of(e)})
        elif t == "font" and w_fonts and e.attrs.get("dir") == "auto":
            fonts.append(text_of(e))
        elif t == "li" and w_items:
            items.append(text_of(e))
        if w_labels and t in ("strong", "b"):
            blk = e.parent
            while blk is not None and blk.tag not in LABEL_BLOCKS and blk.tag != "#root":
                blk = blk.parent
            labels.append({"label": text_of(e), "block_text": text_of(blk) if blk is not None else None})
        if w_blocks and (e.attrs.get("id") or e.attrs.get("class")):
            blocks.append({"tag": t, "id": e.attrs.get("id"), "cls": e.attrs.get("class"),
                           "text": text_of(e), "clean_text": text_of(e, drop)})
    return {"title": title, "text": text_of(b.root) if "text" in want else None, "headings": headings, "links": links, "cells": cells,
            "paras": paras, "items": items, "labels": labels, "blocks": blocks, "fonts": fonts}


def _descendants(node):
    stack = [iter(node.children)]
    while stack:
        ch = next(stack[-1], None)
        if ch is None:
            stack.pop()
        elif not isinstance(ch, str):
            yield ch
            stack.append(iter(ch.children))


def _nearest(node, tag):
    p = node.parent
    while p is not None:
        if p.tag == tag:
            return p
        p = p.parent
    return None


def parse_batch(batch: pa.RecordBatch, cols, html: str, drop, want, arrow_type) -> pa.RecordBatch:
    """One Arrow batch of pages -> the same batch with a ``dom`` column of ``arrow_type``."""
    dropset = frozenset(drop)
    doms = [parse_html(h, dropset, want) for h in batch.column(html).to_pylist()]
    arrays = [batch.column(c) for c in cols] + [pa.array(doms, type=arrow_type)]
    return pa.RecordBatch.from_arrays(arrays, names=[*cols, "dom"])
