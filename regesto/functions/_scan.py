"""Per-page helper for ``elements.scan``: a page's tokens and the numbers of its elements.

Runs inside Spark tasks (an Arrow function of one column); Spark partitions the pages.  How a page's
elements nest depends on its tag names alone, so of the pages that are made alike one is walked.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

PAGES_AT_ONCE = 500


def nest(heads: list[str], void: frozenset, rules: dict) -> list[tuple[int, int, int, str]]:
    """(open, close, depth, tag) of every element in page order.  ``heads`` has one entry per token: its
    ``<name`` or ``</name`` (a ``/`` after it if the tag ends with one), '' for what is no tag."""
    stack: list[tuple[int, str]] = []  # outermost first
    done = []
    for pos, head in enumerate(heads, 1):
        if not head:
            continue
        end = head[1] == "/"
        closed = head[-1] == "/"
        tag = head[2 if end else 1 : -1 if closed else None].lower()
        alone = closed or tag in void
        ends, keeps = ((tag,), ()) if end else rules.get(tag, ((), ()))
        k = 0
        if ends:  # the innermost open element that the tag ends or that keeps the others open
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][1] in ends:
                    k = len(stack) - i
                    break
                if stack[i][1] in keeps:
                    break
        for _ in range(k):
            opened, name = stack.pop()
            done.append((opened, pos, len(stack) + 1, name))
        if end:
            continue
        if alone:
            done.append((pos, pos, len(stack) + 1, tag))
        else:
            stack.append((pos, tag))
    while stack:
        opened, name = stack.pop()
        done.append((opened, len(heads) + 1, len(stack) + 1, name))
    return sorted(done)


def _lists(values: pa.Array, sizes: list[int], nulls: list[bool]) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(nulls, pa.bool_()))


class _Heads(dict):
    """Token -> its ``<name`` or ``</name`` with a ``/`` if it ends with one, '' for what is no tag."""

    name = re.compile(r"</?[a-zA-Z][^\s/>]*+", re.ASCII)

    def __missing__(self, token: str) -> str:
        found = self.name.match(token) if token != "<" else None
        head = "" if found is None else found[0] + "/" * token.endswith("/>")
        self[token] = head
        return head


def _slice(pages: list, find, void: frozenset, rules: dict) -> pa.Array:
    tokens, sizes, nulls, which = [], [], [], []
    alike: dict[str, int] = {}
    known = _Heads()
    for page in pages:
        found = find(page) if page else []
        heads = [known[t] if t[0] == "<" else "" for t in found]
        tokens.extend(found)
        sizes.append(len(found))
        nulls.append(page is None)
        which.append(alike.setdefault(" ".join(heads) if found else "none", len(alike)))
    els = [nest(key.split(" ") if key != "none" else [], void, rules) for key in alike]
    flat = [e for one in els for e in one]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
    struct = pa.StructArray.from_arrays([pa.array([e[i] for e in flat], t) for i, t in enumerate(kinds)], names=["open", "close", "depth", "tag"])
    numbered = _lists(struct, [len(one) for one in els], [False] * len(els))
    taken = numbered.take(pa.array([None if n else w for n, w in zip(nulls, which)], pa.int32()))
    return pa.StructArray.from_arrays([_lists(pa.array(tokens, pa.string()), sizes, nulls), taken], names=["tokens", "els"])


def scanner(token_rx: str, void: frozenset, rules: dict):
    """The function of a column of pages; a few hundred of them at a time bound what a task holds."""
    def run(html: pa.Array) -> pa.Array:
        find = re.compile(token_rx, re.ASCII).findall
        parts = [_slice(html.slice(lo, PAGES_AT_ONCE).to_pylist(), find, void, rules) for lo in range(0, max(len(html), 1), PAGES_AT_ONCE)]
        return pa.concat_arrays(parts)

    return run
