"""URL scalars."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from regesto.functions._util import col_of, let, nz


def absolutise(href, base: str) -> Column:
    """URL-1: keep an ``http`` href, else prefix the base."""
    h = col_of(href)
    return F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(base), h))


def remove_dots(path: Column) -> Column:
    """RFC 3986 5.2.4 on a path that starts with '/': '.' goes, '..' takes the segment before it
    (and nothing at the root)."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)

    def step(acc, seg):
        return F.when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(seg == ".", acc).otherwise(
            F.concat(acc, F.array(seg))
        )

    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts) - 1), F.array().cast("array<string>"), step)
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    return F.when(F.contains(path, F.lit("/.")) & path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.when(joined == "//", F.lit("/")).otherwise(joined)).otherwise(path)


def url_join(base, href) -> Column:
    """URL-2: RFC 3986 reference resolution.

    absolute (has a scheme) -> as is; ``//host`` -> base scheme; ``/path`` -> base origin + path;
    ``?query`` -> base path + query; ``#frag`` -> base without fragment + fragment; relative ->
    base directory + path; dot segments of the path are removed, to any depth.
    """
    h = col_of(href)
    return let(base_parts(col_of(base) if not isinstance(base, str) else F.lit(base)), lambda b: let(h, lambda x: resolve(b, x)))


def base_parts(b: Column) -> Column:
    """What ``resolve`` needs of a base address: found once for all links of a page."""
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    base_path = F.substr(no_query, F.length(origin) + 1)
    directory = F.concat(F.lit("/"), F.regexp_extract(base_path, r"^/?(.*/)?[^/]*$", 1))
    return F.struct(scheme.alias("scheme"), origin.alias("origin"), no_frag.alias("no_frag"), no_query.alias("no_query"), directory.alias("directory"))


def resolve(b: Column, h: Column) -> Column:
    """``url_join`` from the parts of the base."""
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)

    def joined(own):
        path = F.when(h.startswith("/"), own).otherwise(F.concat(b["directory"], own))
        return let(path, lambda p: F.concat(b["origin"], remove_dots(p), F.substr(h, F.length(own) + 1)))

    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(b["scheme"], F.lit(":"), h))
        .when(h.startswith("?"), F.concat(b["no_query"], h))
        .when(h.startswith("#"), F.concat(b["no_frag"], h))
        .when(h == "", b["no_frag"])
        .otherwise(let(h_path, joined))
    )


def query_param(url, key: str, default: str | None = None) -> Column:
    """URL-3: named query value (first occurrence, percent-decoded, '+' as a space); a blank or
    absent one gives ``default``."""
    query = F.regexp_extract(col_of(url), r"\?([^#]*)", 1)
    raw = nz(F.regexp_extract(query, rf"(?:^|&){re.escape(key)}=([^&]*)", 1))
    v = F.coalesce(F.try_url_decode(raw), raw)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def url_dir(url) -> Column:
    """URL-4: drop the part after the last '/'."""
    return F.regexp_replace(col_of(url), r"[^/]*$", "")


def year_num_from_url(url) -> Column:
    """URL-5: ``lr(yyyy)-(n)`` to struct(year, num); no match sorts last as (9999, 9999)."""
    u = col_of(url)
    y = nz(F.regexp_extract(u, r"lr(\d{4})-(\d+)", 1)).cast("int")
    n = nz(F.regexp_extract(u, r"lr(\d{4})-(\d+)", 2)).try_cast("int")  # a long digit run is no number
    return F.struct(F.coalesce(y, F.lit(9999)).alias("year"), F.coalesce(n, F.lit(9999)).alias("num"))


def is_script_link(href) -> Column:
    """URL-6 predicate: empty, NULL or ``javascript`` href."""
    h = col_of(href)
    return h.isNull() | (F.trim(h) == "") | F.lower(h).contains("javascript")


def drop_script_links(df, href: str = "href"):
    """URL-6: remove rows whose href is empty or a ``javascript:`` link."""
    return df.filter(~is_script_link(href))
