"""Derived test views over the driver tables.

Each view is ONE SQL text that Spark and DuckDB both run unchanged, so a
``queries()`` entry can be checked against an oracle that reads the expected
values straight from the source columns.  Spark resolves the view names at
analysis time, so a DataFrame built here keeps its plan even if another
``sf_dir`` is registered later in the same session.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Italian month names in calendar order (shared by the views).
IT_MONTHS_CSV = "gennaio,febbraio,marzo,aprile,maggio,giugno,luglio,agosto,settembre,ottobre,novembre,dicembre"

_IT = f"split_part('{IT_MONTHS_CSV}', ',', month(o_orderdate))"
_NO = "cast(o_orderkey % 200 + 1 as string)"
_DAY = "cast(day(o_orderdate) as string)"
_YEAR = "cast(year(o_orderdate) as string)"
_DMY = (
    "concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '/', "
    "lpad(cast(month(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string))"
)

VIEW_SQL: dict[str, str] = {
    "law_headers": f"""
SELECT o_orderkey AS law_id,
       concat('R', lpad(cast(o_custkey % 18 as string), 2, '0')) AS region,
       cast(o_orderdate as date) AS d,
       cast(o_orderkey % 200 + 1 as int) AS no,
       CASE o_orderkey % 4
         WHEN 0 THEN concat('Legge regionale ', {_DAY}, ' ', {_IT}, ' ', {_YEAR}, ', n. ', {_NO})
         WHEN 1 THEN concat('Legge regionale n. ', {_NO}, ' del ', {_DMY})
         WHEN 2 THEN concat('Legge regionale ', {_DAY}, '° ', {_IT}, ' ', {_YEAR}, ', n. ', {_NO})
         ELSE 'Testo senza estremi'
       END AS hdr
FROM orders""",
    "listing": """
SELECT l_orderkey % 400 AS page_no,
       cast(row_number() OVER (PARTITION BY l_orderkey % 400
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as int) AS pos,
       concat('https://x.example/dettaglio?pk_lr=', cast(l_partkey as string)) AS url
FROM lineitem""",
    "probe_grid": """
SELECT cast(1992 + o_orderkey % 7 as int) AS y,
       cast((o_orderkey - o_orderkey % 7) / 7 + 1 as int) AS n,
       o_orderstatus = 'P' AS found
FROM orders""",
    "fetch_log": """
SELECT user_id AS k, event_id, ts,
       cast(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) as int) AS attempt,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'view' THEN 'Skipped' ELSE 'Downloaded' END AS status
FROM events""",
    # up to four attempts per key, in time order; some keys have fewer and no final one
    "attempt_log": """
SELECT cast(floor(event_id / 4) as bigint) AS k, cast(event_id % 4 + 1 as int) AS attempt,
       CASE event_type WHEN 'view' THEN 'Skipped' WHEN 'purchase' THEN 'Downloaded' ELSE 'Failed' END AS status,
       cast(event_id * 7 % 5 as int) AS page_no, event_id, cast(ts as timestamp) AS ts
FROM events WHERE event_id % 4 <= floor(event_id / 4) % 4""",
    "repeal_text": """
SELECT doc_id,
       concat(text, CASE doc_id % 5
                      WHEN 0 THEN ' ( Abrogata )'
                      WHEN 1 THEN ' è abrogata'
                      WHEN 2 THEN ' (abrogata dall’art. 3'
                      WHEN 3 THEN ' Abrogazioni'
                      ELSE '' END) AS body
FROM documents""",
    "law_docs": """
SELECT l_orderkey AS law_id, l_linenumber AS pos,
       concat('https://x.example/doc/', cast(l_orderkey as string), '_', cast(l_linenumber as string),
              CASE l_linenumber % 3 WHEN 0 THEN '_it.pdf' WHEN 1 THEN '_de.pdf' ELSE '.pdf' END) AS href
FROM lineitem""",
}

_D_DMY = (
    "concat(lpad(cast(day(d) as string), 2, '0'), '/', lpad(cast(month(d) as string), 2, '0'), '/', "
    "cast(year(d) as string))"
)

# One detail page per law header (base markup, invented).  Expected values sit in
# law_headers' columns, so an oracle never parses HTML.
VIEW_SQL["law_pages"] = f"""
SELECT law_id AS page_id,
       concat('https://leggi.example/dettaglio?id=', cast(law_id as string)) AS url,
       concat('<html><head><title>Legge ', cast(law_id as string), '</title></head><body>',
              '<h1>', hdr, '</h1>Testo introduttivo ', cast(law_id as string),
              '<div id="titoloAtto">Titolo ', cast(law_id as string), '<div class="bur">BUR 1</div></div>',
              '<p><strong>Numero della legge:</strong> ', cast(no as string), '</p>',
              '<p><strong>Data BUR:</strong> 01/01/2000</p>',
              '<p><strong>Data:</strong> ', {_D_DMY}, '</p>',
              '<table><tr><th>Numero</th><th>Data</th><th>Titolo</th><th></th></tr>',
              '<tr><td>n. ', cast(no as string), '</td><td>', {_D_DMY}, '</td>',
              '<td>Disposizioni per la legge numero ', cast(no as string), ' della regione ', region, '</td>',
              '<td><button>Seleziona</button></td></tr></table>',
              '<div class="download-list"><a href="/doc/', cast(law_id as string), '_it.pdf">Testo IT</a>',
              '<a href="/doc/', cast(law_id as string), '_de.pdf">Text DE</a></div>',
              '<p><a href="/allegato.pdf">Allegato</a></p></body></html>') AS html
FROM law_headers"""

# views that other views read (in dependency order)
VIEW_DEPS: dict[str, tuple[str, ...]] = {"law_pages": ("law_headers",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read lazily (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in VIEW_DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


#: Pages that one task makes and reads.
PAGES_PER_TASK = 50_000


def tasks(df: DataFrame) -> int:
    """Tasks for the pages made of a scan's rows: one per core, or as many rounds of that as the table needs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-df.count() // (cores * PAGES_PER_TASK)))


def many(df: DataFrame) -> DataFrame:
    """A scan in as many partitions as its rows need.  These tables come as one file of few row groups,
    each of which one task reads; a table of more splits is left as it lies."""
    n = tasks(df)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores: so few that one task would get them all."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a derived view as a Spark DataFrame from the shared SQL text.

    Pages are made after their source columns have been dealt out, so no page is shuffled."""
    deps = _closure([name])
    text = " ".join(VIEW_SQL[n] for n in deps)
    for t in BASE_TABLES:
        if re.search(rf"\b{t}\b", text):
            base = table(spark, sf_dir, t)
            (many(base.select(*_columns(base, text))) if "pages" in name else base).createOrReplaceTempView(t)
    for n in deps[:-1]:
        spark.sql(VIEW_SQL[n]).createOrReplaceTempView(n)
    return spark.sql(VIEW_SQL[name])


def _columns(df: DataFrame, text: str) -> list[str]:
    """The columns that the SQL names: only those are dealt out."""
    return [c for c in df.columns if re.search(rf"\b{c}\b", text)]


def with_views(names, body: str) -> str:
    """Oracle SQL: the views as CTEs ahead of ``body`` (DuckDB has only the base tables)."""
    ctes = [f"{n} AS ({VIEW_SQL[n]})" for n in _closure(names)]
    if not ctes:
        return body
    head = body.lstrip()
    if head[:5].upper() == "WITH ":  # merge the body's own CTEs after the views
        return "WITH " + ",\n".join(ctes) + ",\n" + head[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
