"""Listing loops over captured pages against loops in plain Python."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regesto.operators import cutoffs as C
from regesto.operators import traversal as V
from regesto.plans import flows as FL


def loop(start, nexts, cap):
    """The pages that a script opens from ``start``, and why it ends."""
    seen, at = [], start
    while True:
        seen.append(at)
        to = nexts[at]
        if to is None:
            return seen, "last"
        if to not in nexts:
            return seen, "missing"
        if len(seen) == cap:
            return seen, "cap"
        if to in seen:
            return seen, "cycle"
        at = to


@pytest.mark.parametrize("cap", [1, 7, 8, 100, None])
def test_walks_match_the_loop(spark, cap):
    rng = random.Random(cap or 0)
    nexts = {}
    for chain in range(12):
        n = rng.choice([1, 2, 5, 8, 9, 40])
        for k in range(n):
            nexts[f"{chain}/{k}"] = f"{chain}/{k + 1}" if k + 1 < n else rng.choice([None, "gone", f"{chain}/{rng.randrange(n)}", "0/0"])
    starts = [(str(c), f"{c}/0") for c in range(12)] + [("x", "5/0"), ("y", "3/0"), ("none", "never"), ("x", "5/0")]
    got = V.walk(spark.createDataFrame(starts, "source string, url string"), spark.createDataFrame(list(nexts.items()), "url string, next string"), cap)
    want = []
    for source, url in sorted(set(starts)):
        if url in nexts:
            pages, stop = loop(url, nexts, cap or 10**9)
            want += [(source, k, u, stop if k == len(pages) else None) for k, u in enumerate(pages, 1)]
    assert sorted(rows(got), key=str) == sorted(want, key=str)


def test_a_walk_of_nothing(spark):
    none = spark.createDataFrame([], "source string, url string")
    assert V.walk(none, spark.createDataFrame([("a", None)], "url string, next string"), 5).count() == 0
    assert V.walk(spark.createDataFrame([("s", "a")], "source string, url string"), spark.createDataFrame([], "url string, next string")).count() == 0


def test_next_links_by_text_and_class(spark):
    base = "https://piemonte.example/"
    page = lambda laws, more="": "".join(f"<a class='x dettaglio' href='dettaglioLegge.do?id={k}'>L</a>" for k in laws) + "<a href='dettaglioLegge.do?id=99'>no</a><a href='/a'> » altro</a>" + more
    nxt = lambda k: f"<a href='elencoLeggi.do?anno=2020&amp;pag={k}'>\n»\n</a>"
    listing = [(f"{base}elencoLeggi.do?anno=2020&pag={k}", page(laws, more)) for k, (laws, more) in enumerate([([1, 2], nxt(2)), ([2, 3], nxt(3)), ([3, 1], nxt(4)), ([4], "")], 1)]
    listing.append((base + "elencoLeggi.do?anno=2019", page([7])))
    starts = spark.createDataFrame([(base + "indice", "<a href='elencoLeggi.do?anno=2020&pag=1'> 2020 </a><a href='elencoLeggi.do?anno=2019'>2019</a><a href='elencoLeggi.do?anno=2018'>Anno 2018</a>")], "url string, html string")
    pages, links = FL.walk_listing("piemonte", starts, spark.createDataFrame(listing, "url string, html string"))
    assert sorted(rows(pages, "source", "page_no", "stop"), key=str) == [("2019", 1, "last"), ("2020", 1, None), ("2020", 2, None), ("2020", 3, None), ("2020", 4, "last")]
    # the third page has no new law: the loop ends there
    assert sorted((s, n, u.rsplit("=", 1)[1]) for s, n, u in rows(links, "source", "page_no", "url")) == [("2019", 1, "7"), ("2020", 1, "1"), ("2020", 1, "2"), ("2020", 2, "3")]


def test_a_pager_ends_where_no_later_page_is_offered(spark):
    pages = [("a", 1, "<a>2</a>"), ("a", 2, "<a>1</a><a>...</a>"), ("a", 3, "<a>...x</a><a>2</a>"), ("a", 4, "<a>5</a>"), ("b", 1, None), ("b", 2, "<a>3</a>"), ("c", 1, "<a>2</a>")]
    df = spark.createDataFrame([(s, n, f"https://taa.example/{s}/{n}", h) for s, n, h in pages], "source string, page_no int, url string, html string")
    got = FL.walked_pages("trentino", df)
    assert sorted(rows(got, "source", "page_no")) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1)]
    stop = spark.createDataFrame([(None, 1, False), (None, 2, True)], "source string, page_no int, has_next boolean")
    assert rows(C.cut_after_last_page(stop, stop, "source", "page_no"), "page_no") == [(1,)]


def test_a_year_tree_gives_a_law_to_the_first_year_that_shows_it(spark):
    a = lambda *ids: "".join(f"<a href='articolo?urndoc=legge:{k}'>L{k}</a>" for k in ids)
    starts = spark.createDataFrame([(0, "https://toscana.example/", "<a>2021</a><a>2020</a><a>2019</a><a>Indice</a>")], "tree int, url string, html string")
    snaps = spark.createDataFrame([(0, y, "https://toscana.example/", h) for y, h in [(2021, a(1, 2)), (2020, a(1, 2, 3)), (2018, a(9))]], "tree int, year int, url string, html string")
    details = spark.createDataFrame([(k, f"https://toscana.example/articolo?urndoc=legge:{k}", f"<div id='titolo_doc'>T{k}</div><p>n. {k} del 08/01/2020</p>") for k in (1, 2, 3, 9)], "page_id int, url string, html string")
    got = FL.index_tree("toscana", starts, snaps, details)
    assert sorted(rows(got, "law_title", "page_no")) == [("T1", 2021), ("T2", 2021), ("T3", 2020)]


def test_lombardy_opens_the_first_link_of_each_year(spark):
    start = "<a class='nodo treelink' href='/l?anno=2020'>Anno 2020 (3)</a><a class='treelink' href='/l?anno=b'>2020</a><a class='x' href='/l?anno=2019'>2019</a><a class='treelinkselected' href='/l?anno=1969'>1969</a>"
    law = "<a href='/w?view=showdoc&iddoc={0}'>Legge regionale {0} luglio 2020, n. {0}</a>"
    base = "https://lombardia.example"
    listing = [(k, base + u, law.format(k)) for k, u in enumerate(["/l?anno=2020", "/l?anno=b", "/l?anno=2019", "/l?anno=1969"], 1)]
    got = FL.index_years(spark.createDataFrame([(base + "/albero", start)], "url string, html string"), spark.createDataFrame(listing, "page_id int, url string, html string"))
    assert rows(got, "law_number") == [("1",)]


def test_marche_categories(spark):
    base = "https://marche.example/"
    starts = spark.createDataFrame([(base + "i.php", "<a href='classificazioni.php?arc=vig&amp;cat=1'>Uno</a><a href='altro.php'>x</a>")], "url string, html string")
    law = "<a href='dettaglio.php?arc=vig&amp;id={}'>L</a>"
    cat = base + "classificazioni.php?arc=vig&cat=1"
    listing = [(cat, law.format(1) + "<a href='classificazioni.php?arc=vig&amp;cat=1&amp;page=2'>2</a>"), (cat + "&page=2", law.format(2) + law.format(1)), (cat + "&page=3", law.format(3))]
    details = [(k, base + f"dettaglio.php?arc=vig&id={k}", f"<h1>T{k}</h1><p>n. {k}</p>") for k in (1, 2, 3)]
    got = FL.index_categories(starts, spark.createDataFrame(listing, "url string, html string"), spark.createDataFrame(details, "page_id int, url string, html string"))
    assert sorted(rows(got.withColumn("t", F.col("law_title")), "t", "page_no")) == [("T1", 0), ("T2", 2)]


def test_aosta_walks_its_whole_listing(spark):
    """Sixty pages of one law each: no page limit cuts them, the first page without news ends the walk."""
    law = lambda k: f"<a href='dettaglio?pk_lr={k}'>3 marzo 2001, n. {k}</a><p class='elemento_lista_paginata_banche_dati'>Titolo {k}</p>"
    shown = {**{p: p for p in range(1, 61)}, 61: 60, 62: 62}  # page 61 shows a law again
    pages = [(p, f"https://aosta.example/elenco?page={p}", f"<html><body>{law(k)}</body></html>") for p, k in shown.items()]
    listing = spark.createDataFrame(pages, "page_no int, url string, html string")
    details = spark.createDataFrame([("https://aosta.example/dettaglio?pk_lr=7", "Legge (abrogata dall’art. 1)")], "url string, html string")
    got = {int(r["law_number"]): r["page_no"] for r in FL.index_listing("aosta", listing, details).collect()}
    assert got == {k: k for k in range(1, 61) if k != 7}


def test_pages_are_dealt_by_their_number(spark, tmp_path):
    """A task makes and reads a bounded number of pages, and a listing is not left to one task."""
    from regesto.plans import q_walks as W
    from regesto.sources.fixtures import PAGES_PER_TASK, many

    cores = spark.sparkContext.defaultParallelism
    rows_ = (cores + 2) * PAGES_PER_TASK
    spark.range(rows_).coalesce(1).write.parquet(str(tmp_path / "big"))
    assert many(spark.read.parquet(str(tmp_path / "big"))).rdd.getNumPartitions() == 2 * cores
    for region in ("molise", "trentino"):
        listing = W._listing(spark, "/root/testdata/sf0.01", region)
        sizes = listing.select("html").rdd.mapPartitions(lambda rs: [sum(1 for _ in rs)]).collect()
        assert len(sizes) >= cores and max(sizes) < sum(sizes) / 2


def test_anchor_attributes_one_by_one(spark):
    """Of two with one name the first counts, also without a value; a name inside another is none."""
    from regesto.functions import html as H

    html = """<a data-href="/no" HREF='/a?x=1&amp;y=2' href="/second" title=t>A</a><a href title="href=/x" href="/no">B</a><a class="x y"name=n>C</a><a href="/d"class=k>D</a>"""
    got = H.extract_anchors(spark.createDataFrame([(1, html)], "page_id int, html string"), keep=("page_id",)).orderBy("pos")
    assert rows(got, "href", "text", "title", "cls") == [("/a?x=1&y=2", "A", "t", None), (None, "B", "href=/x", None), (None, "C", None, "x y"), ("/d", "D", None, "k")]


def test_aosta_meets_a_law_on_its_first_page(spark):
    """Links to a law that come again on a page, on a later one or in another listing add nothing; what only one of
    the two readings of a page shows (hidden or unclosed links) is no record."""
    law = lambda k, more="": f"<a href='dettaglio?pk_lr={k}'>3 marzo 2001, n. {k}</a>{more}<p class='elemento_lista_paginata_banche_dati'>Titolo {k}</p>"
    again = "<a href='dettaglio?pk_lr=1'>Aggiornamento</a>"
    pages = [
        ("a", 1, law(1, again) + law(2) + again + "<p class='elemento_lista_paginata_banche_dati'>Altro</p>"),
        ("a", 2, law(1) + law(3, "<noscript><a href='dettaglio?pk_lr=9'>n. 9</a></noscript>")),
        ("a", 3, law(2) + law(3)),  # no news: the walk ends before it
        ("a", 4, law(4)),
        ("b", 1, law(1)),  # all met in another listing, so never read
        ("b", 2, law(5) + "<a href='dettaglio?pk_lr=6'>n. 6" + law(7)),
    ]
    listing = spark.createDataFrame([(s, n, f"https://aosta.example/elenco?s={s}&page={n}", h) for s, n, h in pages], "source string, page_no int, url string, html string")
    details = spark.createDataFrame([("https://aosta.example/dettaglio?pk_lr=2", "(Abrogata dall’art. 1)")], "url string, html string")
    met = {int(r["url"].rsplit("=", 1)[1]): (r["source"], r["page_no"]) for r in FL.first_pages("aosta", listing).collect()}
    assert met == {1: ("a", 1), 2: ("a", 1), 3: ("a", 2), 9: ("a", 2), 5: ("b", 2), 6: ("b", 2)}
    got = {r["source_url"].rsplit("=", 1)[1]: (r["law_title"], r["page_no"]) for r in FL.index_listing("aosta", listing, details).collect()}
    assert got == {"1": ("Titolo 1", 1), "3": ("Titolo 3", 2), "5": ("Titolo 5", 2), "6": ("n. 63 marzo 2001, n. 7 Titolo 7", 2)}


def test_aosta_reads_a_page_part_once(spark):
    """The details are dealt before they are read, a text is folded once for all phrases, a base is parsed once for a
    page's links, and of a page's links to one law the first alone becomes a row with texts."""
    from regesto.functions import elements as E
    from regesto.operators import filters as P
    from regesto.plans import q_walks as W
    from regesto.plans import regions as RG

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    details = W._details(spark, "/root/testdata/sf0.01", "aosta")
    asked = details.filter(P.is_repealed_phrase("html"))
    assert asked.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and plan(asked).index("Filter") < plan(asked).index("Repartition")
    one = spark.createDataFrame([("t",)], "t string")
    assert plan(one.select(P.is_repealed_phrase("t").alias("gone"))).count("translate(") == 1
    p = spark.createDataFrame([(1, "https://a.example/x/r?page=1", "<a href='dettaglio?pk_lr=1'>Uno</a><p class='elemento_lista_paginata_banche_dati'>A</p>" * 50 + "<a href='dettaglio?pk&#95;lr=1'>Due</a>")],
                              "page_id long, url string, html string")
    laws = p.select(E.once(E.scan("html")).alias("page")).select(E.first_holding("page", "a", "href", RG.AOSTA_LINK).alias("x")).first()["x"]
    assert [(x["e"]["open"], x["value"]) for x in laws] == [(1, "dettaglio?pk_lr=1")]
    assert [(r["law_title"], r["source_url"]) for r in RG.extract_aosta(p).collect()] == [("A", "https://a.example/x/dettaglio?pk_lr=1")]
