"""Tree repair of the one Arrow pass, dom selectors, and golden region pages."""

import datetime as dt

from conftest import SF001
from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import html as H
from regesto.functions import urls as U
from regesto.functions._dom import parse_html
from regesto.functions.text import norm_ws
from regesto.plans import regions as RG


def test_parse_html_repairs_tree():
    dom = parse_html(
        "<html><head><title>T</title><script>var x='<p>no</p>';</script><style>p{}</style></head><body>"
        "<h1 id=a class='x y'>Head &amp; more</h1>after<p>one<p>two<br>three"
        "<ul><li>a<li>b</ul><table><tr><th>h<tr><td>c1<td><input type=button>c2</table>"
        "<!-- c --><div class=outer>keep<div class=bur>drop</div></div><p><strong>Data:</strong> 1/2/2003</p></body></html>"
    )
    assert dom["title"] == "T"
    assert "no" not in dom["text"] and "var" not in dom["text"]
    assert dom["headings"][0]["text"] == "Head & more" and dom["headings"][0]["next_text"] == "after"
    assert [p["text"] for p in dom["paras"]][:2] == ["one", "two three"]
    assert dom["items"] == ["a", "b"]
    cells = [(c["row"], c["col"], c["text"], c["has_button"], c["is_header"]) for c in dom["cells"]]
    assert cells == [(1, 1, "h", False, True), (2, 1, "c1", False, False), (2, 2, "c2", True, False)]
    outer = [b for b in dom["blocks"] if b["cls"] == "outer"][0]
    assert outer["text"] == "keep drop" and outer["clean_text"] == "keep"
    assert dom["labels"][0] == {"label": "Data:", "block_text": "Data: 1/2/2003"}


def test_regex_forms(spark):
    pages = spark.createDataFrame(
        [(1, "https://a.example/x/y.html",
          '<html lang="it"><h1> Titolo <b>uno</b></h1><a href="/p1" title="T1">Uno</a> <a class="z" href=\'q.pdf\'>Due &amp; tre</a>'
          '<a href="javascript:void(0)">js</a><script>x</script></html>')], "page_id long, url string, html string")
    links = [(r["pos"], r["href"]) for r in H.extract_links(pages).collect()]
    assert links == [(1, "/p1"), (2, "q.pdf"), (3, "javascript:void(0)")]
    an = [(r["href"], r["text"], r["title"]) for r in H.extract_anchors(pages).collect()]
    assert an[:2] == [("/p1", "Uno", "T1"), ("q.pdf", "Due & tre", None)]
    row = pages.select(H.element_text("html", "h1").alias("h1"), H.attr_regex("html", "html", "lang", "^([a-z]+)").alias("lang"),
                       H.page_text("html").alias("t")).first()
    assert row["h1"] == "Titolo uno" and row["lang"] == "it" and "x" not in row["t"].split()


def test_url_join(spark):
    cases = [
        ("https://a.example/b/c.html?x=1", "d.html", "https://a.example/b/d.html"),
        ("https://a.example/b/c.html", "../d.html", "https://a.example/d.html"),
        ("https://a.example/b/c.html", "/e", "https://a.example/e"),
        ("https://a.example/b/c.html", "//cdn.example/f", "https://cdn.example/f"),
        ("https://a.example/b/c.html", "?p=2", "https://a.example/b/c.html?p=2"),
        ("https://a.example/b/c.html", "http://z.example/", "http://z.example/"),
        ("https://a.example", "x", "https://a.example/x"),
        ("https://a.example/b/c.html#top", "#s", "https://a.example/b/c.html#s"),
    ]
    df = spark.createDataFrame(cases, "b string, h string, want string")
    got = df.select(U.url_join(F.col("b"), F.col("h")).alias("g"), "want").collect()
    assert [r["g"] for r in got] == [r["want"] for r in got]


def _pages(spark, url, html):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_golden_liguria(spark):
    p = _pages(spark, "https://l.example/articolo?id=9",
               "<h1>Norme sul paesaggio</h1><div>Legge regionale 8 gennaio 2025, n. 3</div>")
    r = RG.extract_liguria(p).first()
    assert (r["law_title"], r["law_number"], r["law_date"], r["date_text"], r["filename"]) == (
        "Norme sul paesaggio", "3", dt.date(2025, 1, 8), "8 January 2025", "Liguria_3_2025-01-08.pdf")


def test_golden_lazio(spark):
    p = _pages(spark, "https://x.example/leggiregionalidettaglio?id=44",
               "<h2>Legge di bilancio</h2><p><strong>Numero della legge:</strong> 19</p>"
               "<p><strong>Data BUR:</strong> 1/1/2026</p><p><strong>Data:</strong> 9 dicembre 2025</p>")
    r = RG.extract_lazio(p).first()
    assert (r["law_title"], r["law_number"], r["date_text"], r["filename"]) == (
        "Legge di bilancio", "19", "9 dicembre 2025", "Lazio_19_9 dicembre 2025.pdf")


def test_golden_sardinia_and_emilia(spark):
    p = _pages(spark, "https://s.example/leggi",
               '<p><a href="/a.pdf">Legge regionale 1° dicembre 2025, n. 33</a> testo</p>'
               '<div><a href="/b.pdf">Legge regionale n. 34 del 2 dicembre 2025</a></div><a href="/c.pdf">Allegato</a>')
    got = sorted((r["law_number"], r["law_date"], r["law_title"]) for r in RG.extract_sardinia(p).collect())
    assert got == [("33", dt.date(2025, 12, 1), "Legge regionale 1° dicembre 2025, n. 33 testo"),
                   ("34", dt.date(2025, 12, 2), "Legge regionale n. 34 del 2 dicembre 2025")]
    e = _pages(spark, "https://e.example/r",
               '<a class="hitelement_button" title="Accedi al documento Legge regionale 25 luglio 2025, n.9" href="/d/1">x</a>')
    r = RG.extract_emilia(e).first()
    assert (r["law_number"], r["date_text"], r["filename"]) == ("9", "25 luglio 2025", "Emilia-Romagna_9_2025-07-25.pdf")


def test_golden_basilicata_and_piemonte(spark):
    b = _pages(spark, "https://b.example/elenco",
               "<table><tr><td>7</td><td><input type='image' src='Btn_Selezione.png'></td></tr></table>"
               "<table id='x_GVElenco'><tr><th>N</th><th>D</th><th>T</th><th></th></tr>"
               "<tr><td>n. 50</td><td>03/04/2020</td><td>Disciplina delle acque minerali</td><td><input type='image' src='Btn_Selezione.png'></td></tr>"
               "<tr><td>senza bottone</td></tr></table>")
    r = RG.extract_basilicata(b).collect()
    assert len(r) == 1 and (r[0]["law_number"], r[0]["date_text"], r[0]["law_title"]) == ("50", "03/04/2020", "Disciplina delle acque minerali")
    pm = spark.createDataFrame(
        [(1, "https://p.example/dettaglioLegge.do?id=1",
          '<div id="titoloAtto">Titolo vero<div class="bur">BUR 3</div></div><span class="lead">Legge regionale del 5 marzo 2021, n. 4</span>'),
         (2, "https://p.example/dettaglioLegge.do?id=2", '<div id="titoloAtto">Abrogata</div><p>( Abrogata )</p>'),
         (3, "https://p.example/dettaglioLegge.do?id=3", '<div id="titoloAtto">Piccola</div>')],
        "page_id long, url string, html string")
    got = [(r["law_title"], r["law_number"], r["law_date"]) for r in RG.extract_piemonte(pm).collect()]
    assert sorted(got, key=str) == [("Piccola", "Unknown", None), ("Titolo vero", "4", dt.date(2021, 3, 5))]
    saved = pm.withColumn("pdf", F.when(F.col("page_id") == 1, F.repeat(F.lit("x"), 2001)).otherwise(F.lit("x")).cast("binary"))
    assert [r["law_title"] for r in RG.extract_piemonte(saved, payload="pdf").collect()] == ["Titolo vero"]


def test_neighbour_and_text_without(spark):
    pages = spark.createDataFrame(
        [(1, "u", '<h1>H</h1> dopo <div id="t">Titolo<div class="bur">BUR</div></div>'
                  '<p>padre <a href="dettaglio?pk_lr=1">link</a></p><p class="desc">descrizione</p>')],
        "page_id long, url string, html string")
    dom = H.parse_dom(pages)
    r = dom.select(H.neighbour_text("dom", "next_text").alias("n"), H.text_without("dom", id_="t").alias("t"),
                   H.neighbour_text("dom", "parent", href_rx="pk_lr").alias("p"),
                   H.neighbour_text("dom", "next_para", href_rx="pk_lr").alias("q")).first()
    assert (r["n"], r["t"], r["p"], r["q"]) == ("dopo", "Titolo", "padre link", "descrizione")


def test_golden_trentino_documents(spark):
    p = _pages(spark, "https://t.example/content/view/full/7",
               "<h1>Legge regionale 3 maggio 2018, n. 7</h1> Ordinamento dei comuni della regione"
               '<div class="row"><strong class="text-nowrap">03.05.2018</strong></div>'
               '<div class="download-list"><a href="/d/7_it.pdf">IT</a><a href="/d/7_st.pdf">DE</a></div>'
               '<a href="/altro.pdf">ignored while the list has links</a>')
    got = sorted((r["doc_type"], r["filename"], r["law_title"]) for r in RG.extract_trentino(p).collect())
    assert got == [("DE", "TrentinoAA_7_2018-05-03_DE.pdf", "Ordinamento dei comuni della regione"),
                   ("IT", "TrentinoAA_7_2018-05-03_IT.pdf", "Ordinamento dei comuni della regione")]


def test_golden_aosta(spark):
    p = _pages(spark, "https://a.example/ricerca?anno=2023&page=1",
               '<a href="dettaglio?pk_lr=11">15° gennaio 2023, n. 12</a><p class="elemento_lista_paginata_banche_dati">Norme sul turismo</p>'
               '<a href="dettaglio?pk_lr=12">Legge senza data</a><p class="elemento_lista_paginata_banche_dati">Altre norme</p>'
               '<a href="dettaglio?pk_lr=13">3 marzo 2020, numero 5</a><p class="elemento_lista_paginata_banche_dati">Vecchia (abrogata dall’art. 2)</p>')
    got = sorted((r["law_number"], r["date_text"], r["filename"]) for r in RG.extract_aosta(p).collect())
    assert got == [("0", "Unknown", "ValleAosta_ID_12.pdf"), ("12", "15 gennaio 2023", "ValleAosta_12_2023-01-15.pdf")]


def test_golden_marche_and_umbria(spark):
    m = _pages(spark, "https://m.example/dettaglio.php?arc=vig&id=1",
               "<table><tr><td>Oggetto</td><td> Tutela delle acque </td></tr></table><p>Legge regionale 12 marzo 2019, n. 4</p>")
    r = RG.extract_marche(m).first()
    assert (r["law_title"], r["law_number"], r["date_text"], r["filename"]) == (
        "Tutela delle acque", "4", "12 marzo 2019", "Marche_4_12-marzo-2019.pdf")
    u = _pages(spark, "https://u.example/mostra_atto.php?id=1&file=lr2025-99.html",
               "<table><tr><td>2025</td><td>Disposizioni per la montagna umbra</td></tr></table><h2>Legge regionale 9 dicembre 2025</h2>")
    assert RG.extract_umbria(u).first()["law_number"] == "Unknown"  # the page's own URL tells nothing
    r = RG.extract_umbria(u.withColumn("link_text", F.lit("L.R. 2025-33."))).first()
    assert (r["law_title"], r["law_number"], r["law_date"]) == ("Disposizioni per la montagna umbra", "33", dt.date(2025, 12, 9))


def test_golden_friuli_molise_puglia(spark):
    f = _pages(spark, "https://f.example/IndiceLex.aspx?id=1",
               '<a href="Lista.aspx?materia=5">Ambiente</a><span id="lblData_1">25 marzo 1968</span>'
               '<span id="PageBody_lbOggettolegge">Norme per la caccia</span><span id="PageBody_lbNumLegge">12</span>'
               '<a href="/d/1.pdf">PDF</a>')
    r = RG.extract_friuli(f).first()
    assert (r["category"], r["law_number"], r["date_text"], r["filename"], r["status"]) == (
        "Ambiente", "12", "25/03/1968", "FVG_12_25-03-1968.pdf", "Success")
    m = _pages(spark, "https://mo.example/OpenDocument?id=1",
               "<h3>Legge regionale 12 gennaio 2023, n. 3</h3><p>Testo coordinato delle norme per il sostegno alle imprese</p>")
    r = RG.extract_molise(m).first()
    assert (r["law_number"], r["date_text"], r["law_title"]) == (
        "3", "12 Gennaio 2023", "Testo coordinato delle norme per il sostegno alle imprese")
    pu = _pages(spark, "https://p.example/LeggeNavscroll.aspx?id=1",
                '<span id="ContentPlaceHolder1_lblData">05/06/2021</span><span id="ContentPlaceHolder1_lblNumero">14</span>'
                '<p align="center">Corta</p><p align="center">Misure urgenti per il territorio</p>')
    r = RG.extract_puglia(pu).first()
    assert (r["law_title"], r["filename"]) == ("Misure urgenti per il territorio", "Puglia_14_2021-06-05.pdf")


def test_golden_veneto_campania_lombardia_toscana(spark):
    v = _pages(spark, "https://v.example/dettaglio-legge?id=1",
               '<h2 class="title">Legge regionale 3 ottobre 2024, n. 21</h2><p class="font-18">Norme sul paesaggio</p>')
    r = RG.extract_veneto(v).first()
    assert (r["law_number"], r["date_text"], r["filename"]) == ("21", "3 ottobre 2024", "No PDF")
    c = _pages(spark, "https://c.example/dettaglio-documento?id=9",
               '<h1>Bilancio</h1><p>Legge regionale 7 agosto 2024, n. 11</p><a href="/prendiDocumento?id=9">pdf</a>')
    r = RG.extract_campania(c).first()
    assert (r["law_number"], r["date_text"], r["filename"]) == ("11", "7 agosto 2024", "Campania_11_7 agosto 2024.pdf")
    lo = _pages(spark, "https://lo.example/leggi?anno=2024",
                '<li><a href="/w?view=showdoc&iddoc=1">Legge regionale 4 luglio 2024, n. 9</a></li>')
    r = RG.extract_lombardia(lo).first()
    assert (r["law_number"], r["date_text"], r["source_url"]) == ("9", "4 luglio 2024", "https://lo.example/w?view=showdoc&iddoc=1")
    t = _pages(spark, "https://t.example/articolo?urndoc=x",
               '<div id="titolo_doc">Norme sui porti</div><p>n. 3 del 08/01/2025</p>')
    r = RG.extract_toscana(t).first()
    assert (r["region"], r["law_title"], r["law_number"], r["filename"]) == ("Toscana", "Norme sui porti", "3", "Tuscany_3_2025-01-08.pdf")


def test_entities_and_nested_elements(spark):
    p = _pages(spark, "u", '<div data-id="t">no</div><div id="t">Qualit&agrave; <div><b>dell&rsquo;</b>aria</div> &#8217;25&#x2019; &amp;lt; &nope; &#0; 5&deg;</div><div>dopo</div>')
    r = p.select(H.element_text("html", "div", H.attr_is("id", "t")).alias("t"), H.page_text("html").alias("all")).first()
    assert r["t"] == "Qualità dell’ aria ’25’ &lt; &nope; &#0; 5°"
    assert r["all"].endswith("5° dopo")
    u = _pages(spark, "https://u.example/mostra_atto.php?id=1", "<h1>Tutela della qualit&agrave;</h1><p>Legge regionale 1&deg; dicembre 2025, n. 3</p>")
    r = RG.extract_umbria(u).first()
    assert (r["law_title"], r["law_date"], r["filename"]) == ("Tutela della qualità", dt.date(2025, 12, 1), "Umbria_3_2025-12-01.pdf")


def test_unclosed_and_repeated_elements(spark):
    p = _pages(spark, "u", "<div id='a'>uno <div>due</div> tre<p>non chiuso")
    assert p.select(H.element_text("html", "div", H.attr_is("id", "a")).alias("t")).first()["t"] is None
    p = _pages(spark, "u", "<h2>a</h2><h2>b</h2>")
    assert p.select(H.element_text("html", "h2").alias("t")).first()["t"] == "a"


def test_dom_of_deep_and_of_long_pages(spark):
    import time

    deep = "<div class='x'>" * 3000 + "<a href='/giu'>in fondo</a>" + "</div>" * 3000
    dom = parse_html(deep)
    assert dom["links"][0]["text"] == "in fondo" and dom["text"] == "in fondo" and dom["links"][0]["in_cls"] == "x"
    items = "".join(f"<a href='/{k}.pdf'>Legge regionale n. {k} del 01/02/2020</a> " for k in range(6000))
    t0 = time.perf_counter()
    dom = parse_html(f"<div class='lista'>{items}</div>", want={"links"})
    assert len(dom["links"]) == 6000 and time.perf_counter() - t0 < 5
    assert sum(len(x["parent_text"] or "") + len(x["in_cls"]) for x in dom["links"]) < 100_000


def test_url_join_dots(spark):
    cases = [
        ("https://a.example/b/c/d.html", "../../../../x", "https://a.example/x"), ("https://a.example/b/c", "../../../../../../x", "https://a.example/x"),
        ("https://a.example/b/c", "/c/../d", "https://a.example/d"), ("https://a.example", "../x", "https://a.example/x"),
        ("https://a.example/b/c", "./", "https://a.example/b/"), ("https://a.example/b/c/", "..", "https://a.example/b/"),
        ("https://a.example/b/c", "x?y=../z#../q", "https://a.example/b/x?y=../z#../q"), ("https://a.example/b/c?u=/v/", "w", "https://a.example/b/w"),
    ]
    df = spark.createDataFrame(cases, "b string, h string, want string")
    assert [r["g"] for r in df.select(U.url_join(F.col("b"), F.col("h")).alias("g")).collect()] == [c[2] for c in cases]
    q = spark.createDataFrame([("https://a.example/s?x.y=a%20b+c&z=&xzy=no",)], "u string")
    r = q.select(U.query_param("u", "x.y").alias("a"), U.query_param("u", "z", "0").alias("z"), U.query_param("u", "w").alias("w")).first()
    assert (r["a"], r["z"], r["w"]) == ("a b c", "0", None)


def test_first_record_stays_and_whole_texts_count(spark):
    long = "comma " * 400
    p = spark.createDataFrame([
        (2, "https://a.example/r?page=2", '<a href="dettaglio?pk_lr=1">3 marzo 2020, n. 5</a><p class="elemento_lista_paginata_banche_dati">Alfa seconda</p>'),
        (1, "https://a.example/r?page=1", '<a href="dettaglio?pk_lr=1">3 marzo 2020, n. 5</a><p class=\'elemento_lista_paginata_banche_dati\'>Zeta prima</p>'
            f'<a href="dettaglio?pk_lr=2">4 marzo 2020, n. 6</a><p class=\'elemento_lista_paginata_banche_dati\'>{long}(abrogata dall’art. 2)</p>'
            f'<a href="dettaglio?pk_lr=3">5 marzo 2020, n. 7</a><p class=\'elemento_lista_paginata_banche_dati\'>{long}</p><a href="dettaglio?pk_lr=">senza data</a><p class=\'elemento_lista_paginata_banche_dati\'>Vuota</p>'),
    ], "page_id long, url string, html string")
    got = {r["source_url"].rsplit("=", 1)[1]: r for r in RG.extract_aosta(p).collect()}
    assert set(got) == {"1", "3", ""} and got["1"]["law_title"] == "Zeta prima"
    assert len(got["3"]["law_title"]) == 1000 and got[""]["filename"] == "ValleAosta_ID_0.pdf"
    detail = spark.createDataFrame([("https://a.example/dettaglio?pk_lr=3", "<p>(Legge abrogata dall'art. 9)</p>")], "url string, html string")
    assert "3" not in {r["source_url"].rsplit("=", 1)[1] for r in RG.extract_aosta(p, detail).collect()}
    c = spark.createDataFrame([(k, f"https://c.example/dettaglio-documento?codice={k}", '<h1>T</h1><p>7 agosto 2024, n. 1</p><a href="/prendiDocumento">x</a>') for k in range(3)],
                              "page_id long, url string, html string")
    assert RG.extract_campania(c).count() == 0


def test_trentino_card_teaser_and_font_title(spark):
    p = _pages(spark, "https://t.example/content/view/full/7",
               '<font dir="auto">Ordinamento dei comuni</font><div class="card-teaser"><a href="/scarica/7">Testo</a></div><a href="/x.pdf">no</a>')
    r = RG.extract_trentino(p.withColumn("page_no", F.lit(4))).collect()
    assert [(x["law_title"], x["doc_type"], x["page_no"], x["source_url"]) for x in r] == [
        ("Ordinamento dei comuni", "DOC", 4, "https://t.example/content/view/full/7")]


def test_unknown_region_has_no_shape(spark):
    import pytest

    with pytest.raises(ValueError):
        RG.conform(spark.range(1), "atlantide")
    assert set(RG.DISPLAY_COLUMNS) == {*RG.EXTRACTORS, "calabria"}


def test_calabria_takes_the_years_of_the_captures(spark):
    rows = [(2031, 1, 200, {"Content-Disposition": 'x="Legge 5 marzo 2031.pdf"'}, b"%PDF", "testo"), (2031, 2, 404, {}, b"", ""), (1950, 1, 200, None, b"%PDF", None)]
    caps = spark.createDataFrame(rows, "y int, n int, status int, headers map<string,string>, body binary, first_page_text string")
    got = sorted((r["law_number"], r["date_text"]) for r in RG.extract_calabria(caps).collect())
    assert got == [("1", "1950"), ("1", "5 marzo 2031")]


def test_attributes_as_a_browser_reads_them(spark):
    p = _pages(spark, "u", """<a title="Accedi all'atto" href="/doc?t=l'acqua">uno</a><a href=/u?a=1&amp;b=2 title='detto "x"'>due</a>
        <A HREF = '/v' class = "a  b"/>tre</A><a data-href='/no'>quattro</a><!-- <a href="/c">c</a> --><a href="">cinque</a><a href="/w" href="/z" disabled>sei</a>""")
    got = [tuple(r)[3:] for r in H.extract_anchors(p).collect()]
    assert got == [("/doc?t=l'acqua", "uno", "Accedi all'atto", None), ("/u?a=1&b=2", "due", 'detto "x"', None), ("/v", "tre", None, "a  b"),
                   (None, "quattro", None, None), (None, "cinque", None, None), ("/w", "sei", None, None)]
    assert [r["href"] for r in H.extract_links(p).collect()] == ["/doc?t=l'acqua", "/u?a=1&b=2", "/v", "", "/w"]
    c = _pages(spark, "u", '<h1><!-- no > titolo -->Titolo <b>vero</b><script>var x = "</h1>";</script></h1>')
    assert c.select(H.element_text("html", "h1").alias("t")).first()["t"] == "Titolo vero"


def test_friuli_button_by_id_or_text(spark):
    page = '<span id="PageBody_lbNumLegge">4</span><span id="lblData_1">4 luglio 2024</span>{}'
    pages = [(k, f"https://f.example/IndiceLex.aspx?id={k}", page.format(a)) for k, a in enumerate(
        ['<a id="PageBody_aPdf" href="a.pdf?x=1">Scarica</a>', "<a href='/d'>Testo PDF</a>", '<a href="/d.pdf">Testo</a>', ""])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(r["source_url"][-1] for r in RG.extract_friuli(df).collect()) == ["0", "1"]


# ------------------------------------------------------------------ the element table

HARD = [
    '<div class="x y">a<p id=p1>one<p class="k">two <b>bold</b>!</p>tail<ul><li>x<li>y <ul><li>z</ul></ul></div><br/>end <a href="u.pdf">L</a><p>after</p></i>',
    "<table><thead><tr><td>H</thead><tr><th>a<td>1<td><table><tr><td>in</table><tr><td>2<td><button>go</button><input type='image'></table>",
    "<h1>uno</h1><h2>due</h2>testo &amp; <b>x</b>y<h3>tre</h3><p>q</p></div>stray</p> fine <template>no</template>",
    '<a href="/1">x</a><div class="elenco download-list"><p>p <a href="/2">y<span>z</span></a></p></div><strong>Numero:</strong> 7 <p><b>Data BUR</b> 1 <b>Data</b>: 3</p>',
    "<p>a < b & c <i>d</i></p><ul><li><p>e<li>f</ul>g<div><p>h<table><tr><td><p>i</table>j</div>", "", "solo testo", "<div", "<div><div><div>x",
]


def test_the_element_table_agrees_with_the_tree(spark):
    from regesto.functions import elements as E

    df = spark.createDataFrame(list(enumerate(HARD)), "page_id int, html string")
    got = {r["page_id"]: r for r in df.select("page_id", E.scan("html").alias("page")).select(
        "page_id",
        E.page_text("page").alias("text"),
        F.transform(E.elements("page", "p"), lambda e: E.text("page", e)).alias("paras"),
        F.transform(E.elements("page", "li"), lambda e: E.text("page", e)).alias("items"),
        F.transform(E.elements("page", "h1", "h2", "h3"), lambda e: F.struct(e["tag"], E.text("page", e), E.next_text("page", e))).alias("heads"),
        F.transform(E.with_following(E.elements("page", "a"), E.elements("page", "p")), lambda x: F.struct(E.attr("page", x["e"], "href"), E.text("page", x["next"]))).alias("links"),
        E.cells("page").alias("cells"),
        F.transform(E.elements("page", where=lambda e: E.attr("page", e, "class").isNotNull()), lambda e: E.text("page", e)).alias("blocks"),
    ).collect()}
    for k, html in enumerate(HARD):
        dom, r = parse_html(html), got[k]
        assert r["text"] == dom["text"] and r["paras"] == [p["text"] for p in dom["paras"]] and r["items"] == dom["items"], html
        assert [tuple(h) for h in r["heads"]] == [(h["tag"], h["text"], h["next_text"]) for h in dom["headings"]], html
        assert [tuple(x) for x in r["links"]] == [(x["href"], x["next_para"]) for x in dom["links"]], html
        cells = [(c["tbl"], c["row"], c["col"], c["text"], c["has_button"]) for c in dom["cells"] if not c["is_header"]]
        assert [tuple(c) for c in r["cells"]] == cells, html
        assert r["blocks"] == [b["text"] for b in dom["blocks"] if b["cls"]], html


def test_element_table_of_deep_and_of_long_pages(spark):
    import time

    from regesto.functions import elements as E

    deep = "<div class='x'>" * 2000 + "<a href='/giu'>in fondo</a>" + "</div>" * 2000
    long = "".join(f"<p><a href='/{k}.pdf'>Legge regionale n. {k} del 01/02/2020</a></p>" for k in range(4000))
    df = spark.createDataFrame([(deep,), (long,)], "html string").repartition(2).select(E.scan("html").alias("page"))
    pairs = E.with_container(E.elements("page", "a"), E.elements("page", "p", "div"))
    t0 = time.perf_counter()
    got = sorted(df.select(F.transform(pairs, lambda x: F.struct(E.text("page", x["e"]).alias("t"), x["box"]["depth"].alias("d"))).alias("x")).collect(), key=lambda r: len(r["x"]))
    assert time.perf_counter() - t0 < 20
    assert [tuple(x) for x in got[0]["x"]] == [("in fondo", 2000)] and len(got[1]["x"]) == 4000 and got[1]["x"][3999]["t"].startswith("Legge regionale n. 3999")


def test_aosta_title_is_the_paragraph_of_its_class(spark):
    p = _pages(spark, "https://a.example/r?page=1", '<a href="dettaglio?pk_lr=1">3 marzo 2020, n. 5</a><p>O</p><p class="z elemento_lista_paginata_banche_dati">Titolo</p>')
    assert RG.extract_aosta(p).first()["law_title"] == "Titolo"


def test_pages_of_one_form_share_the_walk(monkeypatch):
    """The Arrow function numbers pages with the same tags once, and any page as the rules say."""
    import pyarrow as pa

    from regesto.functions import _scan
    from regesto.functions import elements as E

    walked, nest = [], _scan.nest
    monkeypatch.setattr(_scan, "nest", lambda *a: walked.append(a) or nest(*a))
    run = _scan.scanner(E.TOKEN_RX, frozenset(E.VOID), E._ENDS)
    pages = [f'<div id="{k}"><p class=c{k}>uno{k}<p>due<br>&lt; {k} < 3</div>' for k in range(700)]
    odd = [None, "", "x", "</p><LI>a<li>b</ul><td/>", '<a href="x>y"/><b', "<table><tr><td>1<td>2<tr><th>3</table>"]
    got = run(pa.array(pages + odd)).to_pylist()
    assert len(walked) <= 2 + len(odd)
    form = [(1, 10, 1, "div"), (2, 4, 2, "p"), (4, 10, 2, "p"), (6, 6, 3, "br")]
    assert [[tuple(e.values()) for e in g["els"]] for g in got[:700]] == [form] * 700
    assert ["".join(g["tokens"]) for g in got[:700]] == pages
    assert got[700] == {"tokens": None, "els": None} and got[701] == {"tokens": [], "els": []} and got[702] == {"tokens": ["x"], "els": []}
    els = [[tuple(e.values()) for e in g["els"]] for g in got[703:]]
    assert els[0] == [(2, 4, 1, "li"), (4, 8, 1, "li"), (7, 7, 2, "td")]
    assert els[1] == [(1, 1, 1, "a")] and got[704]["tokens"] == ['<a href="x>y"/>', "<", "b"]
    assert [e[3] for e in els[2]] == ["table", "tr", "td", "td", "tr", "th"]


def test_cells_of_nested_tables_and_marked_anchors(spark):
    from regesto.functions import elements as E

    p = _pages(spark, "u", "<table><thead><tr><td>h</td></tr></thead><tr><td>a<table><tr><td>b &amp; c<input type=submit></td></tr></table></td><td>d</td></tr></table>"
               '<a class="x hit" title="t" href="/1">1</a><a href="/2">2</a><a class="h&#105;t" href="/3">3</a><a title="hit">4</a>')
    cells = p.select(E.once(E.scan("html")).alias("page")).select(F.explode(E.cells("page")).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in cells] == [(1, 2, 1, "a b & c", True), (1, 2, 2, "d", False), (2, 1, 1, "b & c", True)]
    assert [tuple(r) for r in H.anchors_with(p, "hit", keep=()).collect()] == [("/1", "t", "x hit"), ("/3", None, "hit"), (None, "hit", None)]
    assert p.select(H.unescape(F.lit("a &amp; b &amp;amp;")).alias("x")).first()["x"] == "a & b &amp;"


def test_filters_on_what_a_page_says_stay_above_the_deal(spark):
    """A filter pushed below the deal of a scan's rows makes and reads the pages in its few tasks, once per use of a field."""
    import __spark_entry__ as entry

    for name in ("reg_campania", "reg_friuli", "reg_trentino"):
        plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan()
        filters = [plan.apply(i) for i in range(200) if plan.apply(i) is not None and plan.apply(i).nodeName() == "Filter"]
        conditions = [f.condition().sql() for f in filters]
        assert conditions
        assert not [c for c in conditions if "html>" in c or "aggregate(" in c or c.count("transform(") > 2], name


def test_text_without_and_with_references_is_the_same(spark):
    """Tags and white space go in one search where no reference stands; page by page as in plain Python."""
    import random
    import re

    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "\u00a0", "\u3000", "<", ">", "<b>", "</b>", "<br/>", "<i x='1\n2'>", "a", "è", "<!--", "-->", "<SCRIPT>", "</script>", "<style>", "</style >", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    flat = lambda t: re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", t)).strip(" ")
    page = lambda t: re.sub(r"(?s)<!--.*?-->", " ", re.sub(r"(?is)<style\b.*?</style\s*>", " ", re.sub(r"(?is)<script\b.*?</script\s*>", " ", t)))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, html string")
    got = df.select("i", H.inner_text("html").alias("a"), H.inner_text(F.concat("html", F.lit("&lt;"))).alias("b"), H.page_text("html").alias("c"), norm_ws("html").alias("d")).collect()
    for r in got:
        t = texts[r["i"]]
        assert (r["a"], r["c"], r["d"]) == (flat(t), flat(page(t)), re.sub(r"\s+", " ", t).strip(" ")), repr(t)
        assert r["b"] == flat(t + "\x01").replace("\x01", "<"), repr(t)
    assert spark.createDataFrame([(None,)], "html string").select(H.inner_text("html").alias("a")).first()["a"] == ""


def test_missing_parts_make_no_date(spark):
    df = spark.createDataFrame([("2001", "2", "28"), ("2001", "2", "30"), ("2001", None, "3"), ("", None, ""), (None, "2", "3"), ("", "2", "3")], "y string, m string, d string")
    assert [str(r[0]) for r in df.select(D.make_date("y", "m", "d")).collect()] == ["2001-02-28"] + ["None"] * 5
    texts = ["del 1° marzo 1999, poi 2 aprile 2000", "31 febbraio 2001", "il 5-6-2010", "32/13/2010", "senza data", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r[0]) for r in df.select(D.any_date("t")).collect()] == ["1999-03-01", "None", "2010-06-05", "None", "None", "None", "None"]
