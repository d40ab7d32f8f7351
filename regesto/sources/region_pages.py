"""One invented page markup per region job, built by SQL from ``law_headers``.

Same SQL text in Spark and DuckDB.  The expected law record of every page sits
in ``law_headers``' own columns (law_id, region, d, no, hdr), so the oracles in
``plans/q_regions.py`` never parse HTML.  Header form = ``law_id % 4``:
0 ``d mese yyyy, n. N``; 1 ``n. N del dd/mm/yyyy``; 2 as 0 with ``°``; 3 no data.
"""

from __future__ import annotations

from regesto.sources.fixtures import IT_MONTHS_CSV, VIEW_DEPS, VIEW_SQL

# English month names in calendar order (pages of the bilingual portal).
EN_MONTHS_CSV = "January,February,March,April,May,June,July,August,September,October,November,December"

ID = "cast(law_id as string)"
NO = "cast(no as string)"
DAY = "cast(day(d) as string)"
DAY2 = "lpad(cast(day(d) as string), 2, '0')"
MON2 = "lpad(cast(month(d) as string), 2, '0')"
YEAR = "cast(year(d) as string)"
IT = f"split_part('{IT_MONTHS_CSV}', ',', month(d))"
EN = f"split_part('{EN_MONTHS_CSV}', ',', month(d))"
DMY = f"concat({DAY2}, '/', {MON2}, '/', {YEAR})"
ISO = f"concat({YEAR}, '-', {MON2}, '-', {DAY2})"
DIT = f"concat({DAY}, ' ', {IT}, ' ', {YEAR})"
DITD = f"concat({DAY}, '° ', {IT}, ' ', {YEAR})"
TITLE = "concat('Disposizioni per la regione ', region, ' e norme collegate')"
FORM = "law_id % 4"

BASILICATA_ROW = f"""concat('<tr><td>', CASE {FORM} WHEN 3 THEN '' WHEN 1 THEN {NO} ELSE concat('n. ', {NO}) END, '</td><td>',
            CASE WHEN {FORM} = 3 THEN '' ELSE {DMY} END, '</td><td>', {TITLE},
            '</td><td><input type="image" src="/img/Btn_Selezione.png"></td></tr>')"""
EMILIA_BUTTON = f"""concat('<a class="hitelement_button" title="Accedi al documento ',
            CASE {FORM} WHEN 0 THEN concat('Legge regionale ', {DIT}, ', n.', {NO}, ' sull', chr(39), 'acqua')
                        WHEN 2 THEN concat('Legge regionale ', {DITD}, ', n.', {NO}) ELSE hdr END,
            '" href=', chr(39), '/doc/', {ID}, chr(39), '>Apri</a>')"""


def _page(url: str, html: str, more: str = "") -> str:
    return f"SELECT law_id AS page_id, {url} AS url, {html} AS html{more} FROM law_headers"


PAGES: dict[str, str] = {
    "basilicata": _page(
        f"concat('https://basilicata.example/elenco?p=', {ID})",
        f"""concat('<html><body><table id="menu"><tr><td>9</td><td>01/01/2001</td><td>Altra tabella</td><td><input type="image" src="/img/Btn_Selezione.png"></td></tr></table>',
            '<table id="ctl00_GVElenco"><tr><td>8</td><td>02/02/2002</td><td>Riga con altro bottone</td><td><button>Apri</button></td></tr><tr><th>Numero</th><th>Data</th><th>Oggetto</th><th></th></tr>', {BASILICATA_ROW}, '</table></body></html>')"""),
    "campania": _page(
        f"concat('https://campania.example/dettaglio-documento?', CASE WHEN law_id % 13 = 5 THEN 'codice=' ELSE 'id=' END, {ID})",
        f"""concat('<html><body><h1>', {TITLE}, ' e attivit&agrave;</h1><div class="testo"><p>', hdr,
            '</p></div><a href="/prendiDocumento?id=', {ID}, '">Scarica</a></body></html>')"""),
    "friuli": _page(
        f"concat('https://fvg.example/IndiceLex.aspx?id=', {ID})",
        f"""concat('<html><body><div class="materia"><a href="Lista.aspx?materia=', region, '">Materia ', region,
            '</a></div><table id="gvListaRegolamenti"><tr><th>Legge</th><th>Data</th></tr><tr><td><a href="IndiceLex.aspx?id=', {ID},
            '">Apri</a></td><td><span id="lblData_', {ID}, '">',
            CASE {FORM} WHEN 0 THEN {DIT} WHEN 1 THEN {DMY} WHEN 2 THEN {DITD} ELSE '' END,
            '</span></td></tr></table><span data-id="PageBody_lbOggettolegge">Altro</span><span id="', CASE WHEN {FORM} = 2 THEN 'ctl_lblOggetto_1' ELSE 'PageBody_lbOggettolegge' END, '">', CASE WHEN {FORM} = 1 THEN hdr ELSE {TITLE} END, '</span>',
            CASE WHEN {FORM} = 1 THEN '' ELSE concat('<span id="PageBody_lbNumLegge">', {NO}, '</span>') END,
            CASE {FORM} WHEN 3 THEN '<a href="/altro.pdf">Altro</a>' WHEN 0 THEN concat('<a href="/doc/', {ID}, '.pdf?v=1" class=btn>Apri PDF</a>')
                        WHEN 1 THEN concat('<a href=/scarica/', {ID}, ' id=PageBody_aPdf>Scarica</a>') ELSE concat('<a id="PageBody_aPdf" href="/doc/', {ID}, '.pdf">PDF</a>') END,
            '</body></html>')"""),
    "lazio": _page(
        f"concat('https://lazio.example/leggiregionalidettaglio?id=', {ID})",
        f"""concat('<html><body>',
            CASE WHEN {FORM} = 3 THEN '<h1></h1><h2>Testo senza estremi</h2>' ELSE concat('<h1>', hdr, '</h1>') END,
            CASE WHEN {FORM} = 3 THEN '' ELSE concat('<p><strong>Numero della legge:</strong> ', {NO}, '</p>') END,
            '<p><strong>Data BUR:</strong> 01/01/2000</p>',
            CASE {FORM} WHEN 3 THEN '' WHEN 2 THEN concat('<p><strong>Data:</strong> ', {DITD}, '</p>')
                        WHEN 1 THEN concat('<p><strong>Data</strong> ', {DIT}, '</p>')
                        ELSE concat('<p><strong>Data:</strong> ', {DIT}, '</p>') END,
            '</body></html>')"""),
    "liguria": _page(
        f"concat('https://liguria.example/articolo?id=', {ID})",
        f"""concat('<html><head><title>Liguria</title></head><body><h1>', {TITLE}, '<!-- vecchio > titolo --></h1><div class="testo">', hdr,
            '</div><a href="/leggi/', {ID}, '.pdf">PDF</a></body></html>')"""),
    "toscana": _page(
        f"concat('https://toscana.example/articolo?urndoc=urn:nir:regione.toscana:legge:', {ID})",
        f"""concat('<html><body><div data-id="titolo_doc">Altro</div><div id="titolo_doc">', {TITLE}, ' <div class="sub">Testo vigente</div> e allegati</div><p class="estremi">', hdr, '</p></body></html>')"""),
    "lombardia": _page(
        f"concat('https://lombardia.example/leggi?anno=', {YEAR}, '&p=', {ID})",
        f"""concat('<html><body><ul><li><a title="Leggi l', chr(39), 'atto" href=', CASE WHEN law_id % 2 = 0 THEN concat('"/web/leggi?view=showdoc&amp;iddoc=', {ID}, '"') ELSE concat('/web/leggi?view=showdoc&iddoc=', {ID}) END, '>', hdr, '</a></li></ul></body></html>')"""),
    "marche": _page(
        f"concat('https://marche.example/dettaglio.php?arc=vig&id=', {ID})",
        f"""concat('<html><body><h1>', CASE WHEN law_id % 2 = 1 THEN {TITLE} ELSE 'Legge regionale' END, '</h1>',
            CASE WHEN law_id % 2 = 0 THEN concat('<table><tr><td>Oggetto</td><td>', {TITLE}, '</td></tr></table>') ELSE '' END,
            '<p>', hdr, '</p></body></html>')"""),
    "molise": _page(
        f"concat('https://molise.example/leggi/OpenDocument?id=', {ID})",
        f"""concat('<html><head><title>Molise - Leggi regionali</title></head><body><h2>', hdr, '</h2><p>Testo coordinato: ',
            {TITLE}, '</p><ul><li>Legge regionale del Molise, testo vigente</li></ul></body></html>')"""),
    "piemonte": _page(
        f"concat('https://piemonte.example/dettaglioLegge.do?id=', {ID})",
        f"""concat('<html><body><div id="titoloAtto">', {TITLE}, '<div class="bur">BUR n. 12 del 01/01/2000</div></div><span class="lead">',
            CASE {FORM} WHEN 0 THEN concat('Legge regionale del ', {DIT}, ', n. ', {NO})
                        WHEN 1 THEN concat('Legge regionale n. ', {NO}, ' del ', {DMY})
                        WHEN 2 THEN concat('Legge regionale del ', {DITD}, ', n. ', {NO})
                        ELSE 'Legge regionale senza estremi' END, '</span>',
            CASE WHEN law_id % 7 = 0 THEN '<p>( Abrogata )</p>' ELSE '' END,
            '<a href="/doc/', {ID}, '.pdf">PDF</a>',
            '</body></html>')"""),
    "puglia": _page(
        f"concat('https://puglia.example/LeggeNavscroll.aspx?id=', {ID})",
        f"""concat('<html><body>', CASE WHEN {FORM} = 3 THEN '' ELSE concat('<span id="ContentPlaceHolder1_lblData">', {DMY},
            '</span><span id="ContentPlaceHolder1_lblNumero">', {NO}, '</span>') END,
            '<p align="center">Breve</p><p align="center">', {TITLE}, '</p></body></html>')"""),
    "sardinia": _page(
        f"concat('https://sardegna.example/leggi?p=', {ID})",
        f"""concat('<html><body>', CASE WHEN law_id % 2 = 0
              THEN concat('<p><a href="/leggi/', {ID}, '.pdf">', hdr, '</a> - pubblicata sul BURAS</p>')
              ELSE concat('<div><a href="/leggi/', {ID}, '.pdf">', hdr, '</a></div>') END,
            '<a href="/altro.html">Altro</a></body></html>')"""),
    "trentino": _page(
        f"concat('https://taa.example/content/view/full/', {ID})",
        f"""concat('<html><body><h1>', hdr, '</h1>', CASE WHEN {FORM} = 1 THEN '<br>' ELSE concat(' ', {TITLE}) END,
            '<div class="row">',
            CASE {FORM} WHEN 0 THEN concat('<strong class="text-nowrap">', {DAY2}, '.', {MON2}, '.', {YEAR}, '</strong>')
                        WHEN 2 THEN concat('<strong class="text-nowrap">', {DIT}, '</strong>') ELSE '' END,
            CASE WHEN {FORM} = 1 THEN concat('<div class="col-md-3">Data ', {EN}, ' ', {DAY}, ', ', {YEAR}, '</div>') ELSE '' END,
            '</div>',
            CASE WHEN law_id % 2 = 0
              THEN CASE WHEN law_id % 4 = 0
                THEN concat('<div class="card-teaser"><a href="/scarica/', {ID}, '_it">Testo IT</a></div><div class="card-teaser"><a href="/scarica/', {ID}, '_de">Text DE</a></div>')
                ELSE concat('<div class="download-list"><a href="/doc/', {ID}, '_it.pdf">Testo IT</a><a href="/doc/', {ID}, '_de.pdf">Text DE</a></div>') END
              ELSE concat('<p><a href="/doc/', {ID}, '.pdf">Documento</a></p>') END,
            '</body></html>')"""),
    "umbria": _page(
        f"concat('https://umbria.example/mostra_atto.php?id=', {ID}, '&file=lr', {YEAR}, '-999.html')",
        f"""concat('<html><body>', CASE WHEN law_id % 2 = 0 THEN concat('<table><tr><td>', {NO}, '</td><td>', {TITLE}, '</td></tr></table>') ELSE '' END,
            '<h2>', replace(hdr, '°', '&deg;'), '</h2></body></html>')""",
        f", concat('L.R. ', {YEAR}, '-', {NO}, '.') AS link_text"),
    "veneto": _page(
        f"concat('https://veneto.example/dettaglio-legge?id=', {ID})",
        f"""concat('<html><body><h2 class="title">', hdr, '</h2><p class="font-180">Altro</p><p class="font-18">', {TITLE}, ' e l&#8217;acqua</p>',
            CASE WHEN {FORM} = 3 THEN '' ELSE '<a href="#pdf">Pdf testo</a>' END, '</body></html>')""",
        ", law_id % 10 = 2 AS download_failed"),
    "aosta": _page(
        f"concat('https://aosta.example/ricerca?anno=', {YEAR}, '&page=', {ID})",
        f"""concat('<html><body><div class="risultati"><a href="dettaglio?pk_lr=', {ID}, '">',
            CASE {FORM} WHEN 0 THEN concat({DIT}, ', n. ', {NO}) WHEN 1 THEN concat('numero ', {NO}, ' del ', {DMY})
                        WHEN 2 THEN concat({DITD}, ', num. ', {NO}) ELSE 'Legge senza estremi' END,
            '</a><p class="data">Bollettino 1</p><p class="elemento_lista_paginata_banche_dati">',
            CASE WHEN law_id % 9 = 0 THEN concat({TITLE}, repeat(' comma', 200), ' (abrogata dall’art. 3 della l.r. 5/2020)')
                 WHEN law_id % 11 = 3 THEN concat({TITLE}, repeat(' comma', 200)) ELSE {TITLE} END,
            '</p><a href="dettaglio?pk_lr=', {ID}, '">Aggiornamento</a><p>Aaa seconda voce</p></div></body></html>')"""),
    "emilia": _page(
        f"concat('https://emilia.example/ricerca?p=', {ID})",
        f"""concat('<html><body>', {EMILIA_BUTTON}, '<a href="/altro">Altro</a><a title="Altra pagina" href="/altro2">Altra</a></body></html>')"""),
}

# Calabria's probe captures: one per (year, number) of the orders grid.
CALABRIA_CAPTURES = f"""
SELECT y, n, k, d, status, content_disposition, first_page_text, body_text FROM (
  SELECT cast(2020 + o_orderkey % 7 as int) AS y,
         cast((o_orderkey - o_orderkey % 7) / 7 + 1 as int) AS n,
         o_orderkey AS k, cast(o_orderdate as date) AS d,
         CASE WHEN o_orderstatus = 'P' THEN 200 ELSE 404 END AS status,
         CASE WHEN o_orderkey % 3 = 0
              THEN concat('attachment; filename="Legge ', cast(day(o_orderdate) as string), ' ',
                          split_part('{IT_MONTHS_CSV}', ',', month(o_orderdate)), ' ', cast(year(o_orderdate) as string), '.pdf"')
              ELSE 'attachment' END AS content_disposition,
         concat(CASE WHEN o_orderkey % 5 = 1 THEN 'LEGGE REGIONALE'
                     ELSE concat('LEGGE REGIONALE ', cast(day(o_orderdate) as string), ' ',
                                 split_part('{IT_MONTHS_CSV}', ',', month(o_orderdate)), ' ', cast(year(o_orderdate) as string)) END,
                chr(10),
                CASE WHEN o_orderkey % 5 = 0 THEN 'Breve testo'
                     ELSE concat('Disposizioni urgenti per la regione numero ', cast(o_orderkey as string)) END) AS first_page_text,
         CASE WHEN o_orderkey % 11 = 0 THEN '<html>errore</html>' ELSE '%PDF-1.4 documento' END AS body_text
  FROM orders)"""

for _k, _sql in PAGES.items():
    VIEW_SQL[f"pages_{_k}"] = _sql
    VIEW_DEPS[f"pages_{_k}"] = ("law_headers",)
VIEW_SQL["calabria_captures"] = CALABRIA_CAPTURES
