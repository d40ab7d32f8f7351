"""Checks for the region jobs: Spark parses each region's pages; the oracle
writes the expected ``law_index`` rows straight from ``law_headers``' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from regesto.operators import dedupe as S
from regesto.operators import filters as P
from regesto.plans import regions as RG
from regesto.plans.registry import query
from regesto.sources import region_pages as RP
from regesto.sources.fixtures import view

ID, NO, DMY, ISO, DIT, DITD, TITLE, FORM = RP.ID, RP.NO, RP.DMY, RP.ISO, RP.DIT, RP.DITD, RP.TITLE, RP.FORM
DAY, DAY2, YEAR, IT = RP.DAY, RP.DAY2, RP.YEAR, RP.IT
EN_LONG = "strftime(d, '%-d %B %Y')"

def oracle_select(where: str = "", src: str = "law_headers", **exprs: str) -> str:
    cols = []
    if "law_number_int" not in exprs and "law_number" in exprs:
        num = exprs["law_number"]
        exprs["law_number_int"] = f"CASE WHEN regexp_matches({num}, '^[0-9]{{1,9}}$') THEN cast({num} as int) END"
    for name, typ in RG.LAW_INDEX:
        e = exprs.get(name, "NULL")
        sql_type = {"string": "varchar", "int": "integer", "date": "date"}[typ]
        cols.append(f"cast({e} as {sql_type}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM {src}" + (f" WHERE {where}" if where else "")


def _num_or(default: str, when_missing: str) -> str:
    return f"CASE WHEN {when_missing} THEN '{default}' ELSE {NO} END"


ORACLE_SELECTS: dict[str, str] = {
    "basilicata": oracle_select(
        region="'Basilicata'", law_title=TITLE, law_number=_num_or("0", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN 'Unknown' ELSE {DMY} END", law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://basilicata.example/elenco?p=', {ID})",
        filename=f"concat('Basilicata_', {_num_or('0', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN '0000-00-00' ELSE {ISO} END, '.pdf')"),
    "campania": oracle_select(
        where=f"{FORM} IN (0, 2) AND law_id % 13 <> 5", region="'Campania'", law_title=f"concat({TITLE}, ' e attività')", law_number=NO,
        date_text=f"CASE WHEN {FORM} = 0 THEN {DIT} ELSE {DITD} END", law_date="d",
        source_url=f"concat('https://campania.example/dettaglio-documento?id=', {ID})",
        filename=f"concat('Campania_', {NO}, '_', CASE WHEN {FORM} = 0 THEN {DIT} ELSE {DITD} END, '.pdf')"),
    "friuli": oracle_select(
        where=f"{FORM} <> 3", region="'Friuli Venezia Giulia'", law_title=f"CASE WHEN {FORM} = 1 THEN hdr ELSE {TITLE} END", law_number=NO,
        date_text=DMY, law_date="d", status="'Success'", category="concat('Materia ', region)",
        source_url=f"concat('https://fvg.example/IndiceLex.aspx?id=', {ID})",
        filename=f"concat('FVG_', {NO}, '_', replace({DMY}, '/', '-'), '.pdf')"),
    "lazio": oracle_select(
        region="'Lazio'", law_title=f"CASE WHEN {FORM} = 3 THEN 'Testo senza estremi' ELSE hdr END",
        law_number=_num_or("N/A", f"{FORM} = 3"),
        date_text=f"CASE {FORM} WHEN 3 THEN 'N/A' WHEN 2 THEN {DITD} ELSE {DIT} END",
        law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://lazio.example/leggiregionalidettaglio?id=', {ID})",
        filename=f"""CASE WHEN {FORM} = 3 THEN concat('Lazio_ID_', {ID}, '_unknown_date.pdf')
                     ELSE concat('Lazio_', {NO}, '_', CASE WHEN {FORM} = 2 THEN {DITD} ELSE {DIT} END, '.pdf') END"""),
    "liguria": oracle_select(
        region="'Liguria'", law_title=TITLE, law_number=_num_or("Unknown", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN '' ELSE {EN_LONG} END", law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://liguria.example/articolo?id=', {ID})",
        filename=f"concat('Liguria_', {_num_or('Unknown', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN '0000-00-00' ELSE {ISO} END, '.pdf')"),
    "toscana": oracle_select(
        region="'Toscana'", law_title=f"concat({TITLE}, ' Testo vigente e allegati')", law_number=_num_or("Unknown", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN '' ELSE {EN_LONG} END", law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://toscana.example/articolo?urndoc=urn:nir:regione.toscana:legge:', {ID})",
        filename=f"concat('Tuscany_', {_num_or('Unknown', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN '0000-00-00' ELSE {ISO} END, '.pdf')"),
    "lombardia": oracle_select(
        region="'Lombardia'", law_title="hdr", law_number=_num_or("Unknown", f"{FORM} IN (1, 3)"),
        date_text=f"CASE WHEN {FORM} IN (1, 3) THEN '' ELSE {DIT} END", law_date=f"CASE WHEN {FORM} IN (1, 3) THEN NULL ELSE d END",
        source_url=f"concat('https://lombardia.example/web/leggi?view=showdoc&iddoc=', {ID})",
        filename=f"concat('Lombardia_', {_num_or('Unknown', f'{FORM} IN (1, 3)')}, '_', CASE WHEN {FORM} IN (1, 3) THEN '0000-00-00' ELSE {ISO} END, '.pdf')"),
    "marche": oracle_select(
        region="'Marche'", law_title=TITLE, law_number=_num_or("NA", f"{FORM} = 3"),
        date_text=f"CASE {FORM} WHEN 0 THEN {DIT} WHEN 2 THEN {DITD} ELSE 'NA' END",
        law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://marche.example/dettaglio.php?arc=vig&id=', {ID})",
        filename=f"""concat('Marche_', {_num_or('NA', f'{FORM} = 3')}, '_',
                     replace(CASE {FORM} WHEN 0 THEN {DIT} WHEN 2 THEN {DITD} ELSE 'NA' END, ' ', '-'), '.pdf')"""),
    "molise": oracle_select(
        region="'Molise'", law_title=f"concat('Testo coordinato: ', {TITLE})", law_number=_num_or("NA", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN 'NA' ELSE concat({DAY}, ' ', upper(left({IT}, 1)), substring({IT}, 2), ' ', {YEAR}) END",
        law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://molise.example/leggi/OpenDocument?id=', {ID})",
        filename=f"concat('Molise_', {_num_or('NA', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN 'NA' ELSE {ISO} END, '.pdf')"),
    "piemonte": oracle_select(
        where="law_id % 7 <> 0", region="'Piemonte'", law_title=TITLE,
        law_number=_num_or("Unknown", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} IN (0, 2) THEN {DIT} ELSE '00/00/0000' END",
        law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://piemonte.example/dettaglioLegge.do?id=', {ID})",
        filename=f"concat('Piemonte_', {_num_or('Unknown', f'{FORM} = 3')}, '_', CASE WHEN {FORM} IN (0, 2) THEN {ISO} ELSE '0000-00-00' END, '.pdf')"),
    "puglia": oracle_select(
        region="'Puglia'", law_title=TITLE, law_number=_num_or("Unknown", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN '01/01/1900' ELSE {DMY} END", law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        source_url=f"concat('https://puglia.example/LeggeNavscroll.aspx?id=', {ID})",
        filename=f"concat('Puglia_', {_num_or('Unknown', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN '0000-00-00' ELSE {ISO} END, '.pdf')"),
    "sardinia": oracle_select(
        where=f"{FORM} <> 3", region="'Sardinia'",
        law_title="CASE WHEN law_id % 2 = 0 THEN concat(hdr, ' - pubblicata sul BURAS') ELSE hdr END", law_number=NO,
        date_text=f"CASE {FORM} WHEN 0 THEN {DIT} WHEN 1 THEN {DMY} ELSE {DITD} END", law_date="d",
        source_url=f"concat('https://sardegna.example/leggi/', {ID}, '.pdf')",
        filename=f"concat('Sardinia_', {NO}, '_', {ISO}, '.pdf')"),
    "trentino": oracle_select(
        src="""law_headers JOIN (SELECT 0 AS par, 'IT' AS kind UNION ALL SELECT 0, 'DE'
               UNION ALL SELECT 1, 'DOC') AS docs ON law_id % 2 = docs.par""",
        region="'Trentino-Alto Adige'", law_title=f"CASE WHEN {FORM} = 1 THEN hdr ELSE {TITLE} END",
        law_number=_num_or("0", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} = 3 THEN 'Unknown' ELSE {DMY} END", law_date=f"CASE WHEN {FORM} = 3 THEN NULL ELSE d END",
        doc_type="kind", status="'Pending'", source_url=f"concat('https://taa.example/content/view/full/', {ID})",
        filename=f"""concat('TrentinoAA_', {_num_or('0', f'{FORM} = 3')}, '_', CASE WHEN {FORM} = 3 THEN '0000-00-00' ELSE {ISO} END,
                     '_', kind, '.pdf')"""),
    "umbria": oracle_select(
        region="'Umbria'", law_title=f"CASE WHEN law_id % 2 = 0 THEN {TITLE} ELSE hdr END", law_number=NO,
        date_text=f"CASE {FORM} WHEN 0 THEN {DIT} WHEN 2 THEN {DITD} ELSE 'Unknown Date' END",
        law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://umbria.example/mostra_atto.php?id=', {ID}, '&file=lr', {YEAR}, '-999.html')",
        filename=f"concat('Umbria_', {NO}, '_', CASE WHEN {FORM} IN (0, 2) THEN {ISO} ELSE '0000-00-00' END, '.pdf')"),
    "veneto": oracle_select(
        region="'Veneto'", law_title=f"concat({TITLE}, ' e l’acqua')", law_number=_num_or("Unknown", f"{FORM} IN (1, 3)"),
        date_text=f"CASE {FORM} WHEN 0 THEN {DIT} WHEN 2 THEN {DITD} ELSE 'Unknown' END",
        law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://veneto.example/dettaglio-legge?id=', {ID})",
        filename=f"""CASE WHEN {FORM} = 3 THEN 'No PDF' WHEN law_id % 10 = 2 THEN 'Failed Download' WHEN {FORM} = 1 THEN 'Veneto_Unknown_Unknown.pdf'
                     ELSE concat('Veneto_', {NO}, '_', {ISO}, '.pdf') END"""),
    "aosta": oracle_select(
        where="law_id % 9 <> 0", region="'Valle d''Aosta'",
        law_title=f"CASE WHEN law_id % 11 = 3 THEN left(concat({TITLE}, repeat(' comma', 200)), 1000) ELSE {TITLE} END", law_number=_num_or("0", f"{FORM} = 3"),
        date_text=f"CASE WHEN {FORM} IN (0, 2) THEN {DIT} ELSE 'Unknown' END", law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://aosta.example/dettaglio?pk_lr=', {ID})", status="'Pending'",
        filename=f"""CASE WHEN {FORM} IN (0, 2) THEN concat('ValleAosta_', {NO}, '_', {ISO}, '.pdf')
                     ELSE concat('ValleAosta_ID_', {ID}, '.pdf') END"""),
    "emilia": oracle_select(
        region="'Emilia-Romagna'",
        law_title=f"""CASE {FORM} WHEN 0 THEN concat('Legge regionale ', {DIT}, ', n.', {NO}, ' sull', chr(39), 'acqua')
                      WHEN 2 THEN concat('Legge regionale ', {DITD}, ', n.', {NO}) ELSE hdr END""",
        law_number=_num_or("Unknown", f"{FORM} IN (1, 3)"),
        date_text=f"CASE WHEN {FORM} IN (0, 2) THEN concat({DAY2}, ' ', {IT}, ' ', {YEAR}) ELSE 'Unknown' END",
        law_date=f"CASE WHEN {FORM} IN (0, 2) THEN d END",
        source_url=f"concat('https://emilia.example/doc/', {ID})", status="'Pending'",
        filename=f"concat('Emilia-Romagna_', {_num_or('Unknown', f'{FORM} IN (1, 3)')}, '_', CASE WHEN {FORM} IN (0, 2) THEN {ISO} ELSE '0000-00-00' END, '.pdf')"),
}

_CAL_ISO = "strftime(cd, '%Y-%m-%d')"
CALABRIA_ORACLE = f"""
WITH s AS (SELECT *, (status = 200 AND left(body_text, 4) = '%PDF') AS found FROM calabria_captures),
     s2 AS (SELECT *, n - coalesce(max(CASE WHEN found THEN n END) OVER (PARTITION BY y ORDER BY n
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak FROM s),
     c AS (SELECT y, min(CASE WHEN streak >= 10 THEN n END) AS cut FROM s2 GROUP BY y),
     r AS (SELECT s2.*, (k % 3 = 0 OR k % 5 <> 1) AS has_date FROM s2 JOIN c ON s2.y = c.y
           WHERE found AND (c.cut IS NULL OR n <= c.cut)),
     r2 AS (SELECT *, CASE WHEN has_date THEN d ELSE make_date(y, 1, 1) END AS cd FROM r)
{oracle_select(
    src="r2", region="'Calabria'",
    law_title="CASE WHEN k % 5 = 0 THEN concat('Legge Regionale n. ', cast(n as string)) ELSE concat('Disposizioni urgenti per la regione numero ', cast(k as string)) END",
    law_number="cast(n as string)",
    date_text=f"CASE WHEN has_date THEN concat({DAY}, ' ', {IT}, ' ', {YEAR}) ELSE cast(y as string) END",
    law_date="cd", filename=f"concat('Calabria_', cast(n as string), '_', {_CAL_ISO}, '.pdf')")}"""


# operators each region job exercises besides its own profile
REG_OPS = {
    "basilicata": "NUM-4 DAT-2",
    "campania": "HTM-3 HTM-4 NUM-1 PRD-7 SET-1 TXT-2 DAT-1",
    "friuli": "HTM-4 PRD-9 DAT-4 DAT-10 NUM-1 KEY-1",
    "lazio": "HTM-0 HTM-9 KEY-2 TXT-5 DAT-4",
    "liguria": "HTM-3 HTM-4 HDR-1 HDR-2 DAT-6",
    "toscana": "HTM-3 HTM-4 HDR-1 HDR-2 DAT-6",
    "lombardia": "HTM-2 URL-2 DAT-6",
    "marche": "HTM-8 SET-1 DAT-10 DAT-1",
    "molise": "HTM-3 NUM-2 DAT-4",
    "piemonte": "HTM-0 PRD-1 NUM-1 TXT-4",
    "puglia": "HTM-4 TXT-4 DAT-2",
    "sardinia": "HTM-0 URL-2 TXT-3 DAT-4",
    "trentino": "HTM-0 HTM-13 DAT-5 DAT-7 DAT-8 KEY-3 NUM-1",
    "umbria": "HTM-3 NUM-1 DAT-1",
    "veneto": "HTM-4 TXT-3 DAT-1",
    "aosta": "HTM-0 NUM-3 PRD-2 TXT-7 SET-1 URL-2 URL-3",
    "emilia": "HTM-2 TXT-8 URL-1 TXT-10 TXT-3",
}


def _register(key: str):
    def spark_fn(spark, sf):
        return RG.EXTRACTORS[key](view(spark, sf, f"pages_{key}"))

    spark_fn.__name__ = f"reg_{key}"
    query(f"reg_{key}", ORACLE_SELECTS[key], views=["law_headers"], ops=f"REG {key} {REG_OPS.get(key, '')}".strip())(spark_fn)


for _key in RG.EXTRACTORS:
    _register(_key)


def _captures(spark, sf):
    """The captures with a header map and a BINARY body."""
    caps = view(spark, sf, "calabria_captures").withColumn("body", F.encode("body_text", "UTF-8"))
    return caps.withColumn("headers", F.create_map(F.lit("Content-Disposition"), "content_disposition")).drop("body_text", "content_disposition")


def calabria(spark, sf):
    return RG.extract_calabria(_captures(spark, sf))


query("reg_calabria", CALABRIA_ORACLE, views=["calabria_captures"],
      ops="REG calabria SRC-5 WIN-1 PRD-3 HTM-14 HTM-15 DAT-7")(calabria)


@query("src_read_captures", """
SELECT y, n, (status = 200 AND left(body_text, 4) = '%PDF') AS found, content_disposition FROM calabria_captures""",
       views=["calabria_captures"], ops="SRC-2 PRD-3")
def src_read_captures(spark, sf):
    from regesto.sources.readers import read_captures
    from regesto.streaming.stream import scratch_dir

    path = scratch_dir(spark, "captures")
    _captures(spark, sf).write.parquet(path)
    header = F.try_element_at("headers", F.lit("Content-Disposition")).alias("content_disposition")
    return read_captures(spark, path).select("y", "n", P.is_valid_capture("status", "body").alias("found"), header)


def all_regions(spark, sf):
    """REG-ALL: every region into one canonical index (SET-5)."""
    parts = [RG.EXTRACTORS[k](view(spark, sf, f"pages_{k}")) for k in RG.EXTRACTORS]
    parts.append(calabria(spark, sf))
    return S.union_indexes(*parts)


query(
    "reg_all",
    "SELECT * FROM (\n"
    + "\nUNION ALL\n".join(f"({ORACLE_SELECTS[k]})" for k in RG.EXTRACTORS)
    + f"\nUNION ALL\n(SELECT * FROM ({CALABRIA_ORACLE.strip().replace(chr(10), ' ')}) cal))",
    views=["law_headers", "calabria_captures"], ops="REG-ALL SET-5",
)(all_regions)


# ------------------------------------------------------------------ shape A end to end
from regesto.plans import flows as FL  # noqa: E402
from regesto.sources.fixtures import VIEW_DEPS, VIEW_SQL  # noqa: E402

_LAZIO_FILE = f"""CASE WHEN {FORM} = 3 THEN concat('Lazio_ID_', {ID}, '_unknown_date.pdf')
                     ELSE concat('Lazio_', {NO}, '_', CASE WHEN {FORM} = 2 THEN {DITD} ELSE {DIT} END, '.pdf') END"""
VIEW_SQL["lazio_done"] = "SELECT o_orderkey AS law_id FROM orders WHERE o_orderstatus = 'O'"
VIEW_SQL["lazio_inventory"] = f"""
SELECT DISTINCT {_LAZIO_FILE} AS name FROM law_headers JOIN orders ON law_id = o_orderkey WHERE o_orderstatus = 'P'"""
VIEW_DEPS["lazio_inventory"] = ("law_headers",)

_LAZIO_COLS = ", ".join(c for c, _ in RG.LAW_INDEX if c != "status")


@query("flow_lazio", f"""
SELECT {_LAZIO_COLS}, status FROM (
  SELECT *, row_number() OVER (PARTITION BY filename ORDER BY source_url) AS r FROM (
    SELECT {_LAZIO_COLS},
           cast(CASE WHEN filename IN (SELECT name FROM lazio_inventory) THEN 'Skipped (Exists)' ELSE 'Pending' END as varchar) AS status
    FROM ({ORACLE_SELECTS['lazio']}) x
    WHERE cast(regexp_extract(source_url, 'id=([0-9]+)', 1) as bigint) NOT IN (SELECT law_id FROM lazio_done)))
WHERE r = 1""", views=["law_headers", "lazio_done", "lazio_inventory"], ops="shape A: JON-1 REG-05 JON-2 CND-2 SET-4")
def flow_lazio(spark, sf):
    pages = view(spark, sf, "pages_lazio")
    return FL.index_pages("lazio", pages, done_ids=view(spark, sf, "lazio_done"), id_param="id",
                          inventory=view(spark, sf, "lazio_inventory"))
