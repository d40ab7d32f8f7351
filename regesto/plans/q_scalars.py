"""Checks for the scalar functions on the driver tables and derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import keys as K
from regesto.functions import numbers as N
from regesto.functions import text as T
from regesto.functions import urls as U
from regesto.plans.registry import query
from regesto.sources.fixtures import IT_MONTHS_CSV, many, spread, table, view

# DuckDB spellings shared by the oracles below.
WS = r"[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm_ws_sql(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
IT_NAME = f"split_part('{IT_MONTHS_CSV}', ',', month(d))"


def law_index_from_headers(lh):
    """Flagship slice: header text -> typed law record with the Liguria-style display and file name."""
    h = N.header_fields("hdr")
    return lh.select("law_id", "region", h.alias("h")).select(
        "law_id",
        "region",
        F.col("h.law_no").alias("law_number"),
        T.to_int_or_null("h.law_no").alias("law_number_int"),
        F.col("h.law_date").alias("law_date"),
        D.date_display("h.law_date", "d_english").alias("date_text"),
        K.law_filename(
            F.col("region"),
            F.coalesce(F.col("h.law_no"), F.lit("Unknown")),
            F.coalesce(D.date_display("h.law_date", "iso"), F.lit("0000-00-00")),
        ).alias("filename"),
    )


LAW_HEADERS_ORACLE = """
SELECT law_id, region,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE cast(no as string) END AS law_number,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE no END AS law_number_int,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE d END AS law_date,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE strftime(d, '%-d %B %Y') END AS date_text,
  concat(region, '_', CASE WHEN law_id % 4 = 3 THEN 'Unknown' ELSE cast(no as string) END, '_',
         CASE WHEN law_id % 4 = 3 THEN '0000-00-00' ELSE strftime(d, '%Y-%m-%d') END, '.pdf') AS filename
FROM law_headers"""


@query("law_headers_index", LAW_HEADERS_ORACLE, views=["law_headers"],
       ops="HDR-1 HDR-2 DAT-1 DAT-2 DAT-3 DAT-6 TXT-11 KEY-1")
def law_headers_index(spark, sf):
    return law_index_from_headers(spread(view(spark, sf, "law_headers")))


UNSAFE_SQL = r"""'[\\/*?:"<>|]'"""
UNSAFE_NO_SLASH_SQL = r"""'[*:?"<>|]'"""


@query("txt_clean_names", f"""
SELECT doc_id,
  {norm_ws_sql('text')} AS clean_text,
  regexp_replace(text, {UNSAFE_SQL}, '_', 'g') AS name_us,
  {strip_sql(f"regexp_replace(text, {UNSAFE_SQL}, '', 'g')")} AS name_del,
  left({strip_sql(f"replace(regexp_replace(text, {UNSAFE_SQL}, '', 'g'), chr(10), ' ')")}, 50) AS name_50,
  CASE WHEN text IS NULL OR text = '' THEN 'Unknown' ELSE
    trim(regexp_replace(regexp_replace(translate(text, '/\\', '--'), {UNSAFE_NO_SLASH_SQL}, '', 'g'), '{WS}+', ' ', 'g')) END AS name_sp
FROM documents""", ops="TXT-1 TXT-2 TXT-3 TXT-4 TXT-5")
def txt_clean_names(spark, sf):
    d = many(table(spark, sf, "documents"))
    return d.select(
        "doc_id",
        T.norm_ws("text").alias("clean_text"),
        T.safe_name_underscore("text").alias("name_us"),
        T.safe_name_delete("text", trim=True).alias("name_del"),
        T.safe_name_50("text").alias("name_50"),
        T.safe_name_spaces("text").alias("name_sp"),
    )


@query("txt_misc", """
SELECT doc_id,
  translate(lower(text), '’`‘', '''''''') AS quotes,
  replace(text, 'the', '') AS no_the,
  left(text, 1000) AS title_1000,
  left(text, 60) AS msg_60,
  concat(upper(left(lang, 1)), lower(substring(lang, 2))) AS lang_cap,
  lpad(regexp_extract(source, '[0-9]+', 0), cast(greatest(2, length(regexp_extract(source, '[0-9]+', 0))) as int), '0') AS src_no2,
  cast(regexp_extract(source, '[0-9]+', 0) as int) AS src_no,
  try_cast(NULL as int) AS lang_no
FROM documents""", ops="TXT-6 TXT-7 TXT-8 TXT-9 TXT-10 TXT-11")
def txt_misc(spark, sf):
    d = many(table(spark, sf, "documents"))
    src_digits = F.regexp_extract("source", r"[0-9]+", 0)
    return d.select(
        "doc_id",
        T.norm_quotes("text").alias("quotes"),
        T.strip_phrase("text", "the").alias("no_the"),
        T.truncate_title("text", 1000).alias("title_1000"),
        T.truncate_title("text", 60).alias("msg_60"),
        T.cap_month("lang").alias("lang_cap"),
        T.zfill2(src_digits).alias("src_no2"),
        T.to_int_or_null(src_digits).alias("src_no"),
        T.to_int_or_null("lang").alias("lang_no"),
    )


_LINES = (
    f"list_filter(list_transform(regexp_split_to_array(text, '{LINE_BREAK}'), "
    f"lambda x: {strip_sql('x')}), lambda x: x <> '')"
)


@query("txt_lines_title", f"""
SELECT doc_id,
  cast(len({_LINES}) as int) AS n_lines,
  coalesce(list_filter({_LINES}, lambda x: NOT starts_with(lower(x), 'legge regionale') AND length(x) > 20)[1], '') AS title_line
FROM documents""", ops="TXT-12 HTM-14")
def txt_lines_title(spark, sf):
    d = many(table(spark, sf, "documents"))
    return d.select(
        "doc_id",
        F.size(T.lines_split("text")).alias("n_lines"),
        T.first_title_line("text").alias("title_line"),
    )


@query("dat_display_roundtrip", f"""
SELECT law_id,
  strftime(d, '%d/%m/%Y') AS dmy, strftime(d, '%d-%m-%Y') AS dmy_dash, strftime(d, '%Y-%m-%d') AS iso,
  concat(cast(day(d) as string), ' ', {IT_NAME}, ' ', cast(year(d) as string)) AS d_month,
  concat(cast(day(d) as string), ' ', upper(left({IT_NAME}, 1)), substring({IT_NAME}, 2), ' ', cast(year(d) as string)) AS d_Month_,
  concat(lpad(cast(day(d) as string), 2, '0'), ' ', {IT_NAME}, ' ', cast(year(d) as string)) AS dd_month,
  strftime(d, '%-d %B %Y') AS d_english,
  d AS back_it, d AS back_slash, d AS back_any
FROM law_headers""", views=["law_headers"], ops="DAT-6 DAT-1 DAT-2 DAT-4")
def dat_display_roundtrip(spark, sf):
    lh = view(spark, sf, "law_headers")
    return lh.select(
        "law_id",
        D.date_display("d", "dmy").alias("dmy"),
        D.date_display("d", "dmy_dash").alias("dmy_dash"),
        D.date_display("d", "iso").alias("iso"),
        D.date_display("d", "d_month").alias("d_month"),
        D.date_display("d", "d_Month").alias("d_Month_"),
        D.date_display("d", "dd_month").alias("dd_month"),
        D.date_display("d", "d_english").alias("d_english"),
        D.it_date(D.date_display("d", "d_Month")).alias("back_it"),
        D.slash_date(D.date_display("d", "dmy_dash")).alias("back_slash"),
        D.any_date(D.date_display("d", "dd_month")).alias("back_any"),
    )


@query("dat_parse_variants", """
SELECT law_id,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE d END AS any_d,
  d AS bilingual_d,
  CASE WHEN law_id % 4 IN (1, 3) THEN make_date(year(d), 1, 1) ELSE d END AS d_or_year,
  d AS first_d,
  CASE law_id % 4 WHEN 3 THEN hdr WHEN 1 THEN hdr ELSE strftime(d, '%d/%m/%Y') END AS passthrough,
  strftime(d, '%d-%m-%Y') AS dashed
FROM law_headers""", views=["law_headers"], ops="DAT-4 DAT-5 DAT-7 DAT-8 DAT-9 DAT-10")
def dat_parse_variants(spark, sf):
    lh = view(spark, sf, "law_headers")
    bil_input = (
        F.when(F.col("law_id") % 3 == 0, F.concat(F.lit("Data "), F.date_format("d", "d.M.yyyy")))
        .when(F.col("law_id") % 3 == 1, F.date_format("d", "d MMMM yyyy"))
        .otherwise(F.date_format("d", "MMMM d, yyyy"))
    )
    candidates = F.array(F.lit("nessuna data"), F.col("hdr"), F.date_format("d", "dd/MM/yyyy"))
    return lh.select(
        "law_id",
        D.any_date("hdr").alias("any_d"),
        D.bilingual_date(bil_input).alias("bilingual_d"),
        D.date_or_year(D.it_date("hdr"), title="hdr", year=F.year("d")).alias("d_or_year"),
        D.first_date(candidates).alias("first_d"),
        D.date_passthrough(D.it_date("hdr"), "hdr", "dmy").alias("passthrough"),
        D.dash_date(D.date_display("d", "dmy"), "/").alias("dashed"),
    )


@query("num_variants", """
SELECT law_id,
  CASE WHEN law_id % 4 = 3 THEN NULL ELSE cast(no as string) END AS strict_no,
  cast(no as string) AS loose_no, cast(no as string) AS alt_no, cast(no as string) AS chain_no,
  cast(no as string) AS cell_no, CAST(NULL AS string) AS cell_date
FROM law_headers""", views=["law_headers"], ops="NUM-1 NUM-2 NUM-3 NUM-4")
def num_variants(spark, sf):
    lh = view(spark, sf, "law_headers")
    no = F.col("no").cast("string")
    alt = F.concat(
        F.when(F.col("law_id") % 3 == 0, F.lit("n. ")).when(F.col("law_id") % 3 == 1, F.lit("num. ")).otherwise(F.lit("numero ")),
        no,
    )
    chain_in = F.concat(F.when(F.col("law_id") % 2 == 0, F.lit("Legge ")).otherwise(F.lit("regionale ")), no)
    cell = F.when(F.col("law_id") % 2 == 0, no).otherwise(F.concat(F.lit("n. "), no))
    return lh.select(
        "law_id",
        N.law_no("hdr").alias("strict_no"),
        N.law_no(F.concat(F.lit("n "), no), loose=True).alias("loose_no"),
        N.law_no_alt(alt).alias("alt_no"),
        N.law_no_text_chain(chain_in).alias("chain_no"),
        N.cell_number(cell).alias("cell_no"),
        N.cell_number(F.date_format("d", "dd/MM/yyyy")).alias("cell_date"),
    )


@query("key_doc_language", """
SELECT law_id, pos, href,
  CASE WHEN contains(lower(href), '_it') OR contains(lower(href), '-it.') THEN 'IT'
       WHEN contains(lower(href), '_st') OR contains(lower(href), '-st.') OR contains(lower(href), '_de') THEN 'DE'
       ELSE 'DOC' END AS doc_type
FROM law_docs""", views=["law_docs"], ops="KEY-3")
def key_doc_language(spark, sf):
    return view(spark, sf, "law_docs").select("law_id", "pos", "href", K.doc_language("href").alias("doc_type"))


@query("key_filename_roundtrip", """
SELECT law_id, concat(region, '_', cast(no as string), '_', strftime(d, '%Y-%m-%d'), '.pdf') AS filename,
  region AS p_region, cast(no as string) AS p_number, d AS p_date, cast(year(d) as int) AS p_year
FROM law_headers""", views=["law_headers"], ops="KEY-1 KEY-4")
def key_filename_roundtrip(spark, sf):
    lh = view(spark, sf, "law_headers").select(
        "law_id", K.law_filename(F.col("region"), "no", D.date_display("d", "iso")).alias("filename")
    )
    p = K.parse_filename("filename")
    return lh.select(
        "law_id", "filename",
        p["region"].alias("p_region"), p["law_number"].alias("p_number"),
        p["law_date"].alias("p_date"), p["year"].alias("p_year"),
    )


@query("key_fallback", """
SELECT page_no, pos,
  CASE WHEN pos % 2 = 0 THEN concat('ID_', regexp_extract(url, 'pk_lr=([0-9]+)', 1)) ELSE cast(pos as string) END AS key
FROM listing""", views=["listing"], ops="KEY-2 URL-3")
def key_fallback(spark, sf):
    li = view(spark, sf, "listing")
    number = F.when(F.col("pos") % 2 == 1, F.col("pos").cast("string"))
    return li.select("page_no", "pos", K.fallback_key(number, "url", "pk_lr").alias("key"))


@query("cnd_status", """
SELECT k, event_id,
  CASE status WHEN 'Skipped' THEN 'Skipped (Exists)' WHEN 'Downloaded' THEN 'Downloaded'
              ELSE 'Failed (500)' END AS outcome,
  CASE WHEN attempt % 7 = 0 THEN 'N/A' ELSE cast(attempt as string) END AS number_text
FROM fetch_log""", views=["fetch_log"], ops="CND-1 CND-2")
def cnd_status(spark, sf):
    fl = view(spark, sf, "fetch_log")
    st = K.derive_status(
        exists=F.col("status") == "Skipped",
        ok=F.col("status") == "Downloaded",
        http_status=F.when(F.col("status") == "Failed", F.lit(500)),
    )
    number = F.when(F.col("attempt") % 7 != 0, F.col("attempt").cast("string"))
    out = fl.select("k", "event_id", st.alias("outcome"), number.alias("number_text"))
    return K.fill_defaults(out, {"number_text": "N/A"})


@query("url_parts", """
SELECT page_id,
  nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param,
  coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''), 'none') AS ref,
  regexp_replace(url, '[^/]*$', '') AS dir
FROM pages""", ops="URL-3 URL-4")
def url_parts(spark, sf):
    p = table(spark, sf, "pages")
    return p.select(
        "page_id",
        U.query_param("url", "page").alias("page_param"),
        U.query_param("url", "ref", "none").alias("ref"),
        U.url_dir("url").alias("dir"),
    )


@query("url_year_num", """
SELECT law_id,
  CASE WHEN law_id % 4 = 3 THEN 9999 ELSE cast(year(d) as int) END AS url_year,
  CASE WHEN law_id % 4 = 3 THEN 9999 ELSE no END AS url_num
FROM law_headers""", views=["law_headers"], ops="URL-5")
def url_year_num(spark, sf):
    lh = view(spark, sf, "law_headers")
    url = F.when(
        F.col("law_id") % 4 != 3,
        F.format_string("https://x.example/leggi/lr%d-%d.html", F.year("d"), F.col("no")),
    ).otherwise(F.lit("https://x.example/leggi/altro.html"))
    yn = U.year_num_from_url(url)
    return lh.select("law_id", yn["year"].alias("url_year"), yn["num"].alias("url_num"))


@query("hdr_parts", """
SELECT law_id,
  CASE WHEN law_id % 4 IN (0, 2) THEN d END AS d1, CASE WHEN law_id % 4 IN (0, 2) THEN cast(no as varchar) END AS n1,
  CASE WHEN law_id % 4 = 1 THEN d END AS d2, CASE WHEN law_id % 4 = 1 THEN cast(no as varchar) END AS n2,
  replace(hdr, '°', '') AS plain
FROM law_headers""", views=["law_headers"], ops="HDR-1 HDR-2 DAT-3")
def hdr_parts(spark, sf):
    """Both header forms on their own, and the header without ordinal marks."""
    from regesto.functions import dates as D
    from regesto.functions import numbers as N

    lh = view(spark, sf, "law_headers").select("law_id", "hdr", N.header_date_no("hdr").alias("a"), N.header_no_date("hdr").alias("b"))
    return lh.select(
        "law_id", F.col("a.law_date").alias("d1"), F.col("a.law_no").alias("n1"), F.col("b.law_date").alias("d2"), F.col("b.law_no").alias("n2"),
        D.ordinal_day("hdr").alias("plain"),
    )


@query("cnd_sentinels", """
SELECT law_id, CASE WHEN law_id % 4 = 3 THEN NULL ELSE cast(d as varchar) END AS date_back,
       CASE WHEN law_id % 4 = 3 THEN 'Unknown' ELSE cast(no as varchar) END AS law_number
FROM law_headers""", views=["law_headers"], ops="CND-1")
def cnd_sentinels(spark, sf):
    """Defaults filled in, and sentinels taken back."""
    from regesto.functions import keys as K

    known = F.col("law_id") % 4 != 3
    lh = view(spark, sf, "law_headers").select(
        "law_id", F.when(known, F.col("d").cast("string")).alias("date_text"), F.when(known, F.col("no").cast("string")).alias("law_number")
    )
    shown = K.fill_defaults(lh, {"date_text": "0000-00-00", "law_number": "Unknown"})
    return shown.select("law_id", K.null_sentinels("date_text").alias("date_back"), "law_number")
