"""Golden vectors: examples written in the reference's comments and docstrings."""

import datetime as dt

from pyspark.sql import functions as F

from regesto.functions import dates as D
from regesto.functions import keys as K
from regesto.functions import numbers as N
from regesto.functions import text as T
from regesto.operators import filters as P
from regesto.plans.regions import fvg_date_display


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("r")).first()["r"]


def test_italian_dates(spark):
    assert one(spark, "1° dicembre 2025", D.it_date) == dt.date(2025, 12, 1)
    assert one(spark, "9 dicembre 2025", D.it_date) == dt.date(2025, 12, 9)
    assert one(spark, "25 luglio 2025", D.it_date) == dt.date(2025, 7, 25)
    assert one(spark, "15° gennaio 2023, n. 12", D.it_date) == dt.date(2023, 1, 15)
    assert one(spark, "31 febbraio 2025", D.it_date) is None  # invalid day: NULL, never an error


def test_fvg_display(spark):
    assert one(spark, "25 marzo 1968", fvg_date_display) == "25/03/1968"
    assert one(spark, "", fvg_date_display) == "UnknownDate"
    assert one(spark, "senza data", fvg_date_display) == "senza data"
    assert one(spark, "25/03/1968", lambda c: D.dash_date(c, "/")) == "25-03-1968"


def test_any_date_forms(spark):
    for s in ("12 gennaio 2023", "12/01/2023", "12-01-2023"):
        assert one(spark, s, D.any_date) == dt.date(2023, 1, 12)


def test_headers(spark):
    for s, d, n in [
        ("Legge regionale 8 gennaio 2025, n. 3", dt.date(2025, 1, 8), "3"),
        ("n. 3 del 08/01/2025", dt.date(2025, 1, 8), "3"),
        ("Legge regionale 1° dicembre 2025, n. 33", dt.date(2025, 12, 1), "33"),
        ("Legge regionale n. 33 del 1° dicembre 2025", dt.date(2025, 12, 1), "33"),
        ("Legge regionale 25 luglio 2025, n.9", dt.date(2025, 7, 25), "9"),
    ]:
        h = one(spark, s, N.header_fields)
        assert (h["law_date"], h["law_no"]) == (d, n), s


def test_numbers(spark):
    assert [one(spark, s, N.law_no_alt) for s in ("n. 12", "num. 5", "numero 8", "3 marzo 2020, numero 5")] == ["12", "5", "8", "5"]
    for s in ("n. 123", "n.123", "n 123", "legge 123", "l. 123"):
        assert one(spark, s, N.law_no_text_chain) == "123", s
    assert one(spark, "50", N.cell_number) == "50"
    assert one(spark, "n. 50", N.cell_number) == "50"
    assert one(spark, "12/01/2023", N.cell_number) is None


def test_names(spark):
    assert one(spark, "10/12/2025", T.safe_name_spaces) == "10-12-2025"
    assert one(spark, "9 dicembre 2025", T.safe_name_spaces) == "9 dicembre 2025"
    assert one(spark, "", T.safe_name_spaces) == "Unknown"
    assert one(spark, 'a/b:c*?"<>|', T.safe_name_underscore) == "a_b_c______"
    assert one(spark, "  a  b \n c ", T.norm_ws) == "a b c"
    assert one(spark, "7", T.zfill2) == "07"
    assert one(spark, "123", T.zfill2) == "123"
    assert one(spark, "MARZO", T.cap_month) == "Marzo"
    name = spark.createDataFrame([("Lazio", "19", "9 dicembre 2025")], "r string, n string, d string")
    assert name.select(K.law_filename(F.col("r"), "n", "d").alias("f")).first()["f"] == "Lazio_19_9 dicembre 2025.pdf"


def test_repeal_rules(spark):
    df = spark.createDataFrame(
        [(1, "x (Abrogata) y"), (2, "( Abrogata )"), (3, "è abrogata"), (4, "Abrogazioni"), (5, "abrogata"),
         (6, "(Abrogata dall’art. 3)")], "id int, t string")
    kept = sorted(r["id"] for r in P.drop_repealed_strict(df, "t").collect())
    assert kept == [3, 4, 5, 6]  # the strict rule wants exactly "(Abrogata)"
    kept2 = sorted(r["id"] for r in P.drop_repealed_phrases(df, "t").collect())
    assert 6 not in kept2 and 3 in kept2


def test_doc_language(spark):
    vals = ["/a_it.pdf", "/a-it.pdf", "/a_st.pdf", "/a-st.pdf", "/a_de.pdf", "/a.pdf"]
    df = spark.createDataFrame([(v,) for v in vals], "h string")
    assert [r["k"] for r in df.select(K.doc_language("h").alias("k")).collect()] == ["IT", "IT", "DE", "DE", "DE", "DOC"]


def test_display_roundtrip_property(spark):
    """it_date(date_display(d)) == d for every day of several years."""
    days = spark.range(0, 366 * 4).select(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    bad = days.filter(~(D.it_date(D.date_display("d", "d_month")) == F.col("d"))
                      | ~(D.slash_date(D.date_display("d", "dmy")) == F.col("d"))).count()
    assert bad == 0
