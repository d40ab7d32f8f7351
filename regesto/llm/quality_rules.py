"""Operator 10: quality rules with adaptive thresholds, in DataFrame functions only.

Statistics of each whole text become integers.  Per language and source, a mergeable quantile
sketch of each statistic is the count of documents per bucket, where a bucket keeps the six
leading bits of the value (relative error under 1/32, at most 64 buckets per power of two):
partial counts add up, so Spark combines them before the shuffle and a source with a third of all
rows costs no more than another.  Each threshold is the upper fence Q3 + ``FENCE`` * (Q3 - Q1) +
a resolution in the statistic's unit, read from the sketch of the document's (language, source),
or of its language, or of all, whichever is the first with ``MIN_DOCS`` documents.  Documents are
joined with the thresholds and filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, table

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SHINGLE = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FENCE = 3
MIN_DOCS = 100

#: Statistic -> resolution: shares in thousandths, the mean word length in hundredths of a character.
STATISTICS = {"symbol_share": 50, "dup_line_share": 200, "repeat_share": 100, "word_length": 200}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (long).

    Null and empty texts give zeros.  Windows of five words are compared by 64-bit hashes.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    with_words = docs.withColumn("_words", words_of(F.col(text)))
    with_words = with_words.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*[F.get(F.col("_hash"), i + k) for k in range(SHINGLE)])
    grams = F.when(
        F.size("_hash") >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size("_hash") - SHINGLE), window)
    ).otherwise(F.array().cast("array<bigint>"))
    with_grams = with_words.withColumn("_grams", grams)

    def repeated(pairs: Column) -> Column:
        """Words covered by windows whose neighbour in (hash, place) order has the same hash."""
        same = lambda x, k: (F.get(pairs, k - 1)["g"] == x["g"]) | (F.get(pairs, k + 1)["g"] == x["g"])
        return F.filter(pairs, lambda x, k: F.coalesce(same(x, k), F.lit(False)))

    pairs = F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    starts = F.transform(F.array(pairs), repeated)[0]
    starts = F.array_sort(F.transform(starts, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-SHINGLE).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(SHINGLE), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    has_repeat = F.size(F.array_distinct("_grams")) < F.size("_grams")
    lines = F.array_remove(F.split(t, "\n", -1), "")
    lines = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    with_lines = with_grams.withColumn("_lines", lines)
    counts = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(has_repeat, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    # a filter on a generated column is not pushed below, where it would compute all this anew
    return with_lines.select(*docs.columns, F.inline(F.array(counts)))


def with_shares(stats: DataFrame) -> DataFrame:
    """The integer statistics that are sketched, and ``base_failed``."""
    share = lambda a, b, unit: F.expr(f"coalesce(({unit} * {a}) div nullif({b}, 0), 0)")
    return stats.withColumns(
        {
            "symbol_share": share("n_symbols", "n_words", 1000),
            "dup_line_share": share("n_dup_lines", "n_lines", 1000),
            "repeat_share": share("n_repeat_words", "n_words", 1000),
            "word_length": share("word_chars", "n_words", 100),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )


def sketch(stats: DataFrame) -> DataFrame:
    """lang, source, statistic, bucket, n: the mergeable sketch of each group."""
    each = stats.select(
        "lang", "source", F.explode(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("v")) for s in STATISTICS])).alias("x")
    ).select("lang", "source", "x.*")
    bucket = F.when(F.col("v") < 64, F.col("v")).otherwise(
        F.expr("shiftleft(shiftright(v, length(bin(v)) - 6), length(bin(v)) - 6)")
    )
    return each.groupBy("lang", "source", "statistic", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketches: DataFrame) -> DataFrame:
    """lang, source and one threshold column per statistic (one row per language and source)."""
    own = sketches.withColumn("level", F.lit(2))
    by_lang = sketches.groupBy("lang", "statistic", "bucket").agg(F.sum("n").alias("n"))
    by_lang = by_lang.withColumn("source", F.lit(None).cast("string")).withColumn("level", F.lit(1))
    whole = by_lang.groupBy("statistic", "bucket").agg(F.sum("n").alias("n"))
    whole = whole.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "level": F.lit(0)})
    key = ["level", "lang", "source", "statistic"]
    cols = [*key, "bucket", "n"]
    merged = own.select(*cols).unionByName(by_lang.select(*cols)).unionByName(whole.select(*cols))
    up_to = Window.partitionBy(*key).orderBy("bucket")
    ranked = merged.withColumns({"upto": F.sum("n").over(up_to), "total": F.sum("n").over(Window.partitionBy(*key))})
    at = lambda percent: F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("bucket")))
    quartiles = ranked.groupBy(*key).agg(at(25).alias("q1"), at(75).alias("q3"), F.max("total").alias("total"))
    resolution = F.create_map(*[F.lit(x) for kv in STATISTICS.items() for x in kv])
    cut = F.col("q3") + FENCE * (F.col("q3") - F.col("q1")) + resolution[F.col("statistic")]
    per = quartiles.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("statistic") == s, cut)).alias(f"max_{s}") for s in STATISTICS]
    )
    cuts = [f"max_{s}" for s in STATISTICS]
    packed = F.struct("total", *cuts).alias("x")
    two = per.where("level = 2").select("lang", "source", packed)
    one = per.where("level = 1").select(F.col("lang").alias("lang1"), packed)
    zero = per.where("level = 0").select(packed)
    joined = two.join(one.withColumnRenamed("x", "x1"), F.col("lang").eqNullSafe(F.col("lang1")), "left").join(
        F.broadcast(zero.withColumnRenamed("x", "x0"))  # one row
    )
    chosen = F.when(F.col("x.total") >= MIN_DOCS, F.col("x")).when(F.col("x1.total") >= MIN_DOCS, F.col("x1")).otherwise(F.col("x0"))
    return joined.select("lang", "source", chosen.alias("x")).select("lang", "source", *[F.col(f"x.{c}") for c in cuts])


def verdict(stats: DataFrame, cuts: DataFrame) -> DataFrame:
    """``stats`` joined with the thresholds, plus ``kept``."""
    c = cuts.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"max_{s}" for s in STATISTICS])
    joined = stats.join(c, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = F.lit(True)
    for s in STATISTICS:
        within = within & (F.col(s) <= F.col(f"max_{s}"))
    return joined.withColumn("kept", ~F.col("base_failed") & within).drop("_lang", "_source")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` per row of ``docs`` (doc_id, text, lang, source).

    Null lang or source is a group of its own; null and empty texts have no words and fail the
    base rule.  Repeated rows count as often as they come.  Other columns do not matter.
    """
    stats = with_shares(text_statistics(docs.select("doc_id", "text", "lang", "source"))).drop("text")
    stats = materialise(stats, "quality-statistics")  # a few integers per document, used twice
    return verdict(stats, fences(sketch(stats)))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The statistics are computed again rather than stored with the texts.
    """
    names = docs.columns
    bare = docs.select("text", "lang", "source")
    cuts = materialise(fences(sketch(with_shares(text_statistics(bare)))), "quality-thresholds")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text", "lang", "source")
    return verdict(with_shares(text_statistics(held)), cuts).where("kept").select("_row.*")


SQL = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), n AS (
  SELECT row_number() OVER () AS rid, * FROM w
), grams AS (
  SELECT rid, i, words[i:i+4] AS g
  FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM n)
), dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM dup, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid
), lines AS (
  SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM n) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), line_counts AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY rid
), s AS (
  SELECT rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM n LEFT JOIN covered USING (rid) LEFT JOIN line_counts USING (rid)
), m AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
         coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS symbol_share,
         coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_line_share,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeat_share,
         coalesce(100 * word_chars // nullif(n_words, 0), 0) AS word_length
  FROM s
), v AS (
  SELECT rid, lang, source, 'symbol_share' AS statistic, 50 AS res, symbol_share AS v FROM m
  UNION ALL SELECT rid, lang, source, 'dup_line_share', 200, dup_line_share FROM m
  UNION ALL SELECT rid, lang, source, 'repeat_share', 100, repeat_share FROM m
  UNION ALL SELECT rid, lang, source, 'word_length', 200, word_length FROM m
), b AS (
  SELECT rid, lang, source, statistic, res, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b FROM v
), r AS (
  SELECT statistic, res, lang, source, b,
    count(*) OVER (PARTITION BY statistic, lang, source ORDER BY b) AS u2, count(*) OVER (PARTITION BY statistic, lang, source) AS t2,
    count(*) OVER (PARTITION BY statistic, lang ORDER BY b) AS u1, count(*) OVER (PARTITION BY statistic, lang) AS t1,
    count(*) OVER (PARTITION BY statistic ORDER BY b) AS u0, count(*) OVER (PARTITION BY statistic) AS t0
  FROM b
), f2 AS (
  SELECT statistic, lang, source, max(res) AS res, max(t2) AS t2, min(CASE WHEN 100 * u2 >= 25 * t2 THEN b END) AS a2, min(CASE WHEN 100 * u2 >= 75 * t2 THEN b END) AS c2
  FROM r GROUP BY ALL
), f1 AS (
  SELECT statistic, lang, max(t1) AS t1, min(CASE WHEN 100 * u1 >= 25 * t1 THEN b END) AS a1, min(CASE WHEN 100 * u1 >= 75 * t1 THEN b END) AS c1
  FROM r GROUP BY ALL
), f0 AS (
  SELECT statistic, min(CASE WHEN 100 * u0 >= 25 * t0 THEN b END) AS a0, min(CASE WHEN 100 * u0 >= 75 * t0 THEN b END) AS c0
  FROM r GROUP BY ALL
), cut AS (
  SELECT f2.lang, f2.source, f2.statistic,
    CASE WHEN t2 >= 100 THEN c2 + 3 * (c2 - a2) WHEN t1 >= 100 THEN c1 + 3 * (c1 - a1) ELSE c0 + 3 * (c0 - a0) END + res AS cut
  FROM f2 JOIN f1 ON f2.statistic = f1.statistic AND f2.lang IS NOT DISTINCT FROM f1.lang JOIN f0 ON f0.statistic = f2.statistic
), ok AS (
  SELECT v.rid, bool_and(v.v <= cut.cut) AS ok
  FROM v JOIN cut ON v.statistic = cut.statistic AND v.lang IS NOT DISTINCT FROM cut.lang AND v.source IS NOT DISTINCT FROM cut.source
  GROUP BY v.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM m JOIN ok USING (rid)
"""

OUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_quality_rules", oracle=SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(*OUT)
