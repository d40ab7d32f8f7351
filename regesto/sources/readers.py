"""Scans and generated key spaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
])

LAW_INDEX_SCHEMA = T.StructType([
    T.StructField("region", T.StringType()), T.StructField("law_title", T.StringType()),
    T.StructField("law_number", T.StringType()), T.StructField("law_number_int", T.IntegerType()),
    T.StructField("date_text", T.StringType()), T.StructField("law_date", T.DateType()),
    T.StructField("filename", T.StringType()), T.StructField("source_url", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("doc_type", T.StringType()), T.StructField("page_no", T.IntegerType()),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata-only check through the Hadoop FileSystem of the path (works for shared stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-1: page snapshots ``(page_id, url, html)``.  ``fmt='html'`` reads a folder of html
    files, one row per file (``wholetext``), the file path as url and its hash as id."""
    if fmt == "parquet":
        return spark.read.parquet(path).select("page_id", "url", "html")
    df = spark.read.text(path, wholetext=True)
    url = F.input_file_name()
    return df.select(F.xxhash64(url).alias("page_id"), url.alias("url"), F.col("value").alias("html"))


# What an archive's records begin with, and the names of the headers that count.
ARCHIVE_MARK = "WARC/1.0\r\n"
ARCHIVE_URI, HTTP_MARK = "WARC-Target-URI", "HTTP/"


def read_archive(spark: SparkSession, path: str, url_pattern: str | None = None) -> DataFrame:
    """SRC-1 / SRC-2: page archives of many records per file -> (url, status, headers, html, complete).

    The text reader splits an archive by byte ranges at the records' first lines, so one file is read
    by many tasks and no record by two.  ``url_pattern`` is tested on the record as the scan yields it,
    before anything else is parsed.  Records that are no responses are left out; ``complete`` tells
    whether the body is as long as its Content-Length says.  Archives must be uncompressed."""
    raw = spark.read.option("lineSep", ARCHIVE_MARK).text(path)
    url = F.regexp_extract("value", rf"(?i)^[^\x00]*?{ARCHIVE_URI}:[ \t]*([^\r\n]*)", 1)
    parts = raw.filter(F.col("value").contains("\r\n\r\n" + HTTP_MARK))
    if url_pattern:
        parts = parts.filter(url.rlike(url_pattern))
    # a record: its own headers, an empty line, the response's status and headers, an empty line, the body
    cut = F.split("value", "\r\n\r\n", 3)
    x = parts.select(url.alias("url"), F.get(cut, F.lit(1)).alias("head"), F.regexp_replace(F.coalesce(F.get(cut, F.lit(2)), F.lit("")), r"\r\n\r\n\z", "").alias("html"))
    lines = F.slice(F.split("head", "\r\n"), F.lit(2), F.greatest(F.size(F.split("head", "\r\n")) - 1, F.lit(0)))
    pairs = F.transform(lines, lambda line: F.struct(F.lower(F.trim(F.substring_index(line, ":", 1))).alias("key"), F.trim(F.regexp_replace(line, "^[^:]*:", "")).alias("value")))
    names = F.transform(pairs, lambda p: p["key"])
    headers = F.map_from_entries(F.filter(pairs, lambda p, i: F.array_position(names, p["key"]) == i + 1))
    x = x.select("url", F.regexp_extract("head", r"^HTTP/\S+ (\d{3})", 1).try_cast("int").alias("status"), headers.alias("headers"), "html")
    length = F.try_element_at("headers", F.lit("content-length")).try_cast("long")
    return x.withColumn("complete", F.coalesce(length == F.octet_length("html"), F.lit(False)))


def write_archive(pages: DataFrame, path: str) -> None:
    """Pages (url, status, html) as archives that ``read_archive`` reads; one file per task."""
    head = F.concat(F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(" -\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"))
    record = F.concat(F.lit(f"{ARCHIVE_MARK}WARC-Type: response\r\n{ARCHIVE_URI}: "), F.col("url"), F.lit("\r\n\r\n"), head, F.lit("\r\n\r\n"), F.col("html"))
    pages.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-2: binary captures ``(url, status, headers, body, ...)``.  ``fmt='binaryFile'`` reads raw
    files; what was never captured with them, status and headers, is NULL."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    df = spark.read.format("binaryFile").load(path)
    return df.select(
        F.col("path").alias("url"), F.lit(None).cast("int").alias("status"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.col("content").alias("body"),
    )


def read_index(spark: SparkSession, path: str, schema: T.StructType = LAW_INDEX_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """SRC-3: the prior index; an absent path is an empty frame with the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


STATE_SETS = (("done_keys", "string"), ("done_years", "int"), ("done_ids", "string"))


def read_state(spark: SparkSession, path: str, multiline: bool = False) -> dict[str, DataFrame]:
    """SRC-4: resume state -> one DataFrame per set (``key``, ``year``, ``id``), one row per entry.

    Reads the row form that ``write_state`` writes (one entry per line, split among tasks), or with
    ``multiline`` a small JSON object ``{done_keys: [...], done_years: [...], done_ids: [...]}``
    as the scripts keep it (such a file is one row).  The schema is given: no pass infers it."""
    kinds = {n: f"array<{t}>" if multiline else t for n, t in STATE_SETS}
    raw = spark.read.schema(", ".join(f"{n} {t}" for n, t in kinds.items())).option("multiLine", multiline).json(path)
    out = {}
    for name, typ in STATE_SETS:
        short = name.removeprefix("done_").rstrip("s")
        col = F.col(name)
        if isinstance(raw.schema[name].dataType, T.ArrayType):
            out[name] = raw.select(F.explode(col).alias(short)).select(F.col(short).cast(typ).alias(short)).distinct()
        else:
            out[name] = raw.where(col.isNotNull()).select(col.cast(typ).alias(short)).distinct()
    return out


def key_grid(spark: SparkSession, y0: int | None, y1: int | None, n_max: int | DataFrame, k: int = 0, url_fmt: str | None = None) -> DataFrame:
    """SRC-5: every (year, number) probe key, and its URL if ``url_fmt`` (``%d`` year, ``%d`` number).
    ``n_max`` is a number or a DataFrame ``(y, n_max)`` of per-year maxima; ``k`` extra probes.
    Without ``y0`` and ``y1`` the years are those of the DataFrame."""
    if y0 is None or y1 is None:
        years = n_max.select("y")
    else:
        years = spark.range(y0, y1 + 1).select(F.col("id").cast("int").alias("y"))
    if isinstance(n_max, DataFrame):
        years = years.join(n_max, ["y"], "left").select("y", (F.coalesce("n_max", F.lit(0)) + k).alias("top"))
    else:
        years = years.select("y", F.lit(int(n_max) + k).alias("top"))
    out = years.select("y", F.explode(F.sequence(F.lit(1), F.greatest(F.col("top"), F.lit(1)))).alias("n"))
    if url_fmt:
        out = out.withColumn("url", F.format_string(url_fmt, F.col("y"), F.col("n")))
    return out.withColumn("key", F.concat_ws("_", "y", "n"))


def page_grid(spark: SparkSession, base: str, p0: int, p1: int, years: DataFrame | None = None,
              year_col: str = "year") -> DataFrame:
    """SRC-6: listing URLs per page (``base`` with ``{page}``), or per (year, page) with ``{year}``;
    years come from data (e.g. the distinct years of a tree), newest first when ordered."""
    pages = F.explode(F.sequence(F.lit(p0), F.lit(p1))).alias("page")
    if years is None:
        out = spark.range(1).select(pages)
        return out.select("page", F.replace(F.lit(base), F.lit("{page}"), F.col("page").cast("string")).alias("url"))
    out = years.select(F.col(year_col).cast("int").alias("year")).distinct().select("year", pages)
    url = F.replace(F.replace(F.lit(base), F.lit("{page}"), F.col("page").cast("string")), F.lit("{year}"), F.col("year").cast("string"))
    return out.select("year", "page", url.alias("url"))


def file_inventory(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """SRC-7: stored files with name, mtime and size; the ``content`` column is never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select(
        F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("modificationTime").alias("mtime"), F.col("length"),
    )
