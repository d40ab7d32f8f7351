"""Sources, sinks and the streaming form: stream = batch, and a restart gives the same index."""

import json

from pyspark.sql import functions as F

from regesto.operators.joins import todo
from regesto.sources import readers as R
from regesto.sources import sinks as W
from regesto.streaming import stream as ST


def test_read_index_absent_is_empty(spark):
    path = ST.scratch_dir(spark, "absent")
    df = R.read_index(spark, path)
    assert df.count() == 0 and df.schema == R.LAW_INDEX_SCHEMA


def test_state_json_object_form(spark, tmp_path):
    p = tmp_path / "progress.json"
    p.write_text(json.dumps({"done_keys": ["2001_1", "2001_3"], "done_years": [2000]}))
    st = R.read_state(spark, str(p), multiline=True)
    keys = spark.createDataFrame([(2000, 1, "2000_1"), (2001, 1, "2001_1"), (2001, 2, "2001_2"), (2001, 3, "2001_3")],
                                 "year int, n int, key string")
    left = todo(keys, st["done_keys"], on="key", done_years=st["done_years"], year="year")
    assert sorted(r["key"] for r in left.collect()) == ["2001_2"]


def test_key_and_page_grids(spark):
    g = R.key_grid(spark, 2001, 2002, 3, url_fmt="https://x.example/BDF?anno=%d&numero=%d")
    assert g.count() == 6 and g.filter(F.col("url") == "https://x.example/BDF?anno=2002&numero=3").count() == 1
    years = spark.createDataFrame([(2020,), (2021,), (2021,)], "year int")
    pg = R.page_grid(spark, "https://a.example/s?anno={year}&p={page}", 1, 2, years=years)
    assert sorted(r["url"] for r in pg.collect())[0] == "https://a.example/s?anno=2020&p=1"


def test_write_append_inventory(spark):
    df = spark.createDataFrame([("R1", "a"), ("R2", "b")], "region string, law_title string")
    path = ST.scratch_dir(spark, "idx")
    W.write_index(df, path)
    W.append_index(df, path)
    assert spark.read.parquet(path).count() == 4
    inv = R.file_inventory(spark, path, glob="*.parquet")
    assert inv.count() >= 2 and inv.filter(F.col("length") <= 0).count() == 0
    assert R.path_exists(spark, f"{path}/region=R1")


def test_stream_equals_batch_and_restart(spark):
    data = spark.createDataFrame([(i % 37, f"https://x.example/d?id={i % 37}", i) for i in range(200)],
                                 "page_id long, url string, pos int")
    src = ST.scratch_dir(spark, "in")
    data.limit(100).repartition(4).write.parquet(src)
    log, ck = ST.scratch_dir(spark, "log"), ST.scratch_dir(spark, "ck")

    def run():
        s = ST.stream_pages(spark, src, data.schema, max_files=2)
        ST.stream_upsert_index(ST.stream_dedupe(s, "url").select("url"), log, ck, key="url").awaitTermination()

    run()
    first = ST.read_upserted_index(spark, log, key="url").count()
    data.subtract(data.limit(100)).repartition(3).write.mode("append").parquet(src)
    run()  # restart on the same checkpoint: only new files, state remembers seen urls
    idx = ST.read_upserted_index(spark, log, key="url")
    assert first <= 37 and idx.count() == 37
    assert spark.read.parquet(f"{log}/log").count() == 37  # no url upserted twice across batches


def test_upsert_replaces_and_snapshots_fold(spark):
    src, log, ck = (ST.scratch_dir(spark, n) for n in ("v", "vlog", "vck"))
    schema = "url string, pos int, text string"
    batches = [[("a", 2, "a1 late"), ("a", 1, "a1"), ("b", 1, "b1")], [("a", 1, "a2"), ("c", 1, "c2")], [("c", 3, "c3")]]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").parquet(src)
        ST.stream_upsert_index(ST.stream_pages(spark, src, df.schema), log, ck, key="url", order=["pos"]).awaitTermination()
        if k == 1:
            assert ST.compact_index(spark, log, "url") == 1 == ST.compact_index(spark, log, "url")
            assert ST._snapshots(spark, log) == [1]
    got = sorted(tuple(r) for r in ST.read_upserted_index(spark, log, key="url").collect())
    assert got == [("a", 1, "a2"), ("b", 1, "b1"), ("c", 3, "c3")]
    # a replayed batch rewrites its own part
    ST.upsert_batch(spark.createDataFrame([("c", 3, "c3 again")], schema), 2, log, "url")
    assert sorted(tuple(r) for r in ST.read_upserted_index(spark, log, key="url").collect())[2] == ("c", 3, "c3 again")


def test_no_machine_local_checkpoint_folder_off_a_local_master():
    import pytest

    from regesto.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()  # noqa: N815

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_payload_table(spark):
    df = spark.createDataFrame([("a", b"%PDF1", "<p>x</p>"), ("b", None, "<p>y</p>")], "filename_stem string, pdf binary, html string")
    got = {r["payload_name"]: r["payload_kind"] for r in W.payload_table(df).collect()}
    assert got == {"a.pdf": "pdf", "b.html": "html"}


def test_read_pages_html_dir_and_captures(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    (d / "a.html").write_text("<h1>Uno</h1><p>n. 3</p>")
    (d / "b.html").write_text("<h1>Due</h1>\n<p>n. 4</p>")
    pages = R.read_pages(spark, str(d), fmt="html")
    got = sorted((r["url"].rsplit("/", 1)[-1], r["html"]) for r in pages.collect())
    assert got == [("a.html", "<h1>Uno</h1><p>n. 3</p>"), ("b.html", "<h1>Due</h1>\n<p>n. 4</p>")]
    c = tmp_path / "caps"
    c.mkdir()
    (c / "x.pdf").write_bytes(b"%PDF-1.4 x")
    (c / "y.pdf").write_bytes(b"<html>")
    from regesto.operators.filters import valid_capture

    caps = valid_capture(R.read_captures(spark, str(c), fmt="binaryFile"))
    assert [r["url"].rsplit("/", 1)[-1] for r in caps.collect()] == ["x.pdf"]


def test_stream_dedupe_within_watermark(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(f"u{i % 5}", base + dt.timedelta(minutes=i)) for i in range(40)]
    df = spark.createDataFrame(rows, "url string, ts timestamp")
    src = ST.scratch_dir(spark, "wm-in")
    df.repartition(2).write.parquet(src)
    s = ST.stream_pages(spark, src, df.schema)
    out, ck = ST.scratch_dir(spark, "wm-out"), ST.scratch_dir(spark, "wm-ck")
    ST.run_to_parquet(ST.stream_dedupe(s, "url", event_time="ts", delay="1 day"), out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.select("url").distinct().count() == 5
