"""Bitmaps, sketches, bucketed and merged indexes, archives, keyed state."""

import datetime as dt
import os
import random

from conftest import rows
from pyspark.sql import functions as F

from regesto.operators import joins as J
from regesto.operators import state as OS
from regesto.sources import readers as R
from regesto.sources import sinks as W
from regesto.streaming import stateful as SF
from regesto.streaming import stream as ST


def test_bitmaps_match_the_anti_join(spark):
    rng = random.Random(2)
    keys = [(y, n) for y in (1999, 2000, None) for n in (*range(1, 60), 32_767, 32_768, 32_769, 65_536, 65_537, 2_000_000, None)]
    done = rng.sample([k for k in keys if None not in k], 60)
    grid = spark.createDataFrame(keys, "y int, n int")
    batches = [OS.done_bitmaps(spark.createDataFrame(done[k::3], "y int, n int")) for k in range(3)]
    merged = OS.merge_bitmaps(*batches, batches[1])
    left = rows(OS.todo_by_bit(grid, merged))
    assert sorted(left, key=str) == sorted(set(keys) - set(done), key=str)
    assert dict(rows(OS.done_counts(merged))) == {y: sum(d[0] == y for d in done) for y in {d[0] for d in done}}
    none = OS.done_bitmaps(spark.createDataFrame([], "y int, n int"))
    assert OS.todo_by_bit(grid, none).count() == len(keys)


def test_sketches_merge_to_the_whole(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("source"), (F.col("id") % 7).alias("run"), (F.col("id") % 9000).cast("string").alias("url"))
    runs = OS.distinct_sketches(df, ["source", "run"], "url")
    got = rows(OS.sketch_estimates(OS.merge_sketches(runs)))[0][0]
    whole = rows(OS.sketch_estimates(OS.distinct_sketches(df, [], "url")))[0][0]
    error = 9000 * 5 * 1.04 / 2 ** (OS.LG_K / 2)
    assert abs(got - whole) < error and abs(got - 9000) < error


def test_the_daily_join_does_not_shuffle_a_bucketed_index(spark):
    path = ST.scratch_dir(spark, "bucketed")
    known = spark.range(500).select(F.concat(F.lit("u"), "id").alias("source_url"), "id")
    name = "index_" + path.rsplit("-", 1)[1]
    W.write_bucketed_index(known, path, name, buckets=6)
    new = spark.range(490, 520).select(F.concat(F.lit("u"), "id").alias("source_url"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = W.open_bucketed_index(spark, path, name + "_again", "source_url string, id long", buckets=6)
        for index in (spark.table(name), again):
            todo = J.todo(new, index, on="source_url")
            plan = todo._jdf.queryExecution().executedPlan().toString()
            # what is new is dealt to the buckets; below the scan of the index there is no exchange
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
            assert sorted(rows(todo)) == [(f"u{k}",) for k in range(500, 520)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    import pyarrow.parquet as pq

    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 6 and pq.read_metadata(os.path.join(path.removeprefix("file:"), files[0])).num_rows > 0


def test_a_batch_rewrites_only_its_buckets(spark):
    path = ST.scratch_dir(spark, "merged")
    record = lambda ids, v: spark.createDataFrame([(f"u{k}", v, k) for k in ids], "source_url string, v int, pos int")
    ST.merge_batch(record(range(200), 0), 0, path, buckets=16)
    at = lambda: {d: sorted(os.listdir(f"{path.removeprefix('file:')}/{d}")) for d in os.listdir(path.removeprefix("file:")) if d.startswith("bucket=")}
    before = at()
    for _ in range(2):  # a replayed batch gives the same index
        ST.merge_batch(record([3, 3, 500], 1).withColumn("pos", F.lit(1)).dropDuplicates(), 1, path, buckets=16)
    after = at()
    assert 1 <= sum(before.get(d) != after[d] for d in after) <= 2
    got = {r["source_url"]: r["v"] for r in ST.read_merged_index(spark, path).collect()}
    assert got == {f"u{k}": 0 for k in range(200)} | {"u3": 1, "u500": 1}
    ST.merge_batch(record([], 2), 2, path, buckets=16)
    assert at() == after


def test_archives_split_and_parse(spark):
    path = ST.scratch_dir(spark, "archive")
    pages = [(f"https://a.example/{k}", 200 if k % 4 else 404, f"<p>è {k}\r\n\r\nHTTP/ {'x' * (k % 50)}</p>") for k in range(300)] + [("https://b.example/", 200, "")]
    R.write_archive(spark.createDataFrame(pages, "url string, status int, html string").coalesce(1), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = R.read_archive(spark, path)
        assert df.rdd.getNumPartitions() > 5  # one file, many tasks
        assert sorted(rows(df, "url", "status", "html")) == sorted(pages)
        assert df.filter("complete").count() == len(pages)
        assert [r["url"] for r in R.read_archive(spark, path, r"^https://b").collect()] == ["https://b.example/"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    raw = ST.scratch_dir(spark, "archive")
    text = ("WARC/1.0\r\nWARC-Type: warcinfo\r\n\r\nsoftware: x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nwarc-target-uri: https://c.example/\r\n\r\n"
            "HTTP/1.1 200 OK\r\nContent-Length: 99\r\nX-A: 1:2\r\nX-A: 3\r\n\r\n<p>short</p>\r\n\r\n")
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "\n").text(raw)
    got = R.read_archive(spark, raw).collect()
    assert [(r["url"], r["status"], r["headers"]["x-a"], r["complete"]) for r in got] == [("https://c.example/", 200, "1:2", False)]


def outcomes(spark, batches, **more):
    """The rows of ``stream_outcomes`` after each batch of (key, attempt, status, minute), one start each."""
    SF.use_rocksdb(spark)
    src, out, ckpt = (ST.scratch_dir(spark, n) for n in ("log", "out", "ckpt"))
    schema = "k long, attempt int, status string, ts timestamp"
    seen, states = [], []
    for batch in batches:
        data = [(k, a, s, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)) for k, a, s, m in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        stream = SF.stream_outcomes(ST.stream_pages(spark, src, spark.createDataFrame([], schema).schema), **more)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None)
        now = {tuple(r) for r in spark.read.schema("k long, attempt int, status string, why string").parquet(out).collect()}
        seen.append(now.difference(*seen))
    return seen, states


def test_outcomes_by_state_and_timers(spark):
    got, states = outcomes(spark, [
        [(1, 1, "Failed", 0), (2, 1, "Failed", 0), (3, 1, "Skipped", 1), (4, 1, "Failed", 2), (4, 2, "Downloaded", 3)],
        [(1, 2, "Failed", 30), (2, 3, "Failed", 31), (3, 2, "Downloaded", 32)],  # key 3 is done
        [(9, 1, "Failed", 150)],  # an hour after its last attempt key 1 is given up
        [(9, 2, "Skipped", 160), (7, 1, "Skipped", 3000)],
        [(3, 1, "Failed", 4000)],  # key 3's mark went when the watermark passed a day
        [(8, 1, "Failed", 90_000)],
    ])
    assert got[0] == {(3, 1, "Skipped", "final"), (4, 2, "Downloaded", "final")}
    assert got[1] == {(2, 3, "Failed", "tries")}
    assert (1, 2, "Failed", "timeout") in got[2] | got[3]
    assert len({x for g in got for x in g if x[0] == 1}) == 1
    assert got[3] == {(9, 2, "Skipped", "final"), (7, 1, "Skipped", "final")}
    assert (3, 1, "Failed", "timeout") in got[4] | got[5]
    assert states[-1] is None or states[-1] <= 6  # old keys leave nothing behind


class _Handle:
    """A key's state and timers in memory; counts the calls, each of which is a message to the JVM."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def _call(self):
        self.calls += 1

    def get(self):
        self._call()
        return self.value

    def exists(self):
        self._call()
        return self.value is not None

    def update(self, value):
        self._call()
        self.value = value

    def clear(self):
        self._call()
        self.value = None

    def listTimers(self):
        self._call()
        return iter(self.timers)

    def deleteTimer(self, ms):
        self._call()
        self.timers.discard(ms)

    def registerTimer(self, ms):
        self._call()
        self.timers.add(ms)


def test_a_keys_state_is_read_and_written_once():
    class Expired:
        def __init__(self, ms):
            self.getExpiryTimeInMs = lambda: ms

    def fire(p, h):
        ms = h.timers.pop()
        return [tuple(r) for r in p.handleExpiredTimer((7,), None, Expired(ms))]

    h, p = _Handle(), SF.FirstRecord("k", "a int, b string", ["a", "b"], 1, 10, 100)
    p.init(h)
    give = lambda *rows: list(p.handleInputRows((7,), iter([{"__ms": ms, "a": a, "b": b} for ms, a, b in rows]), None))
    assert give((5, 3, "x"), (6, 2, "y")) == [] and h.timers == {15} and h.calls == 3
    assert give((8, 1, "z")) == [] and give((9, 4, "w")) == [] and h.timers == {15} and h.calls == 6
    assert fire(p, h) == [(7, 1, "z")] and h.timers == {115} and h.calls == 9
    assert give((20, 0, "v")) == [] and h.calls == 10
    assert fire(p, h) == [] and h.value is None and not h.timers
    h, p = _Handle(), SF.Outcome("k", 10, 100)
    p.init(h)
    give = lambda *rows: [tuple(r) for r in p.handleInputRows((7,), iter([{"attempt": a, "status": s, "__ms": ms} for a, s, ms in rows]), None)]
    assert give((2, "Failed", 5)) == [] and h.timers == {15} and h.calls == 3
    assert give((1, "Failed", 8)) == [] and h.timers == {18} and h.value[:2] == (2, "Failed")
    assert give((4, "Skipped", 9)) == [] and h.timers == {18}
    assert give((3, "Skipped", 12)) == [(7, 3, "Skipped", "final")] and h.timers == {112}
    assert give((1, "Skipped", 13)) == [] and fire(p, h) == [] and h.value is None
