"""Structured Streaming form of the flow.

The reference's producer queue, "seen" sets and save-every-N-rows become:
file-stream ingest of captured pages (STR-1), a de-duplication whose state lives
in the checkpoint (STR-2), and a ``foreachBatch`` upsert into the index (STR-3)
that is idempotent per batch id, so a restarted or retried batch rewrites its own
slice instead of adding rows.  Checkpoints go under ``spark.checkpoint.dir`` (a
shared folder on a cluster), never a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regesto.operators.dedupe import distinct_ordered, last_writer_wins
from regesto.session import ensure_checkpoint_dir
from regesto.sources.readers import path_exists


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stream_pages(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """STR-1: a folder of page files as a stream (new files are new micro-batches)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_dedupe(stream: DataFrame, key: str = "url", event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """STR-2: each key once over the run and over restarts (state in the checkpoint).

    Without ``event_time`` the state keeps every key ever seen (exact, grows with the keys);
    with ``event_time``/``delay`` it is ``dropDuplicatesWithinWatermark``: state is bounded, and a
    copy arriving more than ``delay`` after the first is no longer recognised."""
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay or "1 day").dropDuplicatesWithinWatermark([key])


def upsert_batch(batch: DataFrame, batch_id: int, log_path: str, key="source_url", order=None) -> None:
    """One micro-batch into the index change log: partition ``batch_id`` is overwritten, so a
    replayed batch never duplicates rows.  With ``order`` the first record of a key in the batch
    stays."""
    if order is not None:
        batch = distinct_ordered(batch, key, order)
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(f"{log_path}/log"))


def _snapshots(spark: SparkSession, log_path: str) -> list[int]:
    """Batch numbers up to which a complete snapshot folds the log (a few folder names)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log_path}/snapshot")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    return sorted(int(n) for n in names if path_exists(spark, f"{log_path}/snapshot/{n}/_SUCCESS"))


def read_upserted_index(spark: SparkSession, log_path: str, key="source_url") -> DataFrame:
    """SET-7: the latest batch's record wins per key, over the last snapshot and the batches after it."""
    log = spark.read.parquet(f"{log_path}/log")
    if done := _snapshots(spark, log_path):
        # the batch number prunes partitions: folded batches are not read
        old = spark.read.parquet(f"{log_path}/snapshot/{done[-1]}")
        log = log.filter(F.col("batch_id") > done[-1]).unionByName(old.withColumn("batch_id", F.lit(done[-1]).cast("long")))
    return last_writer_wins(log, key, "batch_id").drop("batch_id")


def compact_index(spark: SparkSession, log_path: str, key="source_url") -> int:
    """Fold the log into a snapshot, so that later reads start from it; returns the last batch folded."""
    last = spark.read.parquet(f"{log_path}/log").agg(F.max("batch_id")).first()[0]
    if last not in _snapshots(spark, log_path):
        read_upserted_index(spark, log_path, key).write.mode("overwrite").parquet(f"{log_path}/snapshot/{last}")
    return last


def stream_upsert_index(records: DataFrame, log_path: str, checkpoint: str, available_now: bool = True, key="source_url", order=None):
    """STR-3 / SNK-4: start the stream that merges every micro-batch into the index log; a crash
    loses at most the batch at hand."""
    w = records.writeStream.foreachBatch(lambda df, bid: upsert_batch(df, bid, log_path, key, order)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


#: Folders of a merged index; a batch rewrites those that its keys fall in.
MERGE_BUCKETS = 64


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str = "source_url", order=None, buckets: int = MERGE_BUCKETS) -> None:
    """SNK-4, bucket-wise: one micro-batch into the index at ``path``, last writer wins per key.

    Only the buckets that the batch touches are read and written (dynamic partition overwrite, from a
    staged copy), so there is no log to fold; a replayed batch gives the same files.  The list of
    touched buckets, ``buckets`` numbers at most, is all that the driver sees."""
    spark = batch.sparkSession
    if order is not None:
        batch = distinct_ordered(batch, key, order)
    new = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("bucket", _bucket(key, buckets)).checkpoint()
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    if not touched:
        return
    if path_exists(spark, path):
        new = new.unionByName(spark.read.schema(new.schema).parquet(path).filter(F.col("bucket").isin(touched)))
    staged = scratch_dir(spark, "merge")
    last_writer_wins(new, key, "batch_id").write.parquet(staged)
    merged = spark.read.schema(new.schema).parquet(staged)
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def stream_merge_index(records: DataFrame, path: str, checkpoint: str, key: str = "source_url", order=None, buckets: int = MERGE_BUCKETS):
    """STR-3 over ``merge_batch``: start the stream that merges everything available now."""
    w = records.writeStream.foreachBatch(lambda df, bid: merge_batch(df, bid, path, key, order, buckets)).option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True).start()


def read_merged_index(spark: SparkSession, path: str) -> DataFrame:
    """The index that ``merge_batch`` keeps: one row per key."""
    return spark.read.parquet(path).drop("bucket", "batch_id")


def stream_status_counts(stream: DataFrame, status: str = "status") -> DataFrame:
    """STR-4: live totals per status (``outputMode('complete')``)."""
    return stream.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def run_to_parquet(stream: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over everything available now into a parquet folder, then return."""
    q = (stream.writeStream.format("parquet").outputMode(mode).option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_counts(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Run an aggregating stream (complete mode) and persist each batch's totals, last one wins."""
    def sink(df, bid):
        df.withColumn("batch_id", F.lit(bid).cast("long")).write.mode("overwrite").parquet(f"{out_path}/batch={bid}")

    q = (stream.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
