"""Operator 2: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words (ASCII letters lower-cased, ASCII punctuation as spaces) give unigrams, each whole and cut to
its first ``STEMS`` bytes, bigrams, and skip-grams with one and two words left out, hashed into
2^``BITS`` buckets; a text's features are its distinct buckets.  Each coordinate has its own learning rate, and L1 keeps most weights at
exactly zero, so the model that is sent to the executors is the list of the others.  A present
feature counts as 4 / (number of features) ^ 1/4, which keeps long texts from drowning their own
signal; gradients of the rarer class 1 are weighted up to balance.

Training is bounded: at most ``SAMPLE`` labelled rows, those of least id hash, in ``SHARDS``
shards that learn at the same time from the same state for ``ROUNDS`` rounds; between the rounds
the shards' sums z and n are averaged.  Scoring covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, slices, table

BITS = 18
STEMS = (4, 6)
SAMPLE = 8_000
SHARDS = 4
ROUNDS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.3
MAX_CLASS_WEIGHT = 10.0

#: Bytes of words as they are, A-Z as a-z, everything else as a space.
WORD_TABLE = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else (b if b >= 0x80 else 0x20) for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def features(text: str | None) -> np.ndarray:
    """Distinct feature buckets of a whole text (ascending)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    grams = [h * _ODD[0]]
    for n in STEMS:
        grams.append(np.fromiter((xxhash.xxh3_64_intdigest(w[:n], n) for w in words), np.uint64, len(words)))
    for skip in (1, 2, 3):
        grams.append((h[:-skip] * _ODD[skip] + h[skip:]) * _ODD[0])
    return np.unique(np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int32)


def value(n_features: int) -> float:
    """What each present feature of a text with so many features counts."""
    return 4.0 / (n_features + 1) ** 0.25


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


class Ftrl:
    """FTRL-proximal; the last coordinate is the bias."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, found: np.ndarray, label: int, weight: float) -> None:
        at = np.append(found.astype(np.int64), len(self.z) - 1)
        x = np.full(len(at), value(len(found)))
        x[-1] = 1.0
        w = self.weights(at)
        g = (logistic((w * x).sum()) - label) * x * weight
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] += g * g


def held_out(doc_id: str | Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls in ``fold``; a null id counts as empty text."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1).

    Null ids and other labels are left out; several labels of one id count as the largest, and of
    several texts of one id that of least hash is learnt.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.withColumn("_order", F.xxhash64("doc_id")).orderBy("_order", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one text of each id, at most `sample` rows whatever the table repeats
    rows = rows.groupBy("doc_id", "_order", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            found = [pack(np.diff(features(t), prepend=0).astype("<i4").tobytes()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("_order"), batch.column("label"), pa.array(found, pa.binary())],
                names=["shard", "ord", "label", "features"],
            )

    shard = F.pmod(F.col("_order"), F.lit(SHARDS)).cast("int").alias("shard")
    data = rows.select(shard, "_order", F.col("label").cast("int").alias("label"), "text")
    data = materialise(data.mapInArrow(extract, "shard int, ord long, label int, features binary"), "toxicity-sample")
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    streams = data.repartitionByRange(SHARDS, "shard").sortWithinPartitions("shard", "ord")
    by = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}  # two rows
    ones = min(MAX_CLASS_WEIGHT, max(1.0, by.get(0, 0) / max(1, by.get(1, 0))))

    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n))

        def learn(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            import zstandard

            unpack = zstandard.ZstdDecompressor().decompress
            z0, n0 = state.value
            model = Ftrl(z0.copy(), n0.copy())
            for batch in batches:
                for label, found in zip(batch.column("label").to_pylist(), batch.column("features").to_pylist()):
                    model.learn(np.cumsum(np.frombuffer(unpack(found), "<i4")), label, ones if label else 1.0)
            yield pa.RecordBatch.from_pydict({"dz": [(model.z - z0).astype("<f4").tobytes()], "dn": [(model.n - n0).astype("<f4").tobytes()]})

        # one row of 2 * 4 * 2^BITS bytes per shard comes back
        for row in streams.mapInArrow(learn, "dz binary, dn binary").collect():
            z += np.frombuffer(row["dz"], "<f4") / SHARDS
            n += np.frombuffer(row["dn"], "<f4") / SHARDS
        state.unpersist()
    w = Ftrl(z, n).weights(np.arange(size))
    at = np.flatnonzero(w[:-1])
    return at.astype(np.int32), w[at], float(w[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id and score (0 to 1) of every row's whole text; null and empty texts score the bias."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = sent.value
        dense = np.zeros(1 << BITS)
        dense[at] = w
        for batch in slices(batches, "text"):
            found = [features(t) for t in batch.column("text").to_pylist()]
            p = logistic(np.array([dense[f].sum() * value(len(f)) for f in found]) + bias)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; ``labels`` has (doc_id, toxic).

    Rows whose id falls in fold 0 of 5 are never learnt from.  Without any usable label every
    score is 0.5.  Repeated rows are scored each; an empty table gives no rows; other columns are
    ignored.
    """
    out = held_out("doc_id", 5, 0)
    seen = labels.where(~out).select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs, train(docs, seen, sample))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
