"""Operator 8: quality by a regularised quadratic discriminant.

A text becomes ``len(NAMES)`` statistics of its characters, words and lines, each put through a
transform that spreads it (logarithms of sizes, arcsine roots of shares).  Each class has a mean
and a covariance, shrunk towards the pooled covariance and then towards its mean variance; the
Cholesky factors are computed once and sent along.  The score is the logistic of the difference
of the two log densities (half squared Mahalanobis distances and log determinants) and priors.

The sums behind means and covariances are taken in Spark over all labelled rows; the driver sees
one row of sums per class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, slices, table
from regesto.llm.toxicity import held_out

NAMES = (
    "words", "word_length", "word_length_spread", "distinct_words", "top_word", "same_next", "distinct_pairs",
    "upper", "digits", "marks", "symbols", "high_bytes", "lines", "repeated_lines", "line_length", "capital_words",
)
POOLED = 0.2  # weight of the pooled covariance
ROUND = 0.05  # weight of the mean variance

_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_MARK = np.array([chr(b) in ".,;:!?'\"()-" for b in range(256)])
_SYMBOL = np.array([b < 128 and b > 32 and not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-" for b in range(256)])
_HIGH = np.arange(256) >= 128
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a whole text; zeros for null, empty and blank ones."""
    import xxhash

    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    out = np.zeros(len(NAMES))
    if not words:
        return out
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    lens = np.fromiter(map(len, words), np.int64, n)
    _, times = np.unique(h, return_counts=True)
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    solid = max(1, int(chars[~_SPACE].sum()))
    share = lambda x: np.arcsin(np.sqrt(min(1.0, max(0.0, x))))
    of = lambda kind: share(chars[kind].sum() / solid)
    firsts = Counter(w[0] for w in words)
    out[:] = (
        np.log1p(n),
        np.log(lens.mean()),
        np.log1p(lens.std()),
        share(len(times) / n),
        share(times.max() / n),
        share((h[:-1] == h[1:]).mean()) if n > 1 else 0.0,
        share(len(np.unique(pairs)) / (n - 1)) if n > 1 else share(1.0),
        of(_UPPER),
        of(_DIGIT),
        of(_MARK),
        of(_SYMBOL),
        of(_HIGH),
        np.log1p(len(lines)),
        share(1 - len(set(lines)) / len(lines)),
        np.log1p(n / len(lines)),
        share(sum(c for b, c in firsts.items() if _UPPER[b]) / n),
    )
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array of the statistics) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


class Discriminant:
    """Class means and Cholesky factors; ``score`` is the probability of class 1."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, pooled: float = POOLED, rounding: float = ROUND):
        d = sums.shape[1]
        total = counts.sum()
        mean = sums / counts[:, None]
        scatter = squares - counts[:, None, None] * mean[:, :, None] * mean[:, None, :]
        within = scatter.sum(0) / total
        self.scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
        unit = np.outer(self.scale, self.scale)
        self.center = mean / self.scale
        self.factors, self.offsets = [], []
        for k in range(2):
            cov = (1 - pooled) * scatter[k] / counts[k] / unit + pooled * within / unit
            cov = (1 - rounding) * cov + rounding * max(np.trace(cov) / d, 1e-3) * np.eye(d)
            factor = np.linalg.cholesky(cov)
            self.factors.append(np.linalg.inv(factor))
            self.offsets.append(np.log(counts[k] / total) - np.log(np.diag(factor)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        logs = [o - 0.5 * np.square((x - c) @ f.T).sum(1) for o, c, f in zip(self.offsets, self.center, self.factors)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def train(stats: DataFrame, labels: DataFrame) -> Discriminant | float:
    """From ``stats`` (doc_id, x) and ``labels`` (doc_id, label 0/1); a constant if a class is missing.

    Null ids and other labels are left out; several labels of one id count as the largest.
    """
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    d = len(NAMES)
    x = [F.col("x")[i] for i in range(d)]
    cross = [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    rows = stats.join(known, "doc_id").groupBy("label").agg(F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"), F.array(*cross).alias("c")).collect()
    by = {r["label"]: r for r in rows}
    if len(by) < 2:
        return float(next(iter(by), 0.5))
    counts = np.array([by[k]["n"] for k in (0, 1)], float)
    sums = np.array([by[k]["s"] for k in (0, 1)])
    squares = np.zeros((2, d, d))
    for k in (0, 1):
        squares[k][np.triu_indices(d)] = by[k]["c"]
        squares[k] = squares[k] + np.triu(squares[k], 1).T
    return Discriminant(counts, sums, squares)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; ``labels`` has (doc_id, quality).

    Rows whose id falls in fold 1 of 3 are never learnt from.  Null, empty and blank texts are
    scored from statistics of zero.  With labels of one class every score is that class, with none
    0.5.  Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    out = held_out("doc_id", 3, 1)
    stats = materialise(document_statistics(docs), "quality-vectors")  # len(NAMES) numbers a document, used twice
    model = train(stats, labels.where(~out).select("doc_id", F.col("quality").alias("label")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(batch.num_rows, -1)
            p = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_quality_model")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
