"""Operator 6: bulk-synchronous best-fit packing of token pieces into fixed-size sequences.

Pieces and gaps are whole numbers up to the sequence length, so both sorted lists are held
run-length coded: one run of equal pieces per length, one run of equal gaps per size.  A round
takes the longest pieces not yet placed and sweeps the gaps upwards from their length: a gap that
took a piece and holds another is the best for the next one, so each gap of a run met on the way
is filled with pieces of the length; pieces that no gap holds open new sequences.  The conflict
within a run is resolved by rank.  Then the gaps shrink and move to their new runs, and the next
round starts.  The gaps left are those of best-fit decreasing, piece by piece.

What a sweep works on is bounded by the sequence length alone (at most ``capacity`` runs either
side), whatever the number of documents, and so is the plan of moves that it makes.  Spark counts
the lengths, ranks the pieces of each length (per input partition, then offsets by partition; a
length that a third of all pieces share is never gathered) and joins ranks with moves.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import ChunkEncoder, materialise, slices, table, tokenizer_file

CAPACITY = 2048
SEPARATOR = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, part_rank long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece of each document: its ids, then ``separator``, cut every ``capacity`` ids.

    ``part`` and ``part_rank`` number the pieces of one length within a task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), ChunkEncoder.of(vocabulary)
        seen = np.zeros(capacity + 1, np.int64)  # pieces of each length so far
        for batch in slices(batches, "text"):
            ids, counts = encoder.encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, separator).astype("<u4")
            counts = counts + 1
            first = np.cumsum(counts) - counts
            n_pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(counts[doc] - start, capacity)
            lo = first[doc] + start
            crc = [zlib.crc32(ids[a : a + n].data) for a, n in zip(lo.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            by_length = length[order]
            head = np.flatnonzero(np.r_[True, np.diff(by_length) > 0])
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(head, np.diff(np.r_[head, len(length)]))
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "part_rank"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def plan_moves(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rounds of successor sweeps over the runs.

    ``counts``: pieces per length.  Each move (length, rank_from, rank_to, sequence, offset) places
    the pieces of that length with these ranks in as many sequences from ``sequence`` on.
    """
    moves: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> spans of sequences [first, end)
    sizes: list[int] = []  # of the runs, ascending
    opened = 0

    def free(size: int, first: int, end: int) -> None:
        if size:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append((first, end))

    def fill(length: int, rank: int, left: int, size: int, first: int, end: int) -> int:
        """Pieces put into gaps [first, end) of ``size``: a gap that took one is the best for the next."""
        each = size // length
        full = min(end - first, left // each)
        more = left - full * each if full < end - first else 0
        at = capacity - size
        if full:
            for k in range(each):
                moves.append((length, rank + k * full, rank + (k + 1) * full, first, at + k * length))
            shrunk.append((size - each * length, first, first + full))
        if more:
            for k in range(more):
                r = rank + full * each + k
                moves.append((length, r, r + 1, first + full, at + k * length))
            shrunk.append((size - more * length, first + full, first + full + 1))
        rest = first + full + bool(more)
        if rest < end:
            shrunk.append((size, rest, end))
        return full * each + more

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        shrunk: list[tuple[int, int, int]] = []
        at = bisect_left(sizes, length)
        while left and at < len(sizes):  # the sweep: smallest gap that holds the piece, and upwards
            size = sizes[at]
            spans = gaps[size]
            while left and spans:
                placed = fill(length, rank, left, size, *spans.pop())
                rank, left = rank + placed, left - placed
            if spans:
                break
            del gaps[size]
            sizes.pop(at)
        if left:
            need = -(-left // (capacity // length))
            fill(length, rank, left, capacity, opened, opened + need)
            opened += need
        for size, first, end in shrunk:
            free(size, first, end)
    return moves


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``pieces`` (as of ``token_pieces``, materialised)."""
    spark = pieces.sparkSession
    per_part = pieces.groupBy("part", "length").agg((F.max("part_rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most `capacity` rows reach the driver; the moves that go back follow the runs, not the pieces
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves = spark.createDataFrame(
        plan_moves(counts, capacity) or [], "m_length long, rank_from long, rank_to long, sequence long, at long"
    )
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("part_rank"))
    placed = ranked.join(
        F.broadcast(moves),
        (F.col("length") == F.col("m_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
        F.col("at").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``docs`` (doc_id, text); one row per piece.

    Null and empty texts are documents of the separator alone; repeated rows are packed as often
    as they come; only documents longer than ``capacity`` are cut; an empty table gives no rows.
    Other columns are ignored.
    """
    return pack(materialise(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
