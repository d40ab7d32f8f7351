"""Operator 4: token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at a position; dynamic
programming keeps, per position, the best score and the number of pieces behind it.  No ids and
no back pointers are kept.  The rules of ``tokenizers``' Unigram model hold exactly: pieces are
tried by ascending start, a later one wins only by a strictly greater score, a character without
a piece of its own scores the least score less 10, and it becomes its UTF-8 byte pieces where the
vocabulary has all 256, else one unknown piece, neighbours joined.  Control, unknown and byte
pieces match no text.

White space: each maximal run of other characters is a word and carries the mark in front (the
Metaspace rule with ``split``); runs of white space count as one border and hold no piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import slices, table, tokenizer_file

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the Unigram model
CAP = 300_000  # words remembered in a task
Vocabulary = list[tuple[str, float]]


#: Runs without Unicode white space; ``str.split`` cuts at four control characters besides.
WORD = re.compile(r"(?:\S|[\x1c-\x1f])+")
CONTROL = re.compile(r"[\x1c-\x1f]")


def read_pieces(path: str) -> tuple[Vocabulary, bool]:
    """(piece, score) of the text pieces of a sentencepiece model file, and whether all bytes have pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())
    text = [(m.id_to_piece(i), m.get_score(i)) for i in ids if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    return text, sum(m.is_byte(i) for i in ids) == 256


class UnigramCounter:
    """Piece count and best score of a text."""

    def __init__(self, pieces: Vocabulary, byte_pieces: bool, cap: int = CAP):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.byte_pieces, self.cap, self.known = byte_pieces, cap, {}

    def _unknown(self, char: str) -> int:
        """Pieces of a character without one of its own; 0: joined with unknown neighbours."""
        return len(char.encode("utf-8", "surrogatepass")) if self.byte_pieces else 0

    def word(self, text: str) -> tuple[int, float]:
        n = len(text)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, score) in self.automaton.iter(text):
            ending[end].append((length, score))
        best, count, run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            top, pieces, joined, single = None, 0, False, False
            # the longest match starts first, so matches come by ascending start
            for length, score in sorted(ending[end], reverse=True):
                if length == 1:
                    single = True
                start = end + 1 - length
                total = score + best[start]
                if top is None or total > top:
                    top, pieces, joined = total, count[start] + 1, False
            if not single:
                total = self.unknown_score + best[end]
                if top is None or total > top:
                    more = self._unknown(text[end])
                    top, joined = total, more == 0
                    pieces = count[end] + (more or (0 if run[end] else 1))
            best[end + 1], count[end + 1], run[end + 1] = top, pieces, joined
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        known, n, total = self.known, 0, 0.0
        for w in WORD.findall(text) if CONTROL.search(text) else text.split():
            got = known.get(w)
            if got is None:
                if len(known) > self.cap:
                    known.clear()
                known[w] = got = self.word(MARK + w)
            n += got[0]
            total += got[1]
        return n, total


def count_tokens(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens`` (long) and ``token_score`` (double), the whole text of each row.

    Null and empty texts have no tokens and score 0.  Rows are kept as they are, repeated ones
    too; columns named like the new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_tokens", "token_score")]
    if text not in kept:
        raise ValueError(f"no text column {text!r}")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = rows.withColumn("n_tokens", F.lit(0).cast("long")).withColumn("token_score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(*read_pieces(model_path))
        for batch in slices(batches, text):
            got = [counter.text(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            arrays = [*batch.columns, pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "n_tokens", "token_score"])

    return rows.mapInArrow(run, schema)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_file("piece_bpe_32k.model")).select("doc_id", "n_tokens", "token_score")
