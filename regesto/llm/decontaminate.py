"""Operator 3: benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are words (ASCII letters lower-cased, ASCII punctuation as spaces).  A document is
contaminated by an item of n words if some stretch of it is within floor(n * ``EDIT_PERCENT`` /
100) word insertions, deletions and substitutions of the item.

Windows as long as the items are embedded by CGK random walks: at each step a walk writes the
word it stands on and moves on or stays by a random bit of (step, word), so that texts at a small
edit distance walk in step most of the way and differ in few places.  Each of ``WALKS`` walks is
sampled ``SAMPLES`` times at ``BITS`` steps; a window that agrees with an item in one sample is a
candidate, and exact edit verification decides.  The numbers are chosen for a recall of 0.99 at
the full distance (``tests/llm`` measures it).

Only windows that can match are embedded: an item cut into one segment more than it may have
edits keeps a segment whole, so a window starts at the place that an exact occurrence of a segment
implies.  That loses nothing.

Documents are never shuffled.  The items are a stated query set; they go to the executors in
blocks of about ``BLOCK_WORDS`` words, each block against all rows.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import slices, table, worker_state
from regesto.llm.substring_dedup import SEGMENT, U, mix
from regesto.llm.toxicity import WORD_TABLE

EDIT_PERCENT = 20
WALKS, SAMPLES, BITS = 16, 16, 3
BLOCK_WORDS = 2_000_000
STRETCH = 1 << 22  # bytes of a text that are worked on at a time

_MUL = U(0x9E3779B97F4A7C15)


def words_of(raw: bytes) -> np.ndarray:
    """Names of the words of a text (UTF-8)."""
    import xxhash

    words = raw.translate(WORD_TABLE).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))


def edits(n: int) -> int:
    return n * EDIT_PERCENT // 100


def names_of(h: np.ndarray, q: int) -> np.ndarray:
    """Names of all stretches of ``q`` words."""
    out = np.full(max(0, len(h) - q + 1), q, U)
    for k in range(q):
        out = mix(out * _MUL + h[k : k + len(out)])
    return out


def embed(texts: np.ndarray) -> np.ndarray:
    """The first 2n steps of ``WALKS`` CGK walks over each row of n words: rows x walks x steps."""
    m, n = texts.shape
    padded = np.concatenate([texts, np.zeros((m, 1), U)], 1)
    row, dice = np.arange(m)[:, None], (np.arange(WALKS, dtype=U) << U(32))[None, :]
    at, out = np.zeros((m, WALKS), np.int64), np.zeros((m, WALKS, 2 * n), U)
    for step in range(2 * n):
        here = padded[row, np.minimum(at, n)]
        out[:, :, step] = here
        at += (mix(here ^ ((dice + U(step + 1)) * _MUL)) & U(1)).astype(np.int64)
    return out


def samples(texts: np.ndarray) -> np.ndarray:
    """The ``WALKS`` * ``SAMPLES`` sampled names of each row."""
    m, n = texts.shape
    steps = np.random.default_rng(n).integers(0, 2 * n, (WALKS, SAMPLES * BITS))
    seen = embed(texts)[:, np.arange(WALKS)[:, None], steps].reshape(m, WALKS * SAMPLES, BITS)
    name = np.broadcast_to(np.arange(1, WALKS * SAMPLES + 1, dtype=U), seen.shape[:2])
    for k in range(BITS):
        name = mix(name * _MUL + seen[:, :, k])
    return name


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to a stretch of ``text``, and the end of the first such stretch."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """The index over one block of items: (item_id, text) rows."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids, self.words = [], []
        seeds: dict[int, dict[int, set[tuple[int, int]]]] = defaultdict(lambda: defaultdict(set))
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in rows:
            h = words_of((text or "").encode("utf-8", "surrogatepass"))
            n = len(h)
            if not n:
                continue  # an item without words matches nothing
            by_size[n].append(len(self.ids))
            self.ids.append(item_id)
            self.words.append(h)
            cuts = np.linspace(0, n, edits(n) + 2).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:]):
                seeds[b - a][int(names_of(h[a:b], b - a)[0])].add((int(a), n))
        every = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, U)
        self.longest = max(map(len, self.words), default=0)
        self.vocabulary = np.zeros(1 << 20, bool)
        self.vocabulary[(every >> U(44)).astype(np.int64)] = True
        self.seeds = {}
        for q, found in seeds.items():
            names = np.array(sorted(found), U)
            self.seeds[int(q)] = (names, [sorted(found[int(x)]) for x in names])
        self.tables = {}
        for n, members in by_size.items():
            keys = samples(np.stack([self.words[k] for k in members]))
            flat = keys.ravel()
            order = np.argsort(flat, kind="stable")
            self.tables[n] = (flat[order], np.repeat(members, keys.shape[1])[order])

    def windows(self, h: np.ndarray) -> dict[int, np.ndarray]:
        """Size -> starts of the windows that hold a whole segment in its place."""
        found: dict[int, set[int]] = defaultdict(set)
        known = self.vocabulary[(h >> U(44)).astype(np.int64)]
        for q, (names, places) in self.seeds.items():
            if len(h) < q:
                continue
            run = known[: len(h) - q + 1].copy()
            for k in range(1, q):
                run &= known[k : k + len(run)]
            at = np.flatnonzero(run)
            if not len(at):
                continue
            name = np.full(len(at), q, U)
            for k in range(q):
                name = mix(name * _MUL + h[at + k])
            where = np.minimum(np.searchsorted(names, name), len(names) - 1)
            for i, w in zip(at[names[where] == name].tolist(), where[names[where] == name].tolist()):
                for offset, n in places[w]:
                    found[n].add(i - offset)
        return {n: np.array(sorted(starts), np.int64) for n, starts in found.items()}

    def hits(self, h: np.ndarray) -> dict[int, tuple[int, int]]:
        """Item number -> (distance, first word) of the best stretch of each item that contaminates."""
        out: dict[int, tuple[int, int]] = {}
        padded = np.concatenate([np.zeros(self.longest, U), h, np.zeros(self.longest, U)])
        for n, starts in self.windows(h).items():
            k = edits(n)
            names, members = self.tables[n]
            for lo in range(0, len(starts), 512):
                part = starts[lo : lo + 512]
                keys = samples(padded[part[:, None] + self.longest + np.arange(n)])
                first, last = np.searchsorted(names, keys, "left"), np.searchsorted(names, keys, "right")
                row, col = np.nonzero(last > first)
                seen = {(int(part[r]), int(x)) for r, c in zip(row, col) for x in members[first[r, c] : last[r, c]]}
                for start, x in sorted(seen):
                    a = max(0, start - k)
                    d, end = distance(self.words[x], h[a : max(0, start + n + k)])
                    if d <= k and (x not in out or (d, a + end) < (out[x][0], out[x][1])):
                        out[x] = (d, a + end)
        return out

    def document(self, raw: bytes) -> dict[int, tuple[int, int]]:
        """``hits`` of a whole text; a long one is read in stretches that overlap by more than any item."""
        if len(raw) <= STRETCH or not self.longest:
            return self.hits(words_of(raw))
        out: dict[int, tuple[int, int]] = {}
        held, before, at = np.zeros(0, U), 0, 0
        while at < len(raw):
            end = min(len(raw), at + STRETCH)
            while end < len(raw) and raw[end] >= 0x80 or end < len(raw) and chr(raw[end]).isalnum():
                end += 1  # to the end of the word
            h = np.concatenate([held, words_of(raw[at:end])])
            for x, (d, e) in self.hits(h).items():
                if x not in out or (d, before + e) < out[x]:
                    out[x] = (d, before + e)
            keep = min(len(h), 2 * self.longest + 2)
            held, before, at = h[len(h) - keep :], before + len(h) - keep, end
        return out


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, in blocks of about ``BLOCK_WORDS`` words by the hash of (item_id, text)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), " "))).alias("n")).first()["n"] or 0
    n = -(-size // BLOCK_WORDS)
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def index_of(sent, name: str) -> Items:
    """The index of a block of items, built once per Python worker."""
    state = worker_state()
    if state.get("items", ("",))[0] != name:
        state["items"] = (name, Items(sent.value))
    return state["items"][1]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, contaminated (true), distance, item_words, end_word per document and item that meet.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text).  Null and empty texts meet nothing;
    equal items count once; repeated rows are reported each; empty tables give no rows; other
    columns are ignored.
    """
    schema = "doc_id long, item_id long, contaminated boolean, distance int, item_words int, end_word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark):
        sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            items = index_of(sent, name)
            for batch in slices(batches, "raw", SEGMENT):
                got = []
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()):
                    got += [(doc_id, items.ids[x], True, d, len(items.words[x]), e) for x, (d, e) in sorted(items.document(raw).items())]
                if got:
                    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)], names=[x.split()[0] for x in schema.split(", ")])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns; nothing is shuffled."""
    for block in blocks(benchmark):
        sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            items = index_of(sent, name)
            for batch in slices(batches, "text", SEGMENT):
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                clean = [not items.document((t or "").encode("utf-8", "surrogatepass")) for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
