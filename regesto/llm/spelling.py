"""Operator 13: spelling variants by a bit-sliced position index.

Words are the runs of letters of all documents, counted in the tasks before they are shuffled.  Two
words are near if one inserted, deleted or replaced character makes them equal.

*Which words meet.*  The shorter word of a near pair has m characters, cut into three segments; the
edit lies in one of them, so that both words agree in what is before it (counted from the start)
and behind it (counted from the end).  A word therefore enters three buckets for m = its length and
three for m = its length - 1, and every near pair meets in one.  A bucket with more than ``BLOCK``
words is cut into parts that meet pairwise.  A pair that meets in several buckets counts in the
first.

*How they are compared.*  A block of buckets is a vocabulary of its own.  For each position and
letter a bitset has the words with that letter there.  All words of the block are read against it
at the same time, position by position: the bitset of words that agree so far (no error) and three
of words with one error (replaced; one letter left out, read one place back; one letter more, read
one place on) follow from the last ones by a few word-parallel operations.

Pairs stay in the task; a word leaves it with the number of its near words and the best one.  A
form occurs at least ``TIMES`` as often as its word, so chains of forms are short, and roots come
from a few rounds of pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, slices, table

SHORTEST = 5
LEAST = 3
TIMES = 2
MUTED = 97  # of so many (document, word) hashes one loses a letter
BLOCK = 1024
BLOCK_CHARS = 1 << 20
COUNTED = 400_000  # distinct words that a task holds before it passes them on
CHUNK = 1 << 20  # characters that are cut into words at a time

RUN = re.compile("[A-Za-zÀ-ÿ]+")
BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def words_of(doc_id: int | None, raw: bytes) -> Counter:
    """How often each word occurs in a whole text, after letters have been left out."""
    text = raw.lower().decode("utf-8", "replace")  # of bytes: A-Z only
    runs: Counter = Counter()
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + CHUNK)
        end = cut.start() if cut else len(text)
        runs.update(RUN.findall(text, at, end))
        at = end
    prefix = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % MUTED == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            some = [(w, n) for w, n in held.items() if len(w) >= shortest]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        held: Counter = Counter()
        for batch in slices(batches, "raw"):
            for doc_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                for word, n in words_of(doc_id, raw).items():
                    held[word] += n
                if len(held) >= COUNTED:
                    yield flush()
                    held.clear()
        yield flush()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _keys(words: DataFrame, shortest: int) -> DataFrame:
    """m, s, key (of bucket), earlier (keys of the buckets before s), word, n: six rows per word at most."""
    size = F.length("word")
    each = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= shortest)
    third = lambda s: F.floor(F.col("m") * s / 3).cast("int")
    parts = [F.xxhash64("m", F.lit(s), F.substring("word", F.lit(1), third(s)), F.expr(f"right(word, m - cast(floor(m * {s + 1} / 3) as int))")) for s in range(3)]
    each = each.withColumn("keys", F.array(*parts))
    return each.select("word", "n", "m", "keys", F.posexplode("keys").alias("s", "key")).select(
        "m", "s", "key", F.slice("keys", 1, F.col("s")).alias("earlier"), "word", "n"
    )


def _slices(codes: np.ndarray, letters: int) -> Iterator[np.ndarray]:
    """Per position the bitsets of all letters: letters x 64-bit words."""
    n = len(codes)
    room = np.zeros((letters, -(-n // 64) * 8), np.uint8)
    for column in codes.T:
        room[:, : -(-n // 8)] = np.packbits(column[None, :] == np.arange(letters)[:, None], axis=1, bitorder="little")
        yield room.copy().view(np.uint64)


def near(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs (i, j) of near words."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lens, kind="stable")  # so that the words that are not yet read to their end come first
    lens = lens[order]
    longest, n = int(lens[0]), len(words)
    letters, flat = np.unique(np.frombuffer("".join([words[i] for i in order.tolist()]).encode("utf-32-le"), "<u4"), return_inverse=True)
    codes = np.zeros((n, longest + 1), np.int32)  # 0 behind the end
    codes[np.arange(longest + 1) < lens[:, None]] = flat + 1
    index = _slices(codes, len(letters) + 1)
    here, on = next(index), next(index)
    back = np.zeros_like(here)
    none = np.zeros((n, here.shape[1]), np.uint64)
    same, other, fewer, more = ~none, none, none.copy(), none.copy()
    for j in range(longest):
        k = int(np.searchsorted(-lens, -j))  # words of more than j letters
        letter = codes[:k, j]
        hit, was = here[letter], same[:k].copy()
        other[:k] = (other[:k] & hit) | (was & ~hit)
        fewer[:k] = (fewer[:k] & back[letter]) | was
        more[:k] = (more[:k] | was) & on[letter]
        same[:k] = was & hit
        back, here, on = here, on, next(index, np.zeros_like(here))
    bits = np.zeros((longest + 2, here.shape[1] * 8), np.uint8)
    for size in np.unique(lens).tolist():
        bits[size, : -(-n // 8)] = np.packbits(lens == size, bitorder="little")
    of = bits.view(np.uint64)
    found = (other & of[lens]) | (fewer & of[lens - 1]) | ((more | same) & of[lens + 1])
    i, j = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, bitorder="little"))
    return order[i], order[j]


def _best(batch: pa.RecordBatch) -> pa.RecordBatch:
    """word, n_near, form_n, form of the words of a block, over the pairs that count there."""
    words = batch.column("word").to_pylist()
    bucket, m, s, side, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("bucket", "m", "s", "side", "n"))
    size = np.fromiter(map(len, words), np.int64, len(words))
    i, j = near(words)
    ok = (bucket[i] == bucket[j]) & (np.minimum(size[i], size[j]) == m[i]) & ((side[i] == 2) | (side[i] != side[j]))
    i, j = i[ok], j[ok]
    earlier = [x + [0] * (2 - len(x)) for x in batch.column("earlier").to_pylist()]
    earlier = np.array(earlier, np.int64).reshape(-1, 2)
    first = ~((earlier[i] == earlier[j]) & (np.arange(2) < s[i][:, None])).any(1)
    i, j = i[first], j[first]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    head = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
    count = np.diff(np.r_[head, len(i)])
    take = lambda x: batch.column("word").take(pa.array(x))
    return pa.RecordBatch.from_arrays([take(i[head]), pa.array(count.astype(np.int64)), pa.array(n[j[head]]), take(j[head])], names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, shortest: int = SHORTEST, block: int = BLOCK) -> DataFrame:
    """word, n_near, form_n, form (the near word of largest n, then the least) of the words that have near words."""
    entries = materialise(_keys(words, shortest), "segment-entries")
    sizes = entries.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.length("word")).alias("chars")).where("size >= 2")
    parts = F.ceil(F.greatest(F.col("size") / block, F.least(F.col("chars") / BLOCK_CHARS, F.col("size")))).cast("int")
    dealt = entries.join(sizes.select("key", parts.alias("parts")), "key")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("own")
    dealt = dealt.select("*", own).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("met"))
    side = F.when(F.col("own") == F.col("met"), 2).otherwise((F.col("own") > F.col("met")).cast("int"))
    bucket = F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "met"), F.greatest("own", "met")))
    stream = dealt.select(bucket.alias("bucket"), "m", "s", side.alias("side"), "earlier", "word", "n").repartition("bucket").sortWithinPartitions("m", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "word", BLOCK_CHARS):
            bucket_ = np.asarray(batch.column("bucket"))
            cuts = np.r_[0, np.flatnonzero(np.diff(bucket_)) + 1]  # where buckets begin
            if held and held[-1].column("bucket")[-1].as_py() == bucket_[0]:
                cuts = cuts[1:]
            size, last = sum(x.num_rows for x in held), 0
            for cut in cuts.tolist():
                if size + cut - last >= block:
                    if cut > last:
                        held.append(batch.slice(last, cut - last))
                    yield _best(joined(held))
                    held, size, last = [], 0, cut
            if batch.num_rows > last:
                held.append(batch.slice(last))
        if held:
            yield _best(joined(held))

    found = stream.mapInArrow(run, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every row of ``forms`` (word, form), by pointer doubling; chains end."""
    links = materialise(forms.select("word", F.col("form").alias("root")), "form-links")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        new = links.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        new = materialise(new, "form-links")
        links = new.select("word", "root")
        if new.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text) with ``shortest``
    characters or more that occurs ``least`` times.

    The form is the near word that occurs most, the least in code-point order among equals, if it
    occurs ``times`` as often.  Null and empty texts have no words; a null doc_id is hashed as an
    empty string; repeated rows count as often as they occur; an empty table gives no rows; other
    columns are ignored.
    """
    words = materialise(vocabulary(docs, shortest, least), "vocabulary")
    joined = words.join(near_words(words, shortest, block), "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    found = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    found = materialise(found, "word-forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
