"""Operator 9: removal of repeated 200-byte strings, by distributed prefix doubling over a sample.

Prefix doubling names the string of a growing length at every position, sorts the names in Spark,
drops positions whose name is unique, and goes on until the threshold is passed.  Sorting a pair
for every byte of the corpus each round would move some twenty times the input, so the rounds run
on a synchronised sample that loses nothing:

1. Every 200-byte window has an anchor: its 64-byte string of least hash (leftmost among equals).
   Equal windows have equal anchors at equal places.  About one position in 70 is an anchor; each
   covers the run of window starts that chose it.  Round one names anchors by their 64 bytes.
   Unique ones are dropped: none of their windows can occur twice.
2. Round two names what is left by its hull, the bytes from the first window of the run to the
   end of the last (up to 336 bytes, past the threshold).  If a hull occurs twice, with its anchor
   at the same place, all windows of the run do.
3. Round three takes anchors whose 64 bytes repeat and whose hulls differ, one occurrence of each
   hull, and names every single window of theirs by (anchor, place, 200 bytes); a window that
   comes from two hulls occurs twice.

Rounds are groupings with partial aggregates and joins on names, so a string that a third of all
documents share is counted map-side, never gathered.  In round three the hulls of an anchor meet
in one task while they are at most ``SMALL`` (the bound on what a task holds); the windows of
larger groups are rows of their own.  Both ways give the same result.
Names are 64-bit hashes; two strings would have to collide under the same 64-byte name as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, slices, table, worker_state

LENGTH = 200
GRAM = 64
SMALL = 1 << 14  # hulls of one anchor (some 4 MB) that may meet in one task
MEET = 1 << 12  # hulls of several anchors that are compared at a time
SEGMENT = 1 << 18  # window starts that are worked on at a time; some ten 8-byte arrays of twice the size
BLOOM_BITS = 26  # 2^26 bits, 8 MB, whatever the input; fuller filters let more rows pass, never fewer

_MUL = 0x9E3779B97F4A7C15
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(32))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value, and powers of the base and of its inverse mod 2^64."""
    state = worker_state()
    if "powers" not in state or len(state["powers"][1]) < n:
        table_ = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=U) | U(1)
        base, size = _MUL | 1, max(n, SEGMENT * 2 + LENGTH)
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        state["powers"] = (table_, np.cumprod(up), np.cumprod(down))
    return state["powers"]


class Rolling:
    """Names of all substrings of ``raw``: ``at(starts, ends)``."""

    def __init__(self, raw: np.ndarray):
        table_, self.up, down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, U)
        np.cumsum(table_[raw] * down[: len(raw)], out=self.sums[1:])

    def at(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.up[starts])


def anchors(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(first window, last window, anchor, anchor's name, hull's name) of every run in ``raw``,
    which holds documents one after the other that end at ``ends``."""
    none = np.zeros(0, np.int64)
    n, width = len(raw), length - gram + 1
    if n < length:
        return none, none, none, none.astype(U), none.astype(U)
    rolling = Rolling(raw)
    grams = np.arange(n - gram + 1)
    names = rolling.at(grams, grams + gram)
    low = U((1 << 24) - 1)
    ranked = (names & ~low) | grams.astype(U)
    # least value of each stretch of `width`: suffix minima of one block and prefix minima of the next
    blocks = -(-len(ranked) // width)
    padded = np.full(blocks * width, ~U(0), U)
    padded[: len(ranked)] = ranked
    padded = padded.reshape(blocks, width)
    before = np.minimum.accumulate(padded, 1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    anchor = (np.minimum(after[:starts], before[width - 1 : width - 1 + starts]) & low).astype(np.int64)
    sizes = np.diff(ends, prepend=0)
    inside = np.repeat(ends, sizes)[:starts] - np.arange(starts) >= length
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none.astype(U), none.astype(U)
    cut = np.r_[True, (np.diff(anchor[at]) != 0) | (np.diff(at) != 1)]
    head = np.flatnonzero(cut)
    first, last = at[head], at[np.r_[head[1:], len(at)] - 1]
    place = anchor[first]
    hull = rolling.at(first, last + length)
    hull = mix(hull ^ mix(((place - first) * 1024 + (last - first)).astype(U) * U(_MUL)))
    return first, last, place, names[place], hull


def segments(batches: Iterator[pa.RecordBatch], text: str, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, bytes, ends, row of each piece, first byte of each piece): whole documents together,
    or one stretch of window starts of a long document."""
    for batch in slices(batches, text, SEGMENT):
        texts = [t if t is not None else b"" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        rows = [k for k, t in enumerate(texts) if length <= len(t) <= 2 * SEGMENT]
        held, size = [], 0
        for k in [*rows, None]:
            if held and (k is None or size + len(texts[k]) > 2 * SEGMENT):
                raw = np.frombuffer(b"".join(texts[j] for j in held), np.uint8)
                ends = np.cumsum([len(texts[j]) for j in held])
                yield batch, raw, ends, np.array(held), np.zeros(len(held), np.int64)
                held, size = [], 0
            if k is not None:
                held.append(k)
                size += len(texts[k])
        for k, t in enumerate(texts):
            if len(t) > 2 * SEGMENT:
                for lo in range(0, len(t) - length + 1, SEGMENT):
                    part = np.frombuffer(t, np.uint8)[lo : lo + SEGMENT + length - 1]
                    yield batch, part, np.array([len(part)]), np.array([k]), np.array([lo], np.int64)


def keyed(docs: DataFrame, *rest: str) -> DataFrame:
    """did, th (64 bits; these name a row, equal rows share them and fare alike) and the text's bytes."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(did.alias("did"), F.xxhash64("text").alias("th"), *rest, raw.alias("raw"))


def bloom(df: DataFrame, name: Column) -> np.ndarray:
    """A Bloom filter of two bits per 64-bit name; the driver gets its words, at most 2^20 rows."""
    mask = (1 << BLOOM_BITS) - 1
    bits = F.array(F.shiftrightunsigned(name, 64 - BLOOM_BITS), F.shiftright(name, 8).bitwiseAND(F.lit(mask)))
    each = df.select(F.explode(bits).alias("bit"))
    word = F.shiftright("bit", 6).alias("word")
    words = each.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BLOOM_BITS - 6), U)
    out[np.asarray(words.column("word"), np.int64)] = np.asarray(words.column("bits"), np.int64).view(U)
    return out


def might_hold(words: np.ndarray, names: np.ndarray) -> np.ndarray:
    found = np.ones(len(names), bool)
    for bit in (names >> U(64 - BLOOM_BITS), (names >> U(8)) & U((1 << BLOOM_BITS) - 1)):
        found &= (words[(bit >> U(6)).astype(np.int64)] >> (bit & U(63))) & U(1) == U(1)
    return found


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Runs of window starts that occur twice, per document: (did, th, whole), (did, th, part).

    ``whole`` and ``part`` are arrays of first * 2^16 + number of further starts.
    """
    spark = docs.sparkSession
    rows = keyed(docs)

    def name_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, ends, _, _ in segments(batches, "raw", length):
            yield pa.RecordBatch.from_arrays([signed(anchors(raw, ends, length, gram)[3])], names=["g"])

    named = rows.select("raw").mapInArrow(name_grams, "g long").groupBy("g").agg(F.count("*").alias("n"))
    repeated = materialise(named.where("n >= 2").select("g"), "repeated-anchors")
    sent = spark.sparkContext.broadcast(bloom(repeated, F.col("g")))

    def name_hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, ends, row, base in segments(batches, "raw", length):
            first, last, place, g, c = anchors(raw, ends, length, gram)
            keep = might_hold(sent.value, g)
            first, last, place, g, c = (x[keep] for x in (first, last, place, g, c))
            doc = np.searchsorted(ends, first, "right")
            at = first - np.concatenate([[0], ends])[doc] + base[doc]
            packed = (at << 16) | ((place - first) << 8) | (last - first)
            take = pa.array(row[doc])
            yield pa.RecordBatch.from_arrays(
                [signed(g), signed(c), batch.column("did").take(take), batch.column("th").take(take), pa.array(packed)],
                names=["g", "c", "did", "th", "packed"],
            )

    spots = rows.mapInArrow(name_hulls, "g long, c long, did long, th long, packed long")
    # equal rows are one entry with a count from here on
    spots = materialise(spots.groupBy("g", "c", "did", "th", "packed").agg(F.count("*").alias("times")), "anchor-occurrences")
    own = F.xxhash64("did", "th", "packed")
    hulls = materialise(spots.groupBy("g", "c").agg(F.sum("times").alias("n"), F.min(own).alias("chosen")), "hulls")
    groups = hulls.groupBy("g").agg(F.count("*").alias("n_hulls"), F.sum("n").alias("n_all"), F.min("n").alias("least")).where("n_all >= 2")
    states = hulls.join(groups, "g").select("g", "c", "n", "chosen", "n_hulls", ((F.col("n_hulls") >= 2) & (F.col("least") == 1)).alias("mixed"))
    spots = spots.join(states, ["g", "c"])
    whole = F.when(F.col("n") >= 2, F.col("packed"))
    shown = F.when(
        F.col("mixed") & ((F.col("n") == 1) | (own == F.col("chosen"))),
        F.struct("g", "packed", (F.col("n") == 1).alias("open"), (F.col("n_hulls") > SMALL).alias("large")),
    )
    by_doc = spots.groupBy("did", "th").agg(F.collect_list(whole).alias("whole"), F.collect_list(shown).alias("shown"))
    by_doc = materialise(by_doc, "anchor-states")  # at most an entry per anchor of the document

    with_shown = by_doc.where(F.size("shown") > 0).select("did", "th", "shown")
    texts = split(rows, with_shown)[0].dropDuplicates(["did", "th"])  # one of equal rows shows their hulls
    joined = texts.join(with_shown, ["did", "th"])
    hull_schema = "g long, did long, th long, first long, lead int, open boolean, large boolean, hull binary"

    def cut_hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed_text", SEGMENT):
            out: list[tuple] = []
            for did, th, text, shown_ in zip(*(batch.column(c).to_pylist() for c in ("did", "th", "packed_text", "shown"))):
                raw = unpack(text)
                for x in shown_:
                    first, lead, more = x["packed"] >> 16, (x["packed"] >> 8) & 255, x["packed"] & 255
                    out.append((x["g"], did, th, first, lead, x["open"], x["large"], raw[first : first + more + length]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()))],
                    names=[x.split()[0] for x in hull_schema.split(", ")],
                )

    shown_hulls = materialise(joined.mapInArrow(cut_hulls, hull_schema), "open-hulls")

    def windows(batch: pa.RecordBatch):
        """(row, place in the hull, name) of every window of the hulls in ``batch``."""
        texts = batch.column("hull").to_pylist()
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(lens) - lens
        rolling = Rolling(np.frombuffer(b"".join(texts), np.uint8))
        n = lens - length + 1
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = begin[row] + place
        g = np.asarray(batch.column("g")).astype(np.int64).view(U)
        lead = np.asarray(batch.column("lead")).astype(np.int64)
        return row, place, mix(rolling.at(at, at + length) ^ mix(g[row] + (lead[row] - place + 512).astype(U) * U(_MUL)))

    def runs(batch: pa.RecordBatch, row, place) -> pa.RecordBatch:
        """Neighbouring window starts as (did, th, first * 2^16 + further starts)."""
        if not len(row):
            return pa.RecordBatch.from_pydict({"did": pa.array([], pa.int64()), "th": pa.array([], pa.int64()), "part": pa.array([], pa.int64())})
        cut = np.r_[True, (np.diff(row) != 0) | (np.diff(place) != 1)]
        head = np.flatnonzero(cut)
        n = np.diff(np.r_[head, len(row)]) - 1
        first = np.asarray(batch.column("first"))[row[head]] + place[head]
        take = pa.array(row[head])
        return pa.RecordBatch.from_arrays([batch.column("did").take(take), batch.column("th").take(take), pa.array((first << 16) | n)], names=["did", "th", "part"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            row, place, name = windows(batch)
            order = np.argsort(name, kind="stable")
            same = name[order][1:] == name[order][:-1]
            twice = np.zeros(len(name), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            twice &= np.asarray(batch.column("open").to_numpy(zero_copy_only=False), bool)[row]
            return runs(batch, row[twice], place[twice])

        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "hull", SEGMENT):
            held.append(batch)
            g = np.asarray(batch.column("g"))
            if sum(b.num_rows for b in held) >= MEET and g[0] != g[-1]:
                cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
                held[-1] = batch.slice(0, cut)
                yield found(held)
                held = [batch.slice(cut)]
        if held:
            yield found(held)

    part_schema = "did long, th long, part long"
    small = shown_hulls.where("not large").repartition("g").sortWithinPartitions("g").mapInArrow(meet, part_schema)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hull", SEGMENT):
            row, place, name = windows(batch)
            take = pa.array(row)
            first = np.asarray(batch.column("first"))[row] + place
            yield pa.RecordBatch.from_arrays(
                [signed(name), batch.column("did").take(take), batch.column("th").take(take), pa.array(first << 16), batch.column("open").take(take)],
                names=["name", "did", "th", "part", "open"],
            )

    spelled = shown_hulls.where("large").mapInArrow(spell, "name long, did long, th long, part long, open boolean")
    twice = spelled.groupBy("name").agg(F.count("*").alias("n")).where("n >= 2").select("name")
    large = spelled.where("open").join(twice, "name").select("did", "th", "part")
    parts = small.unionByName(large).groupBy("did", "th").agg(F.collect_list("part").alias("part"))
    return by_doc.where(F.size("whole") > 0).select("did", "th", "whole"), parts


def split(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that ``wanted`` may name, their texts compressed, and the rows that it surely does not.

    Only the first are shuffled later on.
    """
    name = F.xxhash64("did", "th")
    sent = rows.sparkSession.sparkContext.broadcast(bloom(wanted, name))
    rest = [c for c in rows.columns if c != "raw"]
    held = rows.select(*rest, name.alias("name"), "raw")

    def part(batch: pa.RecordBatch, wish: bool) -> pa.RecordBatch:
        hit = might_hold(sent.value, np.asarray(batch.column("name")).astype(np.int64).view(U))
        return batch.filter(pa.array(hit == wish)).drop_columns(["name"])

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches, "raw", SEGMENT):
            batch = part(batch, True)
            packed = pa.array([pack(x) for x in batch.column("raw").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*rest, "packed_text"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield part(batch, False)

    small = rows.select(*rest)
    some_schema = small.withColumn("packed_text", F.lit(b"")).schema
    other_schema = small.withColumn("raw", F.lit(b"")).schema
    return held.mapInArrow(some, some_schema), held.mapInArrow(others, other_schema)


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """did, th and the maximal removed runs (array of byte offsets: first, end, first, end, ...)."""
    whole, part = repeated_windows(docs, length, gram)
    both = whole.join(part, ["did", "th"], "full")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("whole").to_pylist(), batch.column("part").to_pylist()):
                packed = np.array([(x >> 16 << 16) | (x & 255) for x in a or ()] + list(b or ()), np.int64)
                packed.sort()
                first, end = packed >> 16, (packed >> 16) + (packed & 0xFFFF) + length
                end = np.maximum.accumulate(end)
                cut = np.flatnonzero(np.r_[True, first[1:] > end[:-1]])
                out.append(np.stack([first[cut], end[np.r_[cut[1:] - 1, len(end) - 1]]], 1).ravel())
            yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("th"), pa.array(out, pa.list_(pa.int64()))], names=["did", "th", "spans"])

    return materialise(both.mapInArrow(merge, "did long, th long, spans array<long>"), "removed-spans")


def cut_texts(batch: pa.RecordBatch) -> list[tuple[bytes, bytes, list[int]]]:
    """(whole text, what is left of it, removed runs) of every row of (packed_text, spans)."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    out = []
    for packed, runs in zip(batch.column("packed_text").to_pylist(), batch.column("spans").to_pylist()):
        raw, at, kept, runs = unpack(packed), 0, [], runs or []
        for a, b in zip(runs[::2], runs[1::2]):
            kept.append(raw[at:a])
            at = b
        out.append((raw, b"".join([*kept, raw[at:]]), runs))
    return out


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text).

    Null text counts as empty; texts shorter than ``length`` bytes lose nothing; of repeated rows
    and equal texts each loses all its windows.  An empty table gives no rows; other columns are
    ignored.
    """
    found = spans(docs, length, gram)
    some, others = split(keyed(docs), found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed_text", SEGMENT):
            texts = cut_texts(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("did"),
                    pa.array([len(t[0]) for t in texts], pa.int64()),
                    pa.array([len(t[0]) - len(t[1]) for t in texts], pa.int64()),
                    pa.array([len(t[2]) // 2 for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t[1]).hexdigest() for t in texts], pa.string()),
                ],
                names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    digest = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    hit = some.join(found, ["did", "th"], "left").mapInArrow(run, digest)
    zero = F.lit(0).cast("long")
    clean = others.select(
        "did", F.octet_length("raw").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256")
    )
    doc_id = F.when(F.col("did") != -(1 << 63), F.col("did")).alias("doc_id")
    return hit.unionByName(clean).select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; a character that is cut in two goes too.

    No row goes, even if its text becomes empty; ``n_chars``, where there is one, follows the text.
    Null texts stay null.
    """
    names = docs.columns
    found = spans(docs, length, gram)
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("row")
    rest = F.struct(row, F.col("text").isNull().alias("null")).alias("rest")
    key = keyed(docs.select("doc_id", "text", rest), "rest")
    some, others = split(key, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed_text", SEGMENT):
            kept = [t[1].decode("utf-8", "ignore") for t in cut_texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(kept, pa.string())], names=["rest", "text"])

    joined = some.join(found, ["did", "th"], "left").select("rest", "packed_text", "spans")
    hit = joined.mapInArrow(run, some.select("rest").withColumn("text", F.lit("")).schema)
    both = hit.unionByName(others.select("rest", F.col("raw").cast("string").alias("text")))
    both = both.withColumn("text", F.when(~F.col("rest.null"), F.col("text")))
    chars = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return both.select(*[F.col("text") if c == "text" else chars.alias(c) if c == "n_chars" else F.col(f"rest.row.`{c}`").alias(c) for c in names])


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
