"""Operator 5: near-duplicates by an LSH forest of MinHash signatures.

A document is the set of its five-word shingles; equal sets are one node.  A signature has
``TREES`` * ``DEPTH`` minimum hashes, and tree t reads it rotated by t * ``DEPTH`` values: so many
sorted orders of the same signatures.  In each order a node's candidates are the neighbours with
the longest common prefix, at least ``DEPTH`` values and at most ``REACH`` places away: in a
sparse region that is everything below a short prefix, in a dense one the prefix grows by itself.

Round one: of its candidates each node proposes the likeliest and the smallest likely one; the
proposals are confirmed on full shingle sets, and connected components are taken.  Round two is
the exact rest for dense regions: whatever shares a prefix of ``DEPTH`` values and lies in different
components is compared, by signatures, then by the names of its whole sets, inside the task, and
what passes is confirmed too, so no cap on neighbours loses a link.  With
similarity 0.85 two documents share such a prefix in one of 24 trees but for one in 5 * 10^7, with
0.8 but for one in 3 * 10^5.  Signatures that agree in too few values to be compared add at most
a hundredth to that.

Orders are range-partitioned, so a region with a third of all nodes lies over many tasks; in
round two regions are cut into blocks that meet pairwise.  Texts are sent to a confirmation once
per bucket of at most ``BUCKET`` proposals.  Components are found by large-star and small-star
steps on links alone.  Shingles and nodes are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, ragged, slices, table
from regesto.llm.substring_dedup import SEGMENT, U, bloom, keyed, might_hold, mix, signed, split

WORDS = 5
TREES, DEPTH = 24, 4
SIZE = TREES * DEPTH
REACH = 32
BLOCK = 1024
BUCKET = 128
SIGNATURE_BYTES = 1 << 18  # of signatures that are worked on at a time
PERCENT = 80

_ODD = np.random.default_rng(5).integers(0, 1 << 63, SIZE, dtype=U) * U(2) + U(1)
_MUL = U(0x9E3779B97F4A7C15)


def shingles(raw: bytes) -> np.ndarray:
    """Sorted distinct names of the shingles of a whole text (UTF-8); fewer words than five are one."""
    import xxhash

    words = raw.lower().split()  # of bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return np.zeros(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, len(h) if len(h) < WORDS else WORDS, U)
    for k in range(min(WORDS, len(h))):
        out = mix(out * _MUL + h[k : k + n])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum hashes (upper 32 bits) of a shingle set that is not empty."""
    least = np.full(SIZE, ~U(0), U)
    for lo in range(0, len(found), 4096):
        least = np.minimum(least, (found[lo : lo + 4096, None] * _ODD).min(0))
    return (least >> U(32)).astype(np.uint32)


def set_name(found: np.ndarray) -> int:
    """A set's 64-bit name."""
    import xxhash

    return xxhash.xxh3_64_intdigest(found.tobytes())


def signatures(rows: DataFrame) -> DataFrame:
    """did, th, node (null without words), n_shingles, sig of every row of ``keyed`` documents."""
    schema = "did long, th long, node long, n_shingles long, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw", SEGMENT):
            sets = [shingles(x) for x in batch.column("raw").to_pylist()]
            empty = np.array([not len(s) for s in sets])
            names = np.array([set_name(s) for s in sets], U).view(np.int64)
            sigs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), batch.column("th"), pa.array(names, mask=empty), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary())],
                names=["did", "th", "node", "n_shingles", "sig"],
            )

    return rows.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch, kind) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), kind).reshape(batch.num_rows, -1)


def _prefixes(sig: np.ndarray) -> np.ndarray:
    """Names of the first ``DEPTH`` values of every tree: rows x trees."""
    parts = sig.reshape(len(sig), TREES, DEPTH).astype(U)
    out = np.broadcast_to(np.arange(1, TREES + 1, dtype=U), parts.shape[:2])
    for k in range(DEPTH):
        out = mix(out * _MUL + parts[:, :, k])
    return out


def forest(nodes: DataFrame) -> DataFrame:
    """key (tree and prefix), node, n, sig (rotated, a byte per value): entries that may share a key."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sig", SIGNATURE_BYTES):
            yield pa.RecordBatch.from_arrays([signed(_prefixes(_matrix(batch, "<u4")).ravel())], names=["key"])

    shared = nodes.select("sig").mapInArrow(keys, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n >= 2")
    sent = nodes.sparkSession.sparkContext.broadcast(bloom(shared, F.col("key")))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sig", SIGNATURE_BYTES):
            sig = _matrix(batch, "<u4")
            names = _prefixes(sig)
            row, tree = np.nonzero(might_hold(sent.value, names.ravel()).reshape(names.shape))
            at = (tree[:, None] * DEPTH + np.arange(SIZE)) % SIZE
            turned = (sig[row[:, None], at] & 0xFF).astype(np.uint8)
            flat = pa.py_buffer(turned.tobytes())
            offsets = pa.py_buffer((np.arange(len(row) + 1) * SIZE).astype(np.int32).tobytes())
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    signed(names[row, tree]),
                    batch.column("node").take(take),
                    batch.column("n_shingles").take(take),
                    pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, flat]),
                ],
                names=["key", "node", "n", "sig"],
            )

    return nodes.mapInArrow(entries, "key long, node long, n long, sig binary")


def _threshold(percent: int) -> int:
    """Equal values that a pair must show to be looked at.

    A pair at the limit shows fewer with at most a hundredth of the chance that no tree has it.
    """
    t = percent / 100
    miss, below, k = (1 - t**DEPTH) ** TREES / 100, 0.0, 0
    while below + (p := comb(SIZE, k) * t**k * (1 - t) ** (SIZE - k)) <= miss:
        below, k = below + p, k + 1
    return k


def _alike(sig, n, i, j, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether sizes and signatures (``least`` equal values) allow the pairs i, j; and the equal values."""
    equal = np.zeros(len(i), np.int64)
    fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    some = np.flatnonzero(fits)
    for lo in range(0, len(some), 1 << 16):
        part = some[lo : lo + (1 << 16)]
        equal[part] = (sig[i[part]] == sig[j[part]]).sum(1)
    return fits & (equal >= least), equal


def proposals(entries: DataFrame, percent: int) -> DataFrame:
    """node, other: at most two proposals of each node from its neighbours in all orders."""
    ordered = entries.repartitionByRange("key", "sig", "node").sortWithinPartitions("key", "sig", "node")
    schema = "node long, equal long, best long, least long"
    needed = _threshold(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in slices(batches, "sig", SIGNATURE_BYTES):
            key, node, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "node", "n"))
            sig = _matrix(batch, np.uint8)
            old = 0
            if carried is not None:
                old = len(carried[0])
                key, node, n, sig = (np.concatenate(x) for x in zip(carried, (key, node, n, sig)))
            first, second, equals = [], [], []
            for reach in range(1, REACH + 1):
                i = np.arange(max(0, old - reach), len(key) - reach)
                i = i[key[i] == key[i + reach]]
                if not len(i):
                    break
                ok, equal = _alike(sig, n, i, i + reach, percent, needed)
                first.append(node[i[ok]])
                second.append(node[i[ok] + reach])
                equals.append(equal[ok])
            carried = tuple(x[-REACH:] for x in (key, node, n, sig))
            if first:
                a, b, e = (np.concatenate(x) for x in (first, second, equals))
                a, b, e = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([e, e])
                likely = e * 100 >= SIZE * percent
                least = np.where(likely, np.minimum(a, b), a)
                order = np.lexsort((b, -e, a))
                head = np.flatnonzero(np.r_[True, np.diff(a[order]) != 0]) if len(a) else np.zeros(0, np.int64)
                if len(head):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (a[order][head], e[order][head], b[order][head], np.minimum.reduceat(least[order], head))],
                        names=["node", "equal", "best", "least"],
                    )

    found = ordered.mapInArrow(run, schema)
    top = found.groupBy("node").agg(F.max("equal").alias("equal"), F.min("least").alias("least"))
    best = found.join(top.select("node", "equal"), ["node", "equal"]).groupBy("node").agg(F.min("best").alias("best"))
    both = top.join(best, "node").select("node", "least", F.explode(F.array("best", "least")).alias("other"))
    return both.where("node != other").select("node", "other", "least").distinct()


def confirm(pairs: DataFrame, rows: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, hub) whose full sets are similar enough.

    ``places`` has one row (node, did, th) per node.  Pairs of one hub meet in buckets of about
    ``BUCKET``, and a bucket gets each text once.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BUCKET).alias("parts"))
    placed = pairs.join(sizes, "hub").select("a", "b", F.xxhash64("hub", F.pmod(F.xxhash64("a"), F.col("parts"))).alias("bucket"))
    placed = materialise(placed, "proposed-pairs")
    wanted = placed.select("bucket", F.explode(F.array("a", "b")).alias("node")).distinct().join(places, "node")
    wanted = materialise(wanted, "wanted-texts")
    texts = split(rows, wanted.select("did", "th"))[0].dropDuplicates(["did", "th"]).join(wanted, ["did", "th"])
    null = F.lit(None)
    stream = (
        texts.select("bucket", F.lit(0).alias("kind"), "node", null.cast("long").alias("other"), "packed_text")
        .unionByName(placed.select("bucket", F.lit(1).alias("kind"), F.col("a").alias("node"), F.col("b").alias("other"), null.cast("binary").alias("packed_text")))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "kind")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        bucket, sets = None, {}
        for batch in slices(batches, "packed_text", SEGMENT):
            out_a, out_b = [], []
            for k, kind, node, other, text in zip(*(c.to_pylist() for c in batch.columns)):
                if k != bucket:
                    bucket, sets = k, {}
                if kind == 0:
                    sets[node] = shingles(unpack(text))
                else:
                    a, b = sets[node], sets[other]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        out_a.append(node)
                        out_b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return materialise(stream.mapInArrow(run, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of ``links`` (a, b).

    Alternating large-star and small-star steps until nothing changes.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = materialise(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def sets_of(places: DataFrame, rows: DataFrame) -> DataFrame:
    """node, names (32 bits per shingle, of the whole set) of the nodes of ``places`` (node, did, th)."""
    texts = split(rows, places.select("did", "th"))[0].dropDuplicates(["did", "th"]).join(places, ["did", "th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed_text", SEGMENT):
            names = [(shingles(unpack(x)) >> U(32)).astype("<u4").tobytes() for x in batch.column("packed_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(names, pa.binary())], names=["node", "names"])

    return texts.select("node", "packed_text").mapInArrow(run, "node long, names binary")


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many of set j's names are in set i, for pairs that go by i."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    marked = np.zeros(int(local.max()) + 1, bool)
    out = np.zeros(len(i), np.int64)
    heads = np.flatnonzero(np.r_[True, np.diff(i) != 0])
    for lo, hi in zip(heads, np.r_[heads[1:], len(i)]):
        own = local[begin[i[lo]] : begin[i[lo]] + sizes[i[lo]]]
        marked[own] = True
        others = j[lo:hi]
        hit = marked[local[ragged(begin[others], sizes[others])]]
        out[lo:hi] = np.add.reduceat(hit, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        marked[own] = False
    return out


def rest(entries: DataFrame, parts: DataFrame, places: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, hub): pairs below one prefix, in different components, that are similar by 32-bit names.

    Such names can only make two sets look more alike, so no link is lost.  A bucket holds at most
    two blocks of one region; only pairs that pass leave it.
    """
    known = entries.join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = known.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mixed = mixed.where("lo != hi").select("key", "blocks")
    open_ = materialise(known.join(mixed, "key"), "open-entries")
    sets = materialise(sets_of(places.join(open_.select("node").distinct(), "node"), rows), "open-sets")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = open_.select("*", own.alias("own")).select("*", other)
    bucket = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    # in a bucket of two blocks only pairs across them count; a block's own pairs have a bucket
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    dealt = dealt.select(bucket.alias("bucket"), side.cast("int").alias("side"), "node", "root", "n", "sig").join(sets, "node")
    stream = dealt.repartition("bucket").sortWithinPartitions("bucket", "sig", "node")
    needed = _threshold(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bucket_, side_, node, root, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("bucket", "side", "node", "root", "n"))
            sig, firsts, seconds = _matrix(batch, np.uint8), [], []
            at = np.arange(len(node))
            for reach in range(1, len(node)):
                at = at[at + reach < len(node)]
                at = at[bucket_[at] == bucket_[at + reach]]
                if not len(at):
                    break
                j = at + reach
                i = at[(root[at] != root[j]) & ((side_[at] != side_[j]) | (side_[at] == 2))]
                ok, _ = _alike(sig, n, i, i + reach, percent, needed)
                firsts.append(i[ok])
                seconds.append(i[ok] + reach)
            i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, seconds))
            if len(i):
                order = np.argsort(i, kind="stable")
                i, j = i[order], j[order]
                names = [np.frombuffer(x, "<u4") for x in batch.column("names").to_pylist()]
                both = _shared(names, i, j)
                ok = 100 * both >= percent * (n[i] + n[j] - both)
                i, j = i[ok], j[ok]
            a, b = node[i], node[j]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "names", 4 * SEGMENT):
            held.append(batch)
            last = batch.column("bucket")[-1].as_py()
            if sum(x.num_rows for x in held) >= BLOCK and batch.column("bucket")[0].as_py() != last:
                cut = int(np.flatnonzero(np.asarray(batch.column("bucket")) == last)[0])
                held[-1] = batch.slice(0, cut)
                yield found(held)
                held = [batch.slice(cut)]
        if held:
            yield found(held)

    return stream.mapInArrow(run, "a long, b long").distinct().select("a", "b", F.col("a").alias("hub"))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """did, th, n_shingles, root per row of ``docs``; root is null without words."""
    rows = keyed(docs)
    sigs = materialise(signatures(rows), "signatures")
    nodes = sigs.where("node is not null").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    nodes = materialise(nodes, "shingle-sets")
    entries = materialise(forest(nodes), "forest")
    proposed = proposals(entries, percent).select(F.col("node").alias("a"), F.col("other").alias("b"), F.col("least").alias("hub"))
    proposed = materialise(proposed, "proposals")
    first = sigs.where("node is not null").groupBy("node").agg(F.min("did").alias("did"))
    places = sigs.select("node", "did", "th").join(first, ["node", "did"]).groupBy("node", "did").agg(F.min("th").alias("th"))
    places = materialise(places, "set-places")
    links = confirm(proposed, rows, places, percent)
    parts = materialise(components(links), "components")
    more = materialise(rest(entries, parts, places, rows, percent), "open-pairs")
    extra = confirm(more, rows, places, percent)
    joined = links.unionByName(extra)
    parts = materialise(components(joined), "components")
    return sigs.select("did", "th", "node", "n_shingles").join(parts, "node", "left").select(
        "did", "th", "n_shingles", F.coalesce("root", "node").alias("root")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Rows are linked when 100 * intersection >= ``percent`` * union of their sets.  A text without
    words (null and empty ones too) is linked with nothing and is its own component.  Rows that
    repeat a doc_id keep all of them if it is the least; a null doc_id is below all others and
    comes back as null.  An empty table gives no rows; other columns are ignored.
    """
    found = materialise(near_groups(docs, percent), "near-groups")
    least = found.where("root is not null").groupBy("root").agg(F.min("did").alias("component"))
    joined = found.join(least, "root", "left").withColumn("component", F.coalesce("component", "did"))
    back = lambda c: F.when(F.col(c) != -(1 << 63), F.col(c))
    return joined.select(
        back("did").alias("doc_id"), "n_shingles", back("component").alias("component_id"), (F.col("did") == F.col("component")).alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without all but one of each group: the least (doc_id, text hash) stays.

    Rows without words stay.  Of rows with one id and text that are the least, the one whose other
    columns come first (as JSON) stays.  Only rows that may be
    listed as lost or repeated are shuffled.
    """
    found = materialise(near_groups(docs, percent), "near-groups").where("root is not null")
    first = found.groupBy("root").agg(F.min("did").alias("did"))
    first = found.join(first, ["root", "did"]).groupBy("root", "did").agg(F.min("th").alias("th"))
    first = first.select("root", F.col("did").alias("d0"), F.col("th").alias("t0"))
    least = (F.col("did") == F.col("d0")) & (F.col("th") == F.col("t0"))
    listed = found.join(first, "root").groupBy("did", "th").agg(F.bool_and(~least).alias("lost"), F.count("*").alias("n"))
    listed = materialise(listed.where("lost or n > 1").select("did", "th", "lost"), "listed-rows")
    rest_ = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest")
    key = keyed(docs.select("doc_id", "text", rest_), "rest").withColumn("raw", F.lit(b""))
    some, others = split(key, listed)
    marked = some.drop("packed_text").join(listed, ["did", "th"], "left")
    once = marked.where("lost is null").select("rest")
    again = marked.where("not lost").groupBy("did", "th").agg(F.min_by("rest", F.to_json("rest")).alias("rest")).select("rest")
    return others.select("rest").unionByName(once).unionByName(again).select("rest.*")


@query("op5_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 85)
