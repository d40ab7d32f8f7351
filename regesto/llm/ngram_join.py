"""Operator 12: Jaccard self-join of shingle sets by PartEnum signatures.

Sets are banded by size, each band ``PERCENT`` of the next, so that similar sets lie in one band or
in two that follow each other; a set is signed for its own band and for the next.  In a band similar
sets differ in at most k shingles.  Shingles are dealt by hash to k // 2 + 1 partitions of
``CELLS`` cells each: some partition then holds at most one of the differences, in one of its cells,
and what the other cells hold is equal in both sets.  A signature names the band, the partition, the
cell left out and what the other cells hold; similar sets share at least one.

1. Equal sets are one node.  Signatures are counted; a Bloom filter of a fixed size lets only those
   go on that several nodes may share.
2. In turns, a node of each component (at first, each node) is compared with one of the component
   that it shares most signatures with and with one of the least such; what is confirmed on full sets
   gives larger components.  A turn makes at most two pairs a component; one without a link is the last.
3. The rest: whatever shares a signature and lies in different components.  A set carries a parity
   sketch (for each of M hash buckets, whether it holds an odd number of shingles).  Two sketches
   never differ in more bits than the sets in shingles, so a pair that the sketches rule out is no
   link; the others are confirmed too.  Only such pairs leave the task, mostly from one bucket each.

No step loses a link; shingles, sets and signatures are named by 64-bit hashes.  A signature that
very many nodes share is joined by many tasks (step 2) and cut into blocks that meet pairwise (3).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import materialise, slices, table
from regesto.llm.near_dedup import components
from regesto.llm.substring_dedup import SEGMENT, U, bloom, keyed, might_hold, mix, signed, split

WORDS = 4
PERCENT = 85
CELLS = 3
BLOCK = 4096
BUCKET = 128
PAIRS_BYTES = 1 << 22  # of sketches that are compared at a time
FIRSTS = 8  # least signatures of a node that travel with it, to tell which bucket a pair belongs to
SETTLED = 10  # a turn that joins fewer than one in so many open components is the last
HOPS = 3  # links that a node looks ahead for its component between turns

_MUL = U(0x9E3779B97F4A7C15)


class Bands:
    """Sizes of sets by band, and what two similar sets of one band or the next may differ by."""

    def __init__(self, percent: int):
        self.percent = percent
        low, last, odds = [], [], []
        at = 1
        while at < 1 << 40:
            end = 100 * at // percent
            low.append(at)
            last.append(end)
            odds.append(2 * end * (100 - percent) // (100 + percent))
            at = end + 1
        self.low, self.differ = np.array(low), np.array(odds)
        self.bits = np.array([max(64, 1 << (2 * end - 1).bit_length()) for end in last])

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1

    def allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many shingles similar sets of these sizes may differ in; -1 if their sizes forbid it."""
        most = (a + b) * (100 - self.percent) // (100 + self.percent)
        return np.where(100 * np.minimum(a, b) >= self.percent * np.maximum(a, b), most, -1)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct names of the shingles of a whole text (UTF-8); fewer words than ``words`` are one."""
    import xxhash

    found = raw.lower().split()  # of bytes: A-Z only, and the six ASCII white spaces
    if not found:
        return np.zeros(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), U, len(found))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), U)
    for k in range(min(words, len(h))):
        out = mix(out * _MUL + h[k : k + n])
    return np.unique(out)


def set_name(found: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(found.tobytes())


def sketch(found: np.ndarray, bits: int) -> bytes:
    """Parities of the numbers of shingles in ``bits`` buckets (a power of two)."""
    place = ((found * _MUL) >> U(24)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def folded(odd: bytes, bits: int) -> np.ndarray:
    """The same sketch of fewer buckets, as 64-bit words."""
    out = np.frombuffer(odd, U)
    while len(out) * 64 > bits:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, number of the set, band signed for) of all ``sets``."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.zeros(0, U)
    doc = np.repeat(np.arange(len(sets)), sizes)
    out = []
    for step in range(2):
        band = bands.of(np.maximum(sizes, 1)) + step
        differ = bands.differ[band]
        cells = np.where((differ > 0) & (sizes > 0), (differ // 2 + 1) * CELLS, 0)
        begin = np.cumsum(cells) - cells
        some = cells[doc] > 0
        values, of = flat[some], doc[some]
        salt = mix(band.astype(U) * _MUL + U(1))
        place = begin[of] + (mix(values ^ salt[of]) % np.maximum(cells, 1).astype(U)[of]).astype(np.int64)
        held = mix(values + _MUL)
        total = int(cells.sum())
        # sums of the halves are exact, as a cell has some tens of shingles
        low = np.bincount(place, (held & U(0xFFFFFFFF)).astype(float), total).astype(U)
        high = np.bincount(place, (held >> U(32)).astype(float), total).astype(U)
        each = ((high << U(32)) + low).reshape(-1, CELLS)
        rest = (each.sum(1, keepdims=True, dtype=U) - each).ravel()
        of = np.repeat(np.arange(len(sets)), cells)
        which = (np.arange(total) - begin[of]).astype(U)
        out.append((mix(mix(rest + salt[of]) * _MUL + which), of, band[of]))
    return tuple(np.concatenate(x) for x in zip(*out))


def shingle_sets(rows: DataFrame, bands: Bands, words: int) -> DataFrame:
    """did, th, node (null without words), n_shingles, odd (the sketch) of every row of ``keyed`` documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw", SEGMENT):
            sets = [shingles(x, words) for x in batch.column("raw").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            names = np.array([set_name(s) for s in sets], U).view(np.int64)
            bits = bands.bits[bands.of(np.maximum(sizes, 1)) + 1].tolist()
            odd = [sketch(s, b) if len(s) else None for s, b in zip(sets, bits)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), batch.column("th"), pa.array(names, mask=sizes == 0), pa.array(sizes), pa.array(odd, pa.binary())],
                names=["did", "th", "node", "n_shingles", "odd"],
            )

    return rows.mapInArrow(run, "did long, th long, node long, n_shingles long, odd binary")


def shared_entries(rows: DataFrame, places: DataFrame, bands: Bands, words: int) -> DataFrame:
    """sig, node, band of the signatures that several nodes may share; ``places`` has one row per node."""
    context = rows.sparkSession.sparkContext
    chosen = context.broadcast(bloom(places, F.xxhash64("did", "th")))
    named = rows.select("raw", F.xxhash64("did", "th").alias("name"))

    def signed_sets(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "raw", SEGMENT):
            mine = might_hold(chosen.value, np.asarray(batch.column("name")).astype(np.int64).view(U))
            sets = [shingles(x, words) for x in batch.column("raw").filter(pa.array(mine)).to_pylist()]
            yield sets, *signatures(sets, bands)

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sig, _, _ in signed_sets(batches):
            yield pa.RecordBatch.from_arrays([signed(sig)], names=["sig"])

    counted = named.mapInArrow(only, "sig long").groupBy("sig").agg(F.count("*").alias("n"))
    shared = context.broadcast(bloom(counted.where("n >= 2"), F.col("sig")))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, sig, of, band in signed_sets(batches):
            some = might_hold(shared.value, sig)
            node = np.array([set_name(s) for s in sets], U)
            yield pa.RecordBatch.from_arrays([signed(sig[some]), signed(node[of[some]]), pa.array(band[some].astype(np.int32))], names=["sig", "node", "band"])

    return named.mapInArrow(entries, "sig long, node long, band int")


def first_proposals(entries: DataFrame) -> DataFrame:
    """a, b: each node with the least node of the signature it shares most, and with the least of all."""
    least = entries.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub != top").select("sig", "hub")
    votes = entries.join(least, "sig").where("node != hub").groupBy("node", "hub").agg(F.count("*").alias("votes"))
    best = votes.groupBy("node").agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col("hub").alias("hub"))).alias("best"), F.min("hub").alias("least"))
    return best.select(F.col("node").alias("a"), F.explode(F.array_distinct(F.array("best.hub", "least"))).alias("b"))


def nearby(links: DataFrame) -> DataFrame:
    """node, root: the least node within ``HOPS`` links of each node of ``links`` (a, b).

    Nodes of one root are connected, though not all that are have one root: enough between turns."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where("a != b").distinct(), "link-ends")
    roots = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    for _ in range(HOPS - 1):
        seen = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        roots = seen.join(roots.select(F.col("node").alias("a"), "root"), "a").select(F.col("a").alias("node"), F.least("m", "root").alias("root"))
    return roots


def open_entries(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """sig, node, band, root (the node's component) of the signatures that several components share."""
    known = entries.drop("root").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = known.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("sig")
    return known.join(mixed, "sig")


def proposals(opened: DataFrame, turn: int) -> DataFrame:
    """a, b: a node of each component with one of the least component of the signatures that it
    shares most, and with one of the least of all; ``turn`` changes which nodes stand for theirs."""
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("rank"), F.col("node").alias("node"))
    chosen = opened.groupBy("sig", "root").agg(F.min(rank).alias("rep")).select("sig", "root", F.col("rep.node").alias("node"))
    least = chosen.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    hubs = chosen.join(least.select("sig", F.col("lo").alias("root")), ["sig", "root"]).select("sig", F.col("root").alias("other"), F.col("node").alias("hub"))
    votes = chosen.join(hubs, "sig").where("root != other").groupBy("root", "other").agg(F.count("*").alias("votes"), F.min(F.struct("node", "hub")).alias("pair"))
    best = votes.groupBy("root").agg(
        F.min(F.struct((-F.col("votes")).alias("v"), F.col("other").alias("o"), F.col("pair").alias("pair"))).alias("best"),
        F.min(F.struct(F.col("other").alias("o"), F.col("pair").alias("pair"))).alias("least"),
    )
    return best.select(F.explode(F.array_distinct(F.array("best.pair", "least.pair"))).alias("p")).select(F.col("p.node").alias("a"), F.col("p.hub").alias("b"))


def possible(pairs: DataFrame, nodes: DataFrame, bands: Bands) -> DataFrame:
    """The (a, b) of ``pairs`` that sizes and sketches allow."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("odd").alias(f"odd_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "odd_a", "odd_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "odd_a", SEGMENT):
            n_a, n_b = (np.asarray(batch.column(c)).astype(np.int64) for c in ("n_a", "n_b"))
            differ = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column("odd_a").to_pylist(), batch.column("odd_b").to_pylist())):
                bits = 8 * min(len(x), len(y))
                differ[k] = np.bitwise_count(folded(x, bits) ^ folded(y, bits)).sum(dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(differ <= bands.allowed(n_a, n_b)))

    return joined.mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, rows: DataFrame, places: DataFrame, percent: int, words: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough.

    The texts of all a meet the text of b, at most about ``BUCKET`` in a bucket; a task holds the
    set of one b and of one a.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / BUCKET).alias("parts"))
    bucket = F.xxhash64("b", F.pmod(F.xxhash64("a"), F.col("parts"))).alias("bucket")
    placed = materialise(pairs.join(parts, "b").select("a", "b", bucket), "proposed-pairs")
    held = placed.select("bucket", F.lit(0).alias("kind"), F.col("b").alias("node")).distinct()
    wanted = held.unionByName(placed.select("bucket", F.lit(1).alias("kind"), F.col("a").alias("node"))).join(places.select("node", "did", "th"), "node")
    wanted = materialise(wanted, "wanted-texts")
    texts = split(rows, wanted.select("did", "th"))[0].dropDuplicates(["did", "th"])
    stream = texts.join(wanted, ["did", "th"]).select("bucket", "kind", "node", "packed_text").repartition("bucket").sortWithinPartitions("bucket", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        b, mine = None, np.zeros(0, U)
        for batch in slices(batches, "packed_text", SEGMENT):
            out = []
            for _, kind, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingles(unpack(text), words)
                if kind == 0:
                    b, mine = node, found
                    continue
                both = len(np.intersect1d(found, mine, assume_unique=True))
                if 100 * both >= percent * (len(found) + len(mine) - both):
                    out.append((node, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["a", "b"])

    return materialise(stream.mapInArrow(run, "a long, b long"), "links")


def rest(entries: DataFrame, nodes: DataFrame, bands: Bands, block: int = BLOCK) -> DataFrame:
    """a, b: pairs of ``open_entries`` that share a signature, lie in different components and pass the sketches."""
    blocks = entries.groupBy("sig").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    opened = entries.join(blocks, "sig")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    dealt = opened.select("*", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met"))
    side = F.when(F.col("own") == F.col("met"), 2).otherwise((F.col("own") > F.col("met")).cast("int"))
    bucket = F.xxhash64("sig", F.least("own", "met"), F.greatest("own", "met"))
    # a node has as many signatures as half its shingles at most
    firsts = entries.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("sig")), 1, FIRSTS).alias("firsts"))
    dealt = dealt.select("band", "sig", bucket.alias("bucket"), side.alias("side"), "node", "root")
    dealt = dealt.join(nodes.select("node", "n_shingles", "odd").join(firsts, "node"), "node")
    stream = dealt.repartition("bucket").sortWithinPartitions("band", "bucket", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bucket_, side_, node, root, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("bucket", "side", "node", "root", "n_shingles"))
            bits = int(bands.bits[batch.column("band")[0].as_py()])
            odd = np.stack([folded(x, bits) for x in batch.column("odd").to_pylist()])
            sig = np.asarray(batch.column("sig")).astype(np.int64)
            firsts_ = np.arange(-1, -1 - len(sig), -1)[:, None].repeat(FIRSTS, 1)  # no two fill in alike
            for k, own_ in enumerate(batch.column("firsts").to_pylist()):
                firsts_[k, : len(own_)] = own_
            step = max(1, PAIRS_BYTES * 8 // bits)

            def here(i, j):
                """Pairs that no other bucket tells: by the least signature that both show, or by none."""
                shared = (firsts_[i][:, :, None] == firsts_[j][:, None, :]).any(2)
                least = np.where(shared, firsts_[i], np.iinfo(np.int64).max).min(1)
                return ~shared.any(1) | (least == sig[i])

            at, a, b = np.arange(len(node)), [], []
            for reach in range(1, len(node)):
                at = at[at + reach < len(node)]
                at = at[bucket_[at] == bucket_[at + reach]]
                if not len(at):
                    break
                i = at[(root[at] != root[at + reach]) & ((side_[at] != side_[at + reach]) | (side_[at] == 2))]
                most = bands.allowed(n[i], n[i + reach])
                i, most = i[most >= 0], most[most >= 0]
                for lo in range(0, len(i), step):
                    some = i[lo : lo + step]
                    differ = np.bitwise_count(odd[some] ^ odd[some + reach]).sum(1, dtype=np.int64)
                    some = some[differ <= most[lo : lo + step]]
                    some = some[here(some, some + reach)]
                    a.append(node[some])
                    b.append(node[some + reach])
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "odd", SEGMENT):
            bucket_, band = np.asarray(batch.column("bucket")), np.asarray(batch.column("band"))
            cuts = np.flatnonzero((np.diff(bucket_) != 0) | (np.diff(band) != 0)) + 1
            if held and (held[-1].column("bucket")[-1].as_py(), held[-1].column("band")[-1].as_py()) != (bucket_[0], band[0]):
                cuts = np.r_[0, cuts]
            last, size = 0, sum(x.num_rows for x in held)
            before = held[-1].column("band")[-1].as_py() if held else band[0]
            for cut in cuts.tolist():
                here = band[cut - 1] if cut > last else before
                if size + cut - last >= block or band[cut] != here:
                    if cut > last:
                        held.append(batch.slice(last, cut - last))
                    yield found(held)
                    held, size, last = [], 0, cut
            if batch.num_rows > last:
                held.append(batch.slice(last))
        if held:
            yield found(held)

    return stream.mapInArrow(run, "a long, b long").distinct()


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Rows are linked when 100 * intersection >= ``percent`` * union of their sets of ``words``-word
    shingles.  A text without words (null and empty ones too) is linked with nothing and is its own
    component.  Rows that repeat a doc_id are linked as rows of their own; a null doc_id is below all
    others and comes back as null.  An empty table gives no rows; other columns are ignored.
    """
    bands = Bands(percent)
    rows = keyed(docs)
    sets = materialise(shingle_sets(rows, bands, words), "shingle-sets")
    worded = sets.where("node is not null")
    place = F.min(F.struct("did", "th")).alias("place")
    nodes = worded.groupBy("node").agg(place, F.first("n_shingles").alias("n_shingles"), F.first("odd").alias("odd"))
    nodes = materialise(nodes.select("node", "place.did", "place.th", "n_shingles", "odd"), "set-nodes")
    entries = materialise(shared_entries(rows, nodes, bands, words), "shared-signatures")
    proposed = materialise(possible(first_proposals(entries), nodes, bands), "proposals")
    links = confirm(proposed, rows, nodes, percent, words)
    turn, settled = 0, False
    while True:
        entries = materialise(open_entries(entries, materialise(nearby(links), "node-roots")), "open-signatures")
        if settled:
            break
        turn += 1
        proposed = materialise(possible(proposals(entries, turn), nodes, bands), "proposals")
        found = confirm(proposed, rows, nodes, percent, words)
        links = links.unionByName(found)
        settled = found.count() * SETTLED <= entries.select("root").distinct().count()
    more = materialise(rest(entries, nodes, bands, block), "open-pairs")
    links = links.unionByName(confirm(more, rows, nodes, percent, words))
    parts = materialise(components(links), "components")
    grouped = worded.select("did", "node").join(parts, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("did").alias("component"))
    found = sets.select("did", "node", "n_shingles").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = found.join(grouped, "root", "left").withColumn("component", F.coalesce("component", "did"))
    back = lambda c: F.when(F.col(c) != -(1 << 63), F.col(c))
    return found.select(back("did").alias("doc_id"), "n_shingles", back("component").alias("component_id"))


#: Shingles as strings, all pairs that share one, components by a recursive walk.
SQL = f"""
with recursive lists as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i : i + {WORDS - 1}], ' ') s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) i from lists where len(w) > 0)
), sizes as (select doc_id, count(*) n from shingles group by doc_id),
pairs as (
    select x.doc_id a, y.doc_id b, count(*) c from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all
), links as (
    select a, b from pairs join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= {PERCENT} * (p.n + q.n - c)
), edges as materialized (select a, b from links union all select b, a from links),
reach as (
    select doc_id, doc_id seen from documents
    union
    select r.doc_id, e.b from reach r join edges e on e.a = r.seen
)
select d.doc_id, cast(coalesce(any_value(s.n), 0) as bigint) n_shingles, min(r.seen) component_id
from documents d left join sizes s on s.doc_id = d.doc_id join reach r on r.doc_id = d.doc_id group by d.doc_id
"""


@query("op12_ngram_join", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))
