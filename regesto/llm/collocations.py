"""Operator 11: phrase collocations from one FM-index per shard.

Texts of a language are cut at punctuation into pieces and those into words.  A task joins the
pieces of its documents to shards of about ``SHARD_WORDS`` words; a shard is stored as its vocabulary
and the Burrows-Wheeler transform of its word ids, with contexts of ``DEPTH`` words (no phrase is
longer).  Both ends of a phrase are extended on that index:

* to the left by the inverse of the LF mapping, for all intervals of one length at once: the entry
  at rank j of the first column is its word put before what the entry at ``psi[j]`` starts with;
* to the right by nothing: the entries that start with a phrase are an interval, and its right
  extensions are the sub-intervals in which the next length lies.

A phrase of k words is counted in a shard if its first and its last k - 1 words occur ``least``
times in all shards together (Apriori).  What is frequent travels as a Bloom filter of a fixed
size, so a shard may count a phrase too many, never too few; counts of shards are added by Spark,
with partial sums, and only then compared with ``least``.  Counts go by name alone; a last pass has
one shard of each frequent phrase spell it.

Phrases are named by 64-bit hashes of language and words.  All later tables (counts of first and
last parts, texts, extensions) hold frequent phrases only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import give_back, materialise, slices, table
from regesto.llm.substring_dedup import U, bloom, might_hold, mix, signed

LEAST = 100
DEPTH = 5
TOP = 2000
PER_MILLE = 1000
SHARD_WORDS = 1 << 21
DEALT = 256  # parts of a language that are ranked apart before its best phrases meet

_MUL = U(0x9E3779B97F4A7C15)
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Lower-cases A-Z, makes a space of each tab and a line feed of each piece's end.
_FOLD = _FOLD.translate(bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)))


def extend(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Names of the phrases that put the word ``first`` before the phrase ``rest``."""
    return mix(mix(rest + _MUL) * _MUL + first)


def _language(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode())


def _tokens(raws: list[bytes]) -> list[bytes]:
    """Words and line feeds (ends of pieces) of whole texts, with empty strings between."""
    return b"\n".join(raws).translate(_FOLD).replace(b"\n", b" \n ").split(b" ")


class _Shard:
    """Words of one language that wait to be indexed: hashes, 0 at the end of a piece."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.words: dict[int, bytes] = {}

    def add(self, raws: list[bytes]) -> int:
        import xxhash

        tokens = _tokens(raws)
        name = xxhash.xxh3_64_intdigest
        hashes = np.fromiter(map(name, tokens), U, len(tokens))
        codes, found = pd.factorize(hashes)
        at = np.empty(len(found), np.int64)
        at[codes[::-1]] = np.arange(len(codes))[::-1]
        self.words.update(zip(found.tolist(), map(tokens.__getitem__, at.tolist())))
        end = hashes == U(name(b"\n"))
        hashes[end] = 0
        hashes = hashes[hashes != U(name(b""))]
        end = hashes == 0
        hashes = hashes[~(end & np.r_[True, end[:-1]])]
        self.parts.append(np.append(hashes, U(0)))
        return len(hashes)

    def index(self) -> tuple[list[bytes], np.ndarray] | None:
        """Vocabulary and transform (ids from 1, 0 at the end of a piece), or None without words."""
        hashes = np.concatenate([np.zeros(1, U), *self.parts])
        found, ids = np.unique(hashes, return_inverse=True)
        if len(found) < 2:
            return None
        return [self.words[h] for h in found[1:].tolist()], transform(ids, len(found))


def transform(ids: np.ndarray, size: int, depth: int = DEPTH) -> np.ndarray:
    """The word before each position, in the order of the ``depth`` words from there on."""

    def later(x: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])

    rank, count, known = ids.astype(np.int64), size, 1
    while known < depth:  # by doubling; the last step takes what is missing
        by = min(known, depth - known)
        _, rank = np.unique(rank * count + later(rank, by), return_inverse=True)
        count, known = int(rank.max()) + 1, known + by
    return np.roll(ids, 1)[np.argsort(rank, kind="stable")].astype(np.int32)


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, n_words, shard (a name), vocabulary, bwt (both zstandard): a row per shard and language of ``docs``."""
    rows = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    )
    schema = "lang string, n_words long, shard long, vocabulary binary, bwt binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        held: dict[str, _Shard] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                if (got := held.pop(lang).index()) is not None:
                    words, bwt = got
                    name = xxhash.xxh3_64_intdigest(bwt.tobytes(), _language(lang))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang], pa.string()),
                            pa.array([int((bwt > 0).sum())], pa.int64()),
                            signed(np.array([name], U)),
                            pa.array([pack(b" ".join(words))], pa.binary()),
                            pa.array([pack(bwt.tobytes())], pa.binary()),
                        ],
                        names=["lang", "n_words", "shard", "vocabulary", "bwt"],
                    )
            give_back()

        for batch in slices(batches, "raw"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            raws = np.array(batch.column("raw").to_pylist() + [None], object)[:-1]
            for lang in dict.fromkeys(langs):
                size += held.setdefault(lang, _Shard()).add(raws[langs == lang].tolist())
            if size >= shard_words:
                yield from flush()
                size = 0
        yield from flush()

    return rows.mapInArrow(run, schema)


class _Intervals:
    """The intervals of one shard, for longer and longer phrases."""

    def __init__(self, row: pa.RecordBatch, frequent: list):
        import xxhash
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        self.lang, _, self.shard, words, bwt = (c[0].as_py() for c in row.columns)
        self.words = unpack(words).split(b" ")
        names = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), U, len(self.words))
        names = np.concatenate([np.zeros(1, U), mix(names ^ U(_language(self.lang)))])
        bwt = np.frombuffer(unpack(bwt), np.int32)
        # where each entry of the first column goes on: the inverse of LF
        self.psi = np.argsort((bwt.astype(np.int64) << 32) | np.arange(len(bwt)))
        self.column = bwt[self.psi]
        self.frequent = frequent
        self.first = self.key = names[self.column]
        self.good = self.column > 0
        self.length = 1
        self.start = self.rest = np.zeros(len(bwt), U)

    def extend(self) -> None:
        """One word more to the left of what each entry goes on with; both shorter phrases must be frequent."""
        self._test(self.frequent[self.length - 1])
        self.start, self.rest = self.key, self.key[self.psi]
        self.key = extend(self.first, self.rest)
        self.good = self.good & self.good[self.psi]
        self.length += 1

    def _test(self, filter_) -> None:
        some = np.flatnonzero(self.good)
        self.good[some] = might_hold(filter_.value, self.key[some])

    def heads(self) -> tuple[np.ndarray, np.ndarray]:
        """First entry and size of the interval of every phrase that is left."""
        at = np.flatnonzero(self.good)  # entries that start alike lie together
        head = np.flatnonzero(np.r_[True, self.key[at[1:]] != self.key[at[:-1]]]) if len(at) else at
        return at[head], np.diff(np.r_[head, len(at)])


def count_phrases(index: DataFrame, length: int, frequent: list) -> DataFrame:
    """key, n, shard of the phrases of ``length`` words in each shard whose first and last
    ``length`` - 1 words may be frequent; ``frequent`` has a broadcast filter per shorter length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, "bwt", 1):
            shard = _Intervals(row, frequent)
            while shard.length < length:
                shard.extend()
            at, n = shard.heads()
            own = np.full(len(at), shard.shard, np.int64)
            yield pa.RecordBatch.from_arrays([signed(shard.key[at]), pa.array(n.astype(np.int64)), pa.array(own)], names=["key", "n", "shard"])

    return index.mapInArrow(run, "key long, n long, shard long")


def spell_phrases(index: DataFrame, depth: int, frequent: list, chosen) -> DataFrame:
    """length, key, lang, word (the first one), start, rest (names of all but the last and the first
    word) of frequent phrases, from the shards that ``chosen``, a broadcast filter of key XOR shard, may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, "bwt", 1):
            shard = _Intervals(row, frequent)
            own = np.int64(shard.shard).view(U)
            while True:
                at, _ = shard.heads()
                at = at[might_hold(chosen.value, shard.key[at] ^ own)]
                words = pa.array([shard.words[i - 1] for i in shard.column[at].tolist()], pa.binary()).cast(pa.string())
                length, lang = pa.array([shard.length] * len(at), pa.int32()), pa.array([shard.lang] * len(at), pa.string())
                names = [signed(x[at]) for x in (shard.key, shard.start, shard.rest)]
                yield pa.RecordBatch.from_arrays([length, lang, words, *names], names=["length", "lang", "word", "key", "start", "rest"])
                if shard.length == depth:
                    break
                shard.extend()

    return index.mapInArrow(run, "length int, lang string, word string, key long, start long, rest long")


def frequent_phrases(index: DataFrame, least: int = LEAST, depth: int = DEPTH) -> list[DataFrame]:
    """A table per length from 1 on: key, start, rest (names of all but the last and first word),
    lang, phrase, n, firsts and lasts (counts of its first and last 1, 2, ... words)."""
    context = index.sparkSession.sparkContext
    counts, filters = [], []
    for length in range(1, depth + 1):
        counted = count_phrases(index, length, filters).groupBy("key").agg(F.sum("n").alias("n"), F.min("shard").alias("shard"))
        counts.append(materialise(counted.where(F.col("n") >= least), f"counts-{length}"))
        filters.append(context.broadcast(bloom(counts[-1], F.col("key"))))
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    chosen = context.broadcast(bloom(every, F.col("key").bitwiseXOR(F.col("shard"))))
    spelled = spell_phrases(index, depth, filters, chosen).groupBy("length", "key").agg(*[F.min(c).alias(c) for c in ("lang", "word", "start", "rest")])
    spelled = materialise(spelled, "spelled-phrases")
    out: list[DataFrame] = []
    for length in range(1, depth + 1):
        level = counts[length - 1].join(spelled.where(F.col("length") == length), "key")
        if length == 1:
            none = F.array().cast("array<long>")
            level = level.select("key", "start", "rest", "lang", F.col("word").alias("phrase"), "n", none.alias("firsts"), none.alias("lasts"))
        else:
            longer = lambda c: F.concat(c, F.array("n")).alias(c)
            last = out[-1].select(F.col("key").alias("rest"), F.col("phrase").alias("rest_phrase"), longer("lasts"))
            head = out[-1].select(F.col("key").alias("start"), longer("firsts"))
            level = level.join(last, "rest").join(head, "start")
            level = level.select("key", "start", "rest", "lang", F.concat_ws(" ", "word", "rest_phrase").alias("phrase"), "n", "firsts", "lasts")
        out.append(materialise(level, f"phrases-{length}"))
    return out


def score(rows: DataFrame, n_words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of ``rows`` (lang, phrase, a, firsts, lasts) by the worst cut."""
    exact = lambda c: f"cast({c} as decimal(20,0))"
    # the first part's length counts from 1, the last part has the other words
    cut = f"""transform(firsts, (l, i) -> named_struct(
        'score', {PER_MILLE} * {exact('a')} * {exact('n_words')} div ({exact('l')} * {exact('lasts[size(lasts) - 1 - i]')}),
        'k', i, 'l', l, 'r', lasts[size(lasts) - 1 - i]))"""
    return rows.join(n_words, "lang").withColumn("cut", F.array_min(F.expr(cut))).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("n_words").alias("n"), F.col("cut.score").alias("score")
    )


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language of ``docs`` (lang, text).

    Phrases of 2 to ``depth`` words that occur ``least`` times; a phrase that a longer one holds as
    often is left out.  The score is that of the worst cut, floor(1000 * a * n / (l * r)), exact in
    38 digits; ties of cuts go to the shortest first part, ties of phrases to the more frequent,
    then to the least in byte order.  Null text is empty, a null language is ``und``; repeated rows
    count as often as they occur; an empty table gives no rows; other columns are ignored.
    """
    index = materialise(build_index(docs, shard_words), "fm-index")
    n_words = index.groupBy("lang").agg(F.sum("n_words").alias("n_words"))
    levels = frequent_phrases(index, least, depth)
    kept = []
    for k in range(2, depth + 1):
        level = levels[k - 1]
        if k < depth:
            longer = levels[k].select(F.explode(F.array("start", "rest")).alias("key"), F.col("n").alias("longer"))
            longer = longer.groupBy("key").agg(F.max("longer").alias("longer"))
            level = level.join(longer, "key", "left").where("longer is null or longer < n")
        kept.append(level.select("lang", "phrase", "n", "firsts", "lasts"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    rows = score(rows.withColumnRenamed("n", "a"), n_words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(DEALT)).alias("part")
    some = rows.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = some.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The contract's rules over plain word lists.
SQL = f"""
with pieces as (
    select coalesce(lang, 'und') lang, doc_id, row_number() over () piece_id, piece from (
        select lang, doc_id, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) piece from documents)
), lists as (
    select lang, piece_id, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') w from pieces
), grams as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') phrase, count(*) c
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from lists, (select unnest(range(1, {DEPTH + 1})) k) where len(w) >= k)
    group by all
), sizes as (select lang, sum(c) n from grams where k = 1 group by lang),
frequent as (select lang, k, phrase, string_split(phrase, ' ') w, c from grams where c >= {LEAST}),
cuts as (
    select p.lang, p.phrase, p.k, p.c a, c1.k cut, c1.c l, c2.c r, s.n,
        cast({PER_MILLE} as hugeint) * p.c * s.n // (cast(c1.c as hugeint) * c2.c) score
    from (select *, unnest(range(1, k)) j from frequent where k >= 2) p
    join frequent c1 on c1.lang = p.lang and c1.phrase = array_to_string(p.w[1 : p.j], ' ') and c1.k = p.j
    join frequent c2 on c2.lang = p.lang and c2.phrase = array_to_string(p.w[p.j + 1 : p.k], ' ') and c2.k = p.k - p.j
    join sizes s on s.lang = p.lang
), worst as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), held as (
    select distinct lang, array_to_string(w[i : i + m - 1], ' ') phrase, c
    from (select lang, w, c, k, m, unnest(range(1, k - m + 2)) i from frequent, (select unnest(range(2, {DEPTH})) m) where m < k)
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from worst x
    where not exists (select 1 from held h where h.lang = x.lang and h.phrase = x.phrase and h.c >= x.a)
)
select lang, cast(rank as bigint) rank, phrase, cast(a as bigint) a, cast(l as bigint) l, cast(r as bigint) r, cast(n as bigint) n, cast(score as bigint) score
from ranked where rank <= {TOP}
"""


@query("op11_collocations", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
