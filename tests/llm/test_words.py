"""Phrase collocations, the n-gram Jaccard join and spelling variants against plain Python."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from tests_llm_brute import EDGE_SCHEMA, WORDS, edge_docs, edge_rows, lower, no_docs, rows  # noqa: F401

from regesto.llm import collocations, ngram_join, spelling
from regesto.llm.common import table

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def by_text(r):
    return str(r)


def oracle(sql, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    return con.execute(sql).fetchall()


# -- phrases


def phrases(docs, least, depth, top):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p) >= 3}
    held = collections.Counter()
    for (lang, *w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                p = (lang, *w[i : i + k])
                held[p] = max(held[p], a)
    out = collections.defaultdict(list)
    for (lang, *w), a in found.items():
        if held[(lang, *w)] >= a:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)]


def test_collocations_match_the_oracle(spark):
    want = oracle(f"select lang, rank, phrase, a, l, r, n, score from ({collocations.SQL})", SF01)
    assert len(want) > 50 and sorted(rows(collocations.op11(spark, SF01))) == sorted(want)


@pytest.mark.parametrize("shard_words, top", [(1 << 22, 50), (300, 7)])
def test_collocations_match_brute_force(spark, shard_words, top):
    rng = random.Random(1)
    vocab = ["a", "B", "c", "d,", "e.", "é", "Z\x00", "f\tg", "h;i", "ÄÖ"]
    docs = [(rng.choice(["en", "fr", None]), " ".join(rng.choice(vocab[: rng.randint(2, 10)]) for _ in range(rng.randint(0, 60)))) for _ in range(200)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = rows(collocations.collocations(df, 12, 5, top, shard_words))
    assert sorted(got) == sorted(phrases(docs, 12, 5, top)) and len(got) > 15


def test_collocation_edges(spark, edge_docs, no_docs):
    docs = [(r[2], r[1]) for r in edge_rows()]
    got = rows(collocations.collocations(edge_docs, 2, 5, 100_000))
    assert sorted(got) == sorted(phrases(docs, 2, 5, 100_000))
    assert collocations.collocations(no_docs).count() == 0


def test_an_index_counts_every_phrase():
    rng = random.Random(6)
    ids = np.array([0] + [rng.randrange(4) for _ in range(400)] + [0])
    bwt = collocations.transform(ids, 4)
    psi = np.argsort(bwt, kind="stable")
    column = bwt[psi]
    starts = [(int(column[j]),) for j in range(len(ids))]
    for k in range(2, 6):
        starts = [(int(column[j]), *starts[psi[j]]) for j in range(len(ids))]
        assert starts == sorted(starts)
        want = collections.Counter(tuple(ids[(i + x) % len(ids)] for x in range(k)) for i in range(len(ids)))
        got = collections.Counter(starts)
        assert all(got[p] == n for p, n in want.items() if 0 not in p[:-1])


def test_products_past_64_bits(spark):
    big = spark.createDataFrame([("en", "x y", 10**13, [2 * 10**13], [3 * 10**13])], "lang string, phrase string, a long, firsts array<long>, lasts array<long>")
    got = collocations.score(big, spark.createDataFrame([("en", 10**15)], "lang string, n_words long"))
    assert rows(got, "score") == [(1000 * 10**13 * 10**15 // (6 * 10**26),)]


# -- the Jaccard join


def jaccard(texts, percent=85, words=4):
    """(size, index of the least text that links reach) of each text."""
    sets = []
    for t in texts:
        w = WORDS.findall(lower(t))
        sets.append({tuple(w)} if 0 < len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)})
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for j, s in enumerate(sets):
        for i, both in collections.Counter(i for x in s for i in holders[x]).items():
            if 100 * both >= percent * (len(s) + len(sets[i]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in s:
            holders[x].append(j)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def test_the_join_matches_the_oracle(spark):
    want = oracle(f"select doc_id, n_shingles, component_id from ({ngram_join.SQL})", SF01)
    assert sorted(rows(ngram_join.op12(spark, SF01))) == sorted(want)


def varied(rng):
    """Texts of all sizes with copies at, above and below the threshold, and many of one template."""
    vocab = [f"w{k}" for k in range(3000)]
    out = []
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 9, 10, 14, 30, 80, 300]))]
        out.append(base)
        for _ in range(rng.randrange(4)):
            cut = list(base)
            for _ in range(rng.randrange(1 + len(base) // 18)):
                cut[rng.randrange(len(cut))] = rng.choice(vocab)
            out.append(cut[: len(cut) - rng.randrange(1 + len(cut) // 9)])
    template = [rng.choice(vocab) for _ in range(120)]
    for _ in range(60):
        copy = list(template)
        for _ in range(rng.randrange(1, 7)):
            copy[rng.randrange(120)] = rng.choice(vocab)
        out.append(copy)
    rng.shuffle(out)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("percent, block, proposed", [(85, 4096, True), (85, 8, False), (70, 16, False), (95, 4096, True)])
def test_the_join_matches_brute_force(spark, monkeypatch, percent, block, proposed):
    if not proposed:  # every link must come from the rest
        keep, first = ngram_join.proposals, ngram_join.first_proposals
        monkeypatch.setattr(ngram_join, "proposals", lambda opened, turn: keep(opened, turn).limit(0))
        monkeypatch.setattr(ngram_join, "first_proposals", lambda entries: first(entries).limit(0))
    texts = varied(random.Random(percent))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(ngram_join.jaccard_groups(df, percent, block=block))
    assert sorted(got) == [(k, n, r) for k, (n, r) in enumerate(jaccard(texts, percent))]


def test_join_edges(spark, edge_docs, no_docs):
    docs = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    want = [(d[0], n, docs[r][0]) for d, (n, r) in zip(docs, jaccard([d[1] for d in docs]))]
    assert sorted(rows(ngram_join.jaccard_groups(edge_docs)), key=by_text) == sorted(want, key=by_text)
    assert ngram_join.jaccard_groups(no_docs).count() == 0


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(3)
    bands = ngram_join.Bands(85)
    for size in (5, 40, 700):
        for gone in range(0, size // 4):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.r_[a[gone:], rng.integers(0, 1 << 63, gone // 2, dtype=np.uint64)])
            differ = len(np.setxor1d(a, b))
            x, y = (np.frombuffer(ngram_join.sketch(s, 1024), np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= differ
            fold = [ngram_join.folded(s.tobytes(), 128) for s in (x, y)]
            assert (fold[0] == np.frombuffer(ngram_join.sketch(a, 128), np.uint64)).all() and np.bitwise_count(fold[0] ^ fold[1]).sum() <= differ
            most = bands.allowed(np.array([len(a)]), np.array([len(b)]))[0]
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert differ <= most
                sigs = [set(ngram_join.signatures([s], bands)[0].tolist()) for s in (a, b)]
                assert sigs[0] & sigs[1] or differ == 0


# -- spelling


def variants(docs):
    """word -> (word, form, root, n, n_near, form_n) of (doc_id, text) rows."""
    count = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    n = {w: k for w, k in count.items() if len(w) >= 5 and k >= 3}
    near = {w: near_of(w, n) for w in n}
    form = {}
    for w in n:
        if near[w] and n[best := min(near[w], key=lambda x: (-n[x], x))] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def near_of(w, words):
    letters = set("".join(words))
    made = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i:] for c in letters for i in range(len(w) + 1)}
    made |= {w[:i] + c + w[i + 1 :] for c in letters for i in range(len(w))}
    return {x for x in made if x in words and x != w}


OUT = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_match_brute_force(spark):
    docs = rows(table(spark, SF, "documents").select("doc_id", "text"))
    want = variants(docs)
    got = rows(spelling.op13(spark, SF), *OUT)
    assert sorted(got) == sorted(want.values()) and sum(x[1] is not None for x in got) > 100


@pytest.mark.parametrize("block", [1024, 3])
def test_dense_words_match_brute_force(spark, block):
    rng = random.Random(block)
    docs = []
    for k in range(60):
        alphabet = rng.choice(["ab", "abé", "xÀ×÷ÿ"])
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(4, 9))) for _ in range(40)]
        docs.append((k, rng.choice([" ", "-", "1", "Ā"]).join(words * rng.randint(1, 4))))
    docs += [(100, "chain " * 3 + "chain" * 7), (101, "chains " * 8 + "chainsa " * 20 + "chainsab " * 50), (None, "chain Chain CHAIN")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(rows(spelling.spelling_variants(df, block=block), *OUT)) == sorted(variants(docs).values())


def test_near_of_a_block():
    rng = random.Random(5)
    words = list({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    rng.shuffle(words)
    i, j = spelling.near(words)
    got = collections.defaultdict(set)
    for a, b in zip(i.tolist(), j.tolist()):
        got[words[a]].add(words[b])
    assert len(i) == sum(map(len, got.values())) and all(got[w] == near_of(w, set(words)) for w in words)


def test_spelling_edges(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 1 << 12)
    got = rows(spelling.spelling_variants(edge_docs), *OUT)
    assert sorted(got) == sorted(variants([r[:2] for r in edge_rows()]).values()) and len(got) > 100
    assert spelling.spelling_variants(no_docs).count() == 0


def test_chains_end_at_their_root(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [("x", "w5")]
    got = dict(rows(spelling.roots(spark.createDataFrame(links, "word string, form string"))))
    assert got == {w: "w37" for w, _ in links}
