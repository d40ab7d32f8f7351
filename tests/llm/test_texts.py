"""Quality rules, near-duplicates, repeated strings, decontamination, classifiers and the pipeline."""

import collections
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tests_llm_brute import (  # noqa: F401
    check_packing, contaminated, cut_repeats, edge_docs, edge_rows, kept_bytes, near_groups, no_docs, quality, rows, shingle_set, substring_digest,
)

import corpus_pipeline
from regesto.llm import QUERIES, decontaminate, load_all, near_dedup, quality_model, quality_rules, substring_dedup, toxicity
from regesto.llm.common import table, tokenizer_file

SF, SF01, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def by_text(r):
    return (r[0] is not None, r[0] or 0, str(r[1:]))


def test_all_are_registered():
    load_all()
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


# -- quality rules


def test_quality_edges(spark, edge_docs, no_docs):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = rows(quality_rules.quality_rules(edge_docs), *names, "kept")
    want = []
    for r in edge_rows():
        q = quality(r[1])
        want.append((r[0], *q, q[0] < 10 or 100 * q[4] > 20 * q[0]))
    assert sorted((g[:-1] for g in got), key=by_text) == sorted(want, key=by_text)
    assert all(not g[-1] for g in got if g[-2])
    assert quality_rules.quality_rules(no_docs).count() == 0 == quality_rules.filter_documents(no_docs).count()


def test_quality_filter_keeps_rows_as_they_are(spark, edge_docs):
    verdicts = collections.Counter(rows(quality_rules.quality_rules(edge_docs).where("kept"), "doc_id"))
    kept = quality_rules.filter_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    assert collections.Counter(rows(kept, "doc_id")) == verdicts
    assert set(map(tuple, kept.collect())) <= set(map(tuple, edge_docs.collect()))


def test_quality_rules_match_the_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(f"select {', '.join(quality_rules.OUT)} from ({quality_rules.SQL})").fetchall()
    assert sorted(rows(quality_rules.op10(spark, SF), *quality_rules.OUT)) == sorted(want)


def test_thresholds_adapt_to_the_group(spark):
    noisy = " ".join(["word%d" % k + ("#" if k % 3 == 0 else "") for k in range(60)])
    plain = " ".join("word%d" % k for k in range(60))
    data = [(k, noisy, "en", "code") for k in range(300)] + [(1000 + k, plain, "en", "prose") for k in range(300)] + [(2000, noisy, "en", "prose")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    assert sorted(r[0] for r in rows(quality_rules.quality_rules(df).where("not kept"), "doc_id")) == [2000]


def test_the_sketch_merges(spark):
    df = spark.createDataFrame([(str(k % 2), "s", k * k, 0, 0, k) for k in range(1000)], "lang string, source string, symbol_share long, dup_line_share long, repeat_share long, word_length long")
    whole = collections.Counter({tuple(r[:4]): r[4] for r in rows(quality_rules.sketch(df), "lang", "source", "statistic", "bucket", "n")})
    parts = collections.Counter()
    for k in (0, 1, 2):
        parts += collections.Counter({tuple(r[:4]): r[4] for r in rows(quality_rules.sketch(df.where(f"word_length % 3 = {k}")), "lang", "source", "statistic", "bucket", "n")})
    assert whole == parts


# -- near-duplicates


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    docs = sorted(rows(table(spark, SF01, "documents").select("doc_id", "text")))
    roots, sizes = near_groups([t for _, t in docs], percent)
    want = [(d, n, docs[r][0], docs[r][0] == d) for (d, _), r, n in zip(docs, roots, sizes)]
    assert sorted(rows(near_dedup.near_duplicates(table(spark, SF01, "documents"), percent))) == want


def test_near_duplicate_edges(spark, edge_docs, no_docs):
    got = collections.Counter(rows(near_dedup.near_duplicates(edge_docs)))
    docs = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    roots, sizes = near_groups([r[1] for r in docs], 80)
    assert got == collections.Counter((d[0], n, docs[r][0], docs[r][0] == d[0]) for d, r, n in zip(docs, roots, sizes))
    assert near_dedup.near_duplicates(no_docs).count() == 0 == near_dedup.keep_one(no_docs).count()
    kept = near_dedup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [r[1] for r in kept.collect()]
    worded = [t for t in texts if shingle_set(t)]
    assert len(worded) == len({r for r, n in zip(roots, sizes) if n}) and len(texts) - len(worded) == sum(n == 0 for n in sizes)


def test_a_large_dense_group_is_one_component(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(5000)]
    base = [rng.choice(vocab) for _ in range(200)]
    texts = []
    for k in range(400):
        w = list(base)
        w[rng.randrange(200)] = f"new{k}"
        texts.append((k, " ".join(w)))
    # a bridge: similar enough to one text of the group only
    texts += [(1000 + k, " ".join(rng.choice(vocab) for _ in range(100))) for k in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    roots, _ = near_groups([t for _, t in texts], 85)
    got = {r[0]: r[2] for r in rows(near_dedup.near_duplicates(df, 85))}
    assert [got[d] for d, _ in texts] == [texts[r][0] for r in roots]


def test_a_pair_at_the_limit_whose_signatures_agree_little(spark):
    words = [f"w15358x{k}" for k in range(24)]
    texts = [" ".join(words[:22]), " ".join(words[2:])]
    sets = [shingle_set(t) for t in texts]
    assert 100 * len(sets[0] & sets[1]) == 80 * len(sets[0] | sets[1])
    a, b = (near_dedup.signature(near_dedup.shingles(t.encode())) for t in texts)
    assert (a == b).sum() < 61  # four standard deviations below 80 %
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(rows(near_dedup.near_duplicates(df, 80), "doc_id", "component_id")) == [(0, 0), (1, 0)]


def test_signatures_lose_less_than_the_forest():
    for t in (0.8, 0.85):
        chances = [math.comb(near_dedup.SIZE, k) * t**k * (1 - t) ** (near_dedup.SIZE - k) for k in range(near_dedup._threshold(round(100 * t)))]
        assert sum(chances) <= (1 - t**near_dedup.DEPTH) ** near_dedup.TREES / 100


def test_components_of_long_chains(spark):
    rng = random.Random(8)
    ids = rng.sample(range(10**9), 300)
    links = list(zip(ids[:199], ids[1:200])) + [(ids[200], ids[k]) for k in range(201, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in near_dedup.components(df).collect()}
    assert got == {x: min(ids[:200]) for x in ids[:200]} | {x: min(ids[200:]) for x in ids[200:]}
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- repeated strings


@pytest.mark.parametrize("small", [1, 1 << 14])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(substring_dedup, "SMALL", small)
    docs = rows(table(spark, SF, "documents").select("doc_id", "text"))
    want = [substring_digest(d, *x) for (d, _), x in zip(docs, cut_repeats([t for _, t in docs]))]
    assert sorted(rows(substring_dedup.op9(spark, SF))) == sorted(want)


def test_substring_edges(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SEGMENT", 1 << 16)  # the long text is worked on in pieces
    edge = edge_rows()
    cut = cut_repeats([r[1] for r in edge])
    want = [substring_digest(r[0], *x) for r, x in zip(edge, cut)]
    assert sorted(rows(substring_dedup.substring_dedup(edge_docs)), key=by_text) == sorted(want, key=by_text)
    assert substring_dedup.substring_dedup(no_docs).count() == 0 == substring_dedup.remove_repeats(no_docs).count()
    left = substring_dedup.remove_repeats(edge_docs)
    assert left.columns == edge_docs.columns
    texts = [None if r[1] is None else kept_bytes(*x).decode("utf-8", "ignore") for r, x in zip(edge, cut)]
    got = rows(left, "doc_id", "text", "n_chars")
    assert collections.Counter(got) == collections.Counter((r[0], t, None if t is None else len(t)) for r, t in zip(edge, texts))


def test_windows_of_a_periodic_text_and_a_shared_tail(spark):
    rng = random.Random(2)
    tail = "".join(rng.choice("abcdefgh ") for _ in range(260))
    data = [(1, "ab" * 300), (2, "q" * 250 + tail), (3, "z" * 90 + tail[:230]), (4, tail[30:]), (5, tail[61:260] + "!"), (6, "ab" * 101)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = [substring_digest(d, *x) for (d, _), x in zip(data, cut_repeats([t for _, t in data]))]
    assert sorted(rows(substring_dedup.substring_dedup(df))) == sorted(want)


def test_texts_of_one_id_that_share_a_32_bit_hash(spark):
    made = spark.range(400_000).select(F.concat_ws(" ", *[F.sha2(F.concat_ws("-", "id", F.lit(k)), 512) for k in range(2)]).alias("text"))
    same = made.groupBy(F.hash("text").alias("th")).agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a != b")
    a, b = same.orderBy("th").select("a", "b").first()
    data = [(None, a), (None, b), (7, a)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(rows(near_dedup.keep_one(df)), key=by_text) == sorted(data[:2], key=by_text)
    want = [substring_digest(d, *x) for (d, _), x in zip(data, cut_repeats([t for _, t in data]))]
    assert sorted(rows(substring_dedup.substring_dedup(df)), key=by_text) == sorted(want, key=by_text)
    assert sorted(rows(substring_dedup.remove_repeats(df)), key=by_text) == sorted([(None, ""), (None, b), (7, "")], key=by_text)


def test_many_equal_rows_are_one_entry_per_anchor(spark, monkeypatch):
    rng = random.Random(7)
    words = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    text, seen = words(900), {}
    data = [(None, text)] * 40 + [(1, words(300) + text[100:420] + words(300)), (2, words(50) + text[500:790]), (2, words(400))]
    keep = substring_dedup.materialise

    def note(df, name):
        seen[name] = keep(df, name)
        return seen[name]

    monkeypatch.setattr(substring_dedup, "materialise", note)
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = [substring_digest(d, *x) for (d, _), x in zip(data, cut_repeats([t for _, t in data]))]
    assert sorted(rows(substring_dedup.substring_dedup(df)), key=by_text) == sorted(want, key=by_text)
    states = [r.asDict() for r in seen["anchor-states"].collect()]
    assert states and all(len(r[c]) == len(set(r[c])) for r in states for c in ("whole", "shown"))
    hulls = rows(seen["open-hulls"], "g", "did", "th", "first", "lead")
    assert any(h[1] == -(1 << 63) for h in hulls) and len(hulls) == len(set(hulls))


# -- decontamination


def edited(words, k, rng, vocab):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        how = rng.choice("sid")
        if how == "d":
            del words[at]
        elif how == "i":
            words.insert(at, rng.choice(vocab))
        else:
            words[at] = rng.choice(vocab)
    return words


def test_decontamination_matches_brute_force(spark):
    docs = rows(table(spark, SF, "documents").select("doc_id", "text"))
    items = rows(table(spark, SF, "benchmark").select("item_id", "text"))
    docs = [d for d in docs if len(d[1]) < 2500][:80]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(decontaminate.contamination(df, table(spark, SF, "benchmark")), "doc_id", "item_id", "distance")
    want = [(d, i, n) for d, t in docs for i, n in contaminated(t, items).items()]
    assert sorted(got) == sorted(want)


def test_decontamination_recall_at_the_full_distance(spark):
    rng = random.Random(5)
    items = rows(table(spark, SF01, "benchmark").select("item_id", "text"))
    vocab = [w for r in table(spark, SF, "documents").limit(20).collect() for w in r["text"].split()]
    index = decontaminate.Items(items)
    found = total = 0
    for item_id, text in items:
        words = text.split()
        for _ in range(5):
            leak = edited(words, decontaminate.edits(len(words)), rng, vocab)
            doc = " ".join(rng.sample(vocab, 40) + leak + rng.sample(vocab, 40))
            if item_id in contaminated(doc, [(item_id, text)]):
                total += 1
                found += any(index.ids[x] == item_id for x in index.document(doc.encode()))
    assert total > 150 and found >= 0.99 * total


def test_decontamination_edges(spark, edge_docs, no_docs, monkeypatch):
    leak = " ".join(edge_rows()[5][1].split()[60_000:60_020])  # inside the long text
    items = spark.createDataFrame([(1, leak, 3), (2, None, 3), (3, "", 3), (None, "one two three", 3), (1, leak, 4)], "item_id long, text string, did int")
    monkeypatch.setattr(decontaminate, "STRETCH", 1 << 12)
    got = rows(decontaminate.contamination(edge_docs, items), "doc_id", "item_id", "distance")
    assert sorted(got, key=by_text) == [(5, 1, 0), (10, None, 0), (11, None, 0)]
    clean = decontaminate.drop_contaminated(edge_docs, items)
    assert clean.columns == edge_docs.columns and clean.count() == edge_docs.count() - 3
    none = items.limit(0)
    assert decontaminate.contamination(edge_docs, none).count() == 0 == decontaminate.contamination(no_docs, items).count()
    assert decontaminate.drop_contaminated(edge_docs, none).count() == edge_docs.count()


# -- classifiers


def held_out_scores(spark, query, label):
    got = query(spark, SF1)
    docs = table(spark, SF1, "documents")
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    joined = got.where("held_out").join(table(spark, SF1, "labels"), "doc_id")
    return np.array(rows(joined, label, "score", "predicted"), float)


def auc(x):
    order = x[np.argsort(x[:, 1], kind="stable"), 0]
    n1, n0 = order.sum(), (1 - order).sum()
    return (np.flatnonzero(order).sum() + n1 - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_toxicity_on_held_out_documents(spark):
    x = held_out_scores(spark, toxicity.op2, "toxic")
    assert auc(x) > 0.95 and (x[:, 0] == x[:, 2]).mean() > 0.95


def test_quality_on_held_out_documents(spark):
    x = held_out_scores(spark, quality_model.op8, "quality")
    assert auc(x) > 0.98 and (x[:, 0] == x[:, 2]).mean() > 0.98


def test_held_out_folds(spark):
    import zlib

    got = rows(spark.range(200).select("id", toxicity.held_out("id", 5, 0).alias("a"), toxicity.held_out("id", 3, 1).alias("b")))
    assert got == [(k, zlib.crc32(str(k).encode()) % 5 == 0, zlib.crc32(str(k).encode()) % 3 == 1) for k in range(200)]


@pytest.mark.parametrize("run, label", [(toxicity.toxicity, "toxic"), (quality_model.quality, "quality")])
def test_classifier_edges(spark, edge_docs, no_docs, run, label):
    labels = spark.createDataFrame([(1, 0, 5), (5, 1, 5), (8, 1, 5), (9, 0, 5), (12, 0, 5), (13, None, 5), (None, 1, 5), (16, 1, 5), (16, 0, 5), (99, 1, 5)], f"doc_id long, {label} int, score int")
    got = rows(run(edge_docs, labels))
    assert len(got) == len(edge_rows()) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in got)
    assert {r[2] for r in rows(run(edge_docs, labels.limit(0)))} == {0.5}
    one = rows(run(edge_docs, labels.where(f"{label} = 1")))
    assert len(one) == len(got)
    assert run(no_docs, labels).count() == 0


# -- the pipeline


def test_pipeline_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    kept = {r[0] for r in rows(quality_rules.op10(spark, SF).where("kept"), "doc_id")}
    one = stages["quality_rules"](spark, docs, SF)
    assert one.columns == docs.columns and {r[0] for r in rows(one, "doc_id")} == kept

    left = sorted(rows(one.select("doc_id", "text")))
    roots, _ = near_groups([t for _, t in left], 80)
    left = [left[r] for r in sorted(set(roots))]
    two = stages["minhash_near_dedup"](spark, one, SF)
    assert two.columns == docs.columns and sorted(rows(two.select("doc_id", "text"))) == left

    left = [(d, kept_bytes(*x).decode("utf-8", "ignore")) for (d, _), x in zip(left, cut_repeats([t for _, t in left]))]
    three = stages["suffix_array_dedup"](spark, two, SF)
    assert three.columns == docs.columns and sorted(rows(three.select("doc_id", "text"))) == left

    items = rows(table(spark, SF, "benchmark").select("item_id", "text"))
    index = decontaminate.Items(items)
    left = [(d, t) for d, t in left if not index.document(t.encode())]
    four = stages["benchmark_decontamination"](spark, three, SF)
    assert four.columns == docs.columns and sorted(rows(four.select("doc_id", "text"))) == left

    packed = corpus_pipeline.run(spark, SF)
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    places = rows(packed, "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    check_packing(places, left, lambda t: tokenizer.encode(t, add_special_tokens=False).ids, 2048)


def test_the_decontamination_stage_matches_brute_force(spark):
    rng = random.Random(9)
    items = rows(table(spark, SF, "benchmark").select("item_id", "text"))
    docs = [d for d in rows(table(spark, SF, "documents")) if len(d[1]) < 900][:40]
    vocab = [w for d in docs for w in d[1].split()]
    for k, (_, text) in enumerate(items[:12]):  # leaks at, below and above the allowed distance
        words = text.split()
        leak = edited(words, k % 4 * decontaminate.edits(len(words)) // 2, rng, vocab)
        docs.append((10_000 + k, " ".join(rng.sample(vocab, 20) + leak + rng.sample(vocab, 20)), "en", "s", 0))
    df = spark.createDataFrame(docs, table(spark, SF, "documents").schema)
    clean = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, df, SF)
    assert sorted(rows(clean)) == sorted(d for d in docs if not contaminated(d[1], items))


def test_of_rows_with_one_id_and_text_the_least_stays(spark):
    text = " ".join(f"w{k}" for k in range(30))
    data = [(1, text, "fr", "b"), (1, text, "en", "z"), (1, text, "en", "a"), (2, text, "de", "a")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string, source string").repartition(4)
        assert rows(near_dedup.keep_one(df)) == [(1, text, "en", "a")]
