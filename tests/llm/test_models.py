"""The two classifiers against their formulas in plain Python."""

import collections
import math
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests_llm_brute import rows

from regesto.llm import quality_model, toxicity

MASK = (1 << 64) - 1


def made(n, seed):
    rng = random.Random(seed)
    calm, rude = [f"calm{k}" for k in range(60)], [f"Rude{k}!" for k in range(12)]
    data, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.3
        words = [rng.choice(rude if toxic and rng.random() < 0.3 else calm) for _ in range(rng.randint(0, 40))]
        data.append((k, " ".join(words) + rng.choice(["", "\n#é 7", " Più"])))
        if rng.random() < 0.8:
            labels.append((k, int(toxic)))
    return data, labels


def feature_set(text):
    words, word = [], bytearray()
    for b in text.encode() + b" ":
        if b >= 0x80 or chr(b).isalnum():
            word.append(ord(chr(b).lower()) if b < 0x80 else b)
        elif word:
            words.append(bytes(word))
            word = bytearray()
    odd = [int(x) for x in toxicity._ODD]
    h = [xxhash.xxh3_64_intdigest(w) for w in words]
    found = [x * odd[0] & MASK for x in h]
    found += [xxhash.xxh3_64_intdigest(w[:n], n) for n in toxicity.STEMS for w in words]
    for skip in (1, 2, 3):
        found += [(a * odd[skip] + b) * odd[0] & MASK for a, b in zip(h, h[skip:])]
    return sorted({x >> (64 - toxicity.BITS) for x in found})


class PlainFtrl:
    """McMahan's update, one coordinate at a time."""

    def __init__(self, z, n):
        self.z, self.n = collections.defaultdict(float, z), collections.defaultdict(float, n)

    def weight(self, i):
        z = self.z[i]
        if abs(z) <= toxicity.L1:
            return 0.0
        return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(self.n[i])) / toxicity.ALPHA + toxicity.L2)

    def margin(self, found):
        x = 4.0 / (len(found) + 1) ** 0.25
        return sum(self.weight(i) for i in found) * x + self.weight("bias")

    def learn(self, found, label, times):
        x = 4.0 / (len(found) + 1) ** 0.25
        miss = (1 / (1 + math.exp(-self.margin(found))) - label) * times
        w = {i: self.weight(i) for i in [*found, "bias"]}
        for i in w:
            g = miss * (1.0 if i == "bias" else x)
            self.z[i] += g - (math.sqrt(self.n[i] + g * g) - math.sqrt(self.n[i])) / toxicity.ALPHA * w[i]
            self.n[i] += g * g


def test_ftrl_matches_its_formula(spark):
    data, labels = made(160, 3)
    df = spark.createDataFrame(data, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    learnt = known.where(~toxicity.held_out("doc_id", 5, 0))
    order = sorted(rows(learnt.select(F.xxhash64("doc_id").alias("o"), "doc_id", "toxic")))
    texts = {k: feature_set(t) for k, t in data}
    assert all(toxicity.features(t).tolist() == texts[k] for k, t in data)
    ones = min(toxicity.MAX_CLASS_WEIGHT, max(1.0, sum(1 - y for _, _, y in order) / max(1, sum(y for _, _, y in order))))
    z, n = {}, {}
    for _ in range(toxicity.ROUNDS):
        shards = []
        for shard in range(toxicity.SHARDS):
            model = PlainFtrl(z, n)
            for o, k, y in order:
                if o % toxicity.SHARDS == shard:
                    model.learn(texts[k], y, ones if y else 1.0)
            shards.append(model)
        z, n = ({i: old.get(i, 0) + sum(getattr(m, c)[i] - old.get(i, 0) for m in shards) / toxicity.SHARDS for i in set().union(*[getattr(m, c) for m in shards])} for c, old in (("z", z), ("n", n)))
    model = PlainFtrl(z, n)
    want = {k: 1 / (1 + math.exp(-model.margin(texts[k]))) for k, _ in data}
    got = dict(rows(toxicity.toxicity(df, known), "doc_id", "score"))
    assert max(abs(got[k] - want[k]) for k in want) < 1e-3
    assert max(want.values()) > 0.9 and min(want.values()) < 0.2


def test_one_text_of_a_repeated_id_is_learnt(spark):
    data, labels = made(60, 4)
    extra = [(k, "zzz " * (k + 1)) for k in range(20)]
    known = spark.createDataFrame(labels, "doc_id long, label int")
    models = [toxicity.train(spark.createDataFrame(x, "doc_id long, text string").repartition(3), known) for x in (data + extra, extra + data + extra)]
    assert models[0][0].tolist() == models[1][0].tolist() and np.allclose(models[0][1], models[1][1])


def test_the_discriminant_matches_its_formula(spark):
    data, labels = made(300, 5)
    df = spark.createDataFrame(data, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    out = dict(rows(df.select("doc_id", quality_model.held_out("doc_id", 3, 1))))
    x = {k: quality_model.statistics(t) for k, t in data}
    classes = [np.array([x[k] for k, y in labels if y == c and not out[k]]) for c in (0, 1)]
    total = sum(map(len, classes))
    within = sum((c - c.mean(0)).T @ (c - c.mean(0)) for c in classes) / total
    scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
    logs = []
    for c in classes:
        own = (c - c.mean(0)).T @ (c - c.mean(0)) / len(c)
        cov = ((1 - quality_model.POOLED) * own + quality_model.POOLED * within) / np.outer(scale, scale)
        cov = (1 - quality_model.ROUND) * cov + quality_model.ROUND * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
        far = {k: (v - c.mean(0)) / scale for k, v in x.items()}
        logs.append({k: math.log(len(c) / total) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * v @ np.linalg.solve(cov, v) for k, v in far.items()})
    want = {k: 1 / (1 + math.exp(min(500, max(-500, logs[0][k] - logs[1][k])))) for k in x}
    got = dict(rows(quality_model.quality(df, known), "doc_id", "score"))
    assert max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_statistics_of_a_small_text():
    got = dict(zip(quality_model.NAMES, quality_model.statistics("Ab ab ab\n\nAb ab ab\n7 # è")))
    share = lambda p: math.asin(math.sqrt(p))
    assert math.isclose(got["words"], math.log1p(9)) and math.isclose(got["distinct_words"], share(5 / 9)) and math.isclose(got["top_word"], share(4 / 9))
    assert math.isclose(got["same_next"], share(2 / 8)) and math.isclose(got["lines"], math.log1p(3)) and math.isclose(got["repeated_lines"], share(1 / 3))
    assert math.isclose(got["digits"], share(1 / 16)) and math.isclose(got["symbols"], share(1 / 16)) and math.isclose(got["high_bytes"], share(2 / 16))
    assert math.isclose(got["upper"], share(2 / 16)) and math.isclose(got["capital_words"], share(2 / 9))
    assert not quality_model.statistics(None).any() and not quality_model.statistics(" \n").any()
