"""Plain forms of what the operators compute, and rows that try their edges."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did long, th int, raw string, rest string, node long, kept string, score string, part string, n_words string"


def edge_rows():
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage = words(120), words(60)
    texts = [
        (1, base), (1, base), (2, None), (3, ""), (4, " \n\t \r\n"), (5, words(90_000)), (6, base), (7, base + " one more"),
        (8, words(80) + "\n" + passage + "\n" + words(80)), (9, words(50) + "\n" + passage + "\n" + words(90)), (10, "one two three"),
        (11, "One TWO three"), (12, "spam " * 400), (13, "x" * 1000), (14, "</s> <|endoftext|> [INST] \\ <|turn|> \x00 \x1c ΑΣ İ é"),
        (None, words(30)), (None, None), (1, words(40)), (15, "é" * 300 + base[:90] + "é" * 300), (16, "line\n" * 30 + words(40)),
    ]
    out = []
    for k, (i, t) in enumerate(texts):
        lang, source = (None, "s") if k % 5 == 0 else ("en", None) if k % 7 == 0 else ("en", "s")
        out.append((i, t, lang, source, len(t) if t else None, 5, None, "r", None, 7, "x", None, "p", "w"))
    return out


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def edge_docs(spark):
    """Nulls, empty, blank and long texts, repeated rows and ids, and columns named like the operators' own."""
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingle_set(t):
    w = WORDS.findall(lower(t))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def near_groups(texts, percent):
    """Index of the first text of each text's component (its own for texts without words)."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    first = {}
    for k, s in enumerate(sets):
        if s:
            if s in first:
                join(first[s], k)
            else:
                first[s] = k
    holders = collections.defaultdict(list)
    for s, k in first.items():
        common = collections.Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                join(j, k)
        for x in s:
            holders[x].append(k)
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]


def cut_repeats(texts, length=200):
    """(whole bytes, mask of removed bytes) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in raws for p in range(len(b) - length + 1))
    out = []
    for b in raws:
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        out.append((b, mask))
    return out


def kept_bytes(b, mask):
    return bytes(x for x, m in zip(b, mask) if not m)


def substring_digest(doc_id, b, mask):
    runs = sum(1 for i in range(len(mask)) if mask[i] and (not i or not mask[i - 1]))
    return doc_id, len(b), sum(mask), runs, hashlib.sha256(kept_bytes(b, mask)).hexdigest()


def quality(t):
    t = t or ""
    w = WORDS.findall(t)
    grams = collections.defaultdict(list)
    for i in range(len(w) - 4):
        grams[tuple(w[i : i + 5])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def word_list(t):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0].lower() if m[0].isalnum() else " ", t or "").split(" ")


def contaminated(t, items, percent=20):
    """item_id -> least word edit distance, where it is small enough."""
    doc, out = [w for w in word_list(t) if w], {}
    for item_id, text in items:
        item = [w for w in word_list(text) if w]
        row = [0] * (len(doc) + 1)
        for k, x in enumerate(item):
            new = [k + 1]
            for j, y in enumerate(doc):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        if item and min(row) <= len(item) * percent // 100:
            out[item_id] = min(row)
    return out


def check_packing(got, docs, plain, capacity):
    want = collections.Counter()
    total = full = 0
    for i, t in docs:
        ids = [*plain(t), 0]
        total += len(ids)
        for p in range(0, len(ids), capacity):
            part = ids[p : p + capacity]
            want[(i, p // capacity, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter(r[:5] for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r[5]].append((r[6], r[3]))
    for parts in by.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    return len(by), -(-total // capacity)
