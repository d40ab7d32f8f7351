"""Helpers shared by the operators: tables, the shared folder, tokenizers, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from regesto.session import ensure_checkpoint_dir

#: Text bytes that are tokenized or hashed together inside a task.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files no executor owns."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def give_back() -> None:
    """Return what earlier tasks of this Python worker have freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``text`` (one row at least)."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // limit)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
    give_back()


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + len)."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def worker_state() -> dict:
    """What one Python worker keeps from task to task (vocabularies and the like, of bounded size)."""
    name = "_training_data_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


# The byte-level alphabet, where printable bytes stand for themselves and the others
# for the code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}

#: Words of precomposed Latin letters, with one mark behind at most: normalizing them is lower-casing
#: them, and the pre-tokenizer cuts off just the mark.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]?)")


#: Characters whose lower case ``str.lower`` may take from their neighbours, or make two of.
EXOTIC = re.compile("[^\x00-\u012f\u0131-\u024f]")


class ChunkEncoder:
    """Token ids of whole texts with the ``tokenizers`` library, each distinct chunk between two
    spaces or newlines encoded once.

    Sound for lower-casing byte-level tokenizers whose pre-tokenizer drops white space, so that no
    token spans a chunk's border.  Plain words go to the model's merges directly; all other chunks
    pass the normalizer and pre-tokenizer of the file.  Chunks are known by their 64-bit hash (some
    26 bytes each with their ids); beyond ``cap`` of them all are forgotten.
    """

    def __init__(self, path: str, cap: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import xxhash
        from tokenizers import Tokenizer

        self.hash = xxhash.xxh3_64_intdigest
        self.tokenizer = Tokenizer.from_file(path)
        # the special tokens of the file stand for themselves wherever a text holds them, before any
        # normalization; a chunk has no space, so one with a space in front names a special token
        found = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized}
        self.special = {f" {token}": k for token, k in found.items()}
        self.special_rx = re.compile("|".join(map(re.escape, sorted(found, key=len, reverse=True))) or r"(?!)")
        self.tokenizer.encode_special_tokens = True  # what only looks like one, lower-cased, is text
        self.model = self.tokenizer.model
        self.cap = cap
        self._forget()

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        """The worker's encoder of this file."""
        known = worker_state().setdefault("encoders", {})
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted
        self.row = np.zeros(0, np.int32)  # of each known chunk in what follows
        self.lens = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Append the ids of ``new`` chunks."""
        plain, plain_of, other, other_of, alone, alone_of = [], [], [], [], [], []
        for k, chunk in enumerate(new):
            if chunk[:1] == " ":
                alone.append(self.special[chunk])
                alone_of.append(k)
            elif m := PLAIN.fullmatch(chunk):
                plain.append(m[1])
                plain_of.append(k)
                if m[2]:
                    plain.append(m[2])
                    plain_of.append(k)
            else:
                other.append(chunk)
                other_of.append(k)
        letters = "\n".join(plain).lower().encode().decode("latin-1").translate({b: c for b, c in BYTE_ALPHABET.items() if b != 10})
        tokenize = self.model.tokenize
        found = [tokenize(w) for w in letters.split("\n")] if plain else []
        ids = [np.array(alone, self.ids.dtype), np.fromiter((t.id for w in found for t in w), self.ids.dtype)]
        of = [np.array(alone_of, np.int64), np.repeat(np.array(plain_of, np.int64), np.fromiter(map(len, found), np.int64, len(found)))]
        for lo in range(0, len(other), 20_000):
            got = self.tokenizer.encode(other[lo : lo + 20_000], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.asarray(got.ids, self.ids.dtype))
            words = np.fromiter((-1 if w is None else w for w in got.word_ids), np.int64, len(got))
            of.append(np.array(other_of, np.int64)[lo + words])
        of = np.concatenate(of)
        lens = np.bincount(of, minlength=len(new)).astype(np.int32)
        self.starts = np.concatenate([self.starts, np.cumsum(lens, dtype=np.int64) - lens + len(self.ids)])
        self.lens = np.concatenate([self.lens, lens])
        self.ids = np.concatenate([self.ids, np.concatenate(ids)[np.argsort(of, kind="stable")]])

    @staticmethod
    def _chunks(t: str) -> list[str]:
        if not EXOTIC.search(t):
            t = t.lower()  # as the normalizer would, and fewer chunks are distinct
        return t.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` one after the other, and the number of ids of each text."""
        if len(self.known) > self.cap:
            self._forget()
        chunks: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for k, t in enumerate(texts):
            at = 0
            for m in self.special_rx.finditer(t or ""):
                chunks += self._chunks(t[at : m.start()])
                chunks.append(f" {m[0]}")
                at = m.end()
            if t:
                chunks += self._chunks(t[at:] if at else t)
            ends[k + 1] = len(chunks)
        codes, names = pd.factorize(np.fromiter(map(self.hash, chunks), np.uint64, len(chunks)))
        order = np.argsort(names)
        names, rank = names[order], np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[codes]
        some = np.empty(len(names), np.int64)  # a place where each is found
        some[at] = np.arange(len(at))
        place = np.searchsorted(self.known, names)
        hit = np.zeros(len(names), bool)
        inside = place < len(self.known)
        hit[inside] = self.known[place[inside]] == names[inside]
        rows = np.empty(len(names), np.int64)
        rows[hit] = self.row[place[hit]]
        if not hit.all():
            new = ~hit
            rows[new] = np.arange(len(self.lens), len(self.lens) + int(new.sum()))
            self._learn([chunks[i] for i in some[new].tolist()])
            self.known = np.insert(self.known, place[new], names[new])
            self.row = np.insert(self.row, place[new], rows[new].astype(np.int32))
        rows = rows[at]
        lens = self.lens[rows].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(lens)])[ends]
        return self.ids[ragged(self.starts[rows], lens)].astype(np.uint32), np.diff(before)
