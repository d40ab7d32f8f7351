"""Operator 7: token ids in binary files of independent zstandard frames.

A file is a run of zstandard frames, each with at most ``FRAME_IDS`` little-endian unsigned 32-bit
ids, then a skippable frame with the documents' index (doc_id, first id, number of ids), then a
skippable frame with the seek table (compressed size, decompressed size and checksum per frame)
and a fixed footer.  A reader takes the footer, the seek table and the index, finds the frames
that hold the documents it wants, and decompresses only those.

Every file is written under a name of its task attempt and then renamed: a repeated or
speculative task leaves the same file again.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import ChunkEncoder, materialise, shared_path, slices, table, tokenizer_file

FRAME_IDS = 1 << 16
END_ID = 2
LEVEL = 1

# The magic numbers of zstandard's skippable frames and of its seekable format.
SKIPPABLE = 0x184D2A50
SEEK_SKIPPABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

NO_ID = -(1 << 63)  # stands for a null doc_id in the index
INDEX = np.dtype([("doc_id", "<i8"), ("start", "<u8"), ("n", "<u8")])
SEEK = np.dtype([("compressed", "<u4"), ("decompressed", "<u4"), ("checksum", "<u4")])
FOOTER = "<IBI"


def open_fs(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that all tasks see, and the folder's path there."""
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


class TokenFileWriter:
    """Appends documents to a stream; holds one frame's ids and the index (24 bytes a document)."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        import xxhash
        import zstandard

        self.out, self.frame_ids = out, frame_ids
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.checksum = lambda raw: xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.index: list[tuple[int, int, int]] = []
        self.seek: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((NO_ID if doc_id is None else doc_id, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        while len(ids):
            part, ids = np.split(ids, [self.frame_ids - self.n_held])
            self.held.append(part)
            self.n_held += len(part)
            if self.n_held == self.frame_ids:
                self._frame()

    def _frame(self) -> None:
        if self.n_held:
            raw = np.concatenate(self.held).astype("<u4").tobytes()
            packed = self.compress(raw)
            self.out.write(packed)
            self.seek.append((len(packed), len(raw), self.checksum(raw)))
            self.held, self.n_held = [], 0

    def close(self) -> None:
        self._frame()
        index = np.array(self.index, INDEX).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        seek = np.array(self.seek, SEEK).tobytes() + struct.pack(FOOTER, len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_SKIPPABLE, len(seek)) + seek)


class TokenFileReader:
    """Reads documents of one file by their place in its index; checks each frame it touches."""

    def __init__(self, source):
        import xxhash
        import zstandard

        self.source, self.decompress = source, zstandard.ZstdDecompressor().decompress
        self.checksum = lambda raw: xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF
        size = source.size()
        n, flag, magic = struct.unpack(FOOTER, self._at(size - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the token file")
        table_at = size - struct.calcsize(FOOTER) - n * SEEK.itemsize
        self.seek = np.frombuffer(self._at(table_at, n * SEEK.itemsize), SEEK)
        self.frame_at = np.concatenate([[0], np.cumsum(self.seek["compressed"], dtype=np.int64)])
        self.first_id = np.concatenate([[0], np.cumsum(self.seek["decompressed"], dtype=np.int64) // 4])
        index_at = int(self.frame_at[-1])
        _, length = struct.unpack("<II", self._at(index_at, 8))
        self.index = np.frombuffer(self._at(index_at + 8, length), INDEX)
        self.frames_read = 0
        self._kept: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def _ids_of(self, frame: int) -> np.ndarray:
        if self._kept[0] != frame:
            packed = self._at(int(self.frame_at[frame]), int(self.seek["compressed"][frame]))
            raw = self.decompress(packed, max_output_size=int(self.seek["decompressed"][frame]))
            if self.checksum(raw) != self.seek["checksum"][frame]:
                raise ValueError(f"frame {frame} does not match its checksum")
            self.frames_read += 1
            self._kept = (frame, np.frombuffer(raw, "<u4"))
        return self._kept[1]

    def parts(self, row: int) -> Iterator[np.ndarray]:
        """The ids of the document in ``row`` of the index, a frame's share at a time."""
        lo = int(self.index["start"][row])
        hi = lo + int(self.index["n"][row])
        while lo < hi:
            k = int(np.searchsorted(self.first_id, lo, "right")) - 1
            end = min(hi, int(self.first_id[k + 1]))
            yield self._ids_of(k)[lo - int(self.first_id[k]) : end - int(self.first_id[k])]
            lo = end

    def find(self, doc_id: int | None) -> range:
        """The rows of a document's index entries (several when a doc_id is repeated)."""
        ids = self.index["doc_id"]
        key = NO_ID if doc_id is None else doc_id
        return range(int(np.searchsorted(ids, key)), int(np.searchsorted(ids, key, "right")))

    def read(self, doc_id: int | None) -> list[np.ndarray]:
        return [np.concatenate([np.zeros(0, "<u4"), *self.parts(r)]) for r in self.find(doc_id)]


MANIFEST = "file_no long, path string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into token files below ``folder``; return their manifest.

    Files follow each other in ascending doc_id order (nulls first; repeated ids by a hash of the text), one
    file per range partition.  Null text counts as empty: such a document holds its end id only.
    An empty table gives no files.  Other columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()
        encoder, writer, out = ChunkEncoder.of(vocabulary), None, None
        fs, base = open_fs(folder)
        tmp, final = f"{base}/.part-{part:06d}-{attempt}", f"{base}/part-{part:06d}.tok"
        end = np.array([end_id], np.uint32)
        for batch in slices(batches, "text"):
            if writer is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(tmp)
                writer = TokenFileWriter(out)
            ids, counts = encoder.encode(batch.column("text").to_pylist())
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), np.split(ids, np.cumsum(counts)[:-1])):
                writer.add(doc_id, np.concatenate([one, end]))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(tmp, final)
            yield pa.RecordBatch.from_pydict(
                {"file_no": [part], "path": [f"{folder}/part-{part:06d}.tok"], "n_docs": [len(writer.index)], "n_ids": [writer.n_ids]}
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return materialise(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files in ``manifest``.

    ``start`` counts the ids of all documents before it, over all files.
    """
    n = manifest.count()  # one row a file
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, _ = open_fs(os.path.dirname(row["path"]))
                with fs.open_input_file(open_fs(row["path"])[1]) as source:
                    reader = TokenFileReader(source)
                    crc = np.zeros(len(reader.index), np.int64)
                    for k in range(len(crc)):
                        c = 0
                        for part in reader.parts(k):
                            c = zlib.crc32(part.tobytes(), c)
                        crc[k] = c
                    ids = reader.index["doc_id"]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(ids, mask=ids == NO_ID),
                            "start": pa.array(reader.index["start"].astype(np.int64) + row["base"]),
                            "n_tokens": pa.array(reader.index["n"].astype(np.int64)),
                            "ids_crc32": pa.array(crc),
                        }
                    )

    return files.repartitionByRange(max(1, n), "file_no").mapInArrow(read, schema)


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-files")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_file("word_bpe_49k.json")))
