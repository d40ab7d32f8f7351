"""Operator 1: chat formatting with offset-aligned loss masks.

A conversation is rendered whole: every turn is ``<|turn|>role<|text|>text<|end|>``.  Inside roles
and texts a backslash goes behind the first character of every control string, and backslashes
are doubled, so the markers only ever stand for themselves and the texts come back unchanged.
The markers are special tokens; each rendered block is encoded once with offsets, and the sorted
spans of the assistant's texts are intersected with the sorted token spans by binary search.

Tokens never cross a marker, so a conversation may be rendered in blocks of whole turns: a range
sort by (conv_id, turn, ...) deals even a conversation with a third of all rows over many tasks,
and a block holds at most ``BLOCK_CHARS`` characters (or one turn).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regesto.llm import query
from regesto.llm.common import slices, table, tokenizer_file

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Strings that steer some chat template or tokenizer.
CONTROL = (TURN, TEXT, END, "<|startoftext|>", "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BLOCK_CHARS = 1 << 16
LEARNED_ROLES = ("assistant",)

_STARTS = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)


def escape(text: str | None) -> str:
    return _STARTS.sub(r"\1\\", (text or "").replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Inverse of ``escape``: a doubled backslash is one, a single one is nothing."""
    return re.sub(r"\\(\\?)", r"\1", text)


def turns_of(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, first character, end character of the escaped text) of each turn, read back."""
    out, at = [], 0
    while at < len(rendered):
        mid = rendered.index(TEXT, at)
        end = rendered.index(END, mid)
        body = mid + len(TEXT)
        out.append((unescape(rendered[at + len(TURN) : mid]), unescape(rendered[body:end]), body, end))
        at = end + len(END)
    return out


class ChatEncoder:
    """Token ids, offsets and loss spans of rendered blocks."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.add_special_tokens([AddedToken(m, normalized=False) for m in (TURN, TEXT, END)])

    def encode(self, blocks: list[str], spans: list[list[tuple[int, int]]]):
        """(ids, loss spans) per block; a loss span is (first token, end token, first char, end char)."""
        out = []
        for got, wanted in zip(self.tokenizer.encode_batch(blocks, add_special_tokens=False), spans):
            offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
            want = np.array(wanted, np.int64).reshape(-1, 2)
            first = np.searchsorted(offsets[:, 1], want[:, 0], "right")
            end = np.searchsorted(offsets[:, 0], want[:, 1], "left")
            end = np.maximum(first, end)
            loss = [
                (int(a), int(b), int(offsets[a, 0]), int(offsets[b - 1, 1])) if b > a else (int(a), int(a), int(c), int(c))
                for a, b, c in zip(first, end, want[:, 0])
            ]
            out.append((got.ids, loss))
        return out


FORMATTED = (
    "conv_id long, part int, block int, n_turns int, formatted string, token_ids array<int>, "
    "loss array<struct<first_token:int,end_token:int,first_char:int,end_char:int>>"
)


def format_chats(rows: DataFrame, vocabulary: str, learned: tuple[str, ...] = LEARNED_ROLES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Render and encode conversations (conv_id, turn, role, text); one row per block of turns.

    Turns go by ``turn`` (nulls first), equal ones by role, then text; repeated rows are turns of
    their own.  Null roles and texts count as empty; a null conv_id is one conversation.  Blocks of
    a conversation follow each other by (part, block).  An empty table gives no rows; other
    columns are ignored.
    """
    key = ["conv_id", "turn", "role", "text"]
    sorted_rows = rows.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), ChatEncoder(vocabulary)
        done: list[tuple[int | None, int, list[str]]] = []  # (conv_id, turns, parts) of finished blocks
        spans: list[list[tuple[int, int]]] = []
        block_no = held = 0
        conv: int | None = None
        size = n = 0  # of the block being built

        def flush() -> pa.RecordBatch:
            nonlocal block_no, held
            texts = ["".join(d[2]) for d in done]
            got = encoder.encode(texts, spans)
            batch = pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array([d[0] for d in done], pa.int64()),
                    "part": pa.array([part] * len(done), pa.int32()),
                    "block": pa.array(range(block_no, block_no + len(done)), pa.int32()),
                    "n_turns": pa.array([d[1] for d in done], pa.int32()),
                    "formatted": pa.array(texts, pa.string()),
                    "token_ids": pa.array([g[0] for g in got], pa.list_(pa.int32())),
                    "loss": pa.array(
                        [[dict(zip(("first_token", "end_token", "first_char", "end_char"), x)) for x in g[1]] for g in got],
                        pa.list_(pa.struct([(k, pa.int32()) for k in ("first_token", "end_token", "first_char", "end_char")])),
                    ),
                }
            )
            block_no += len(done)
            held = 0
            done.clear()
            spans.clear()
            return batch

        for batch in slices(batches, "text"):
            for cid, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                head, body = TURN + escape(role) + TEXT, escape(text)
                new = head + body + END
                if not n or cid != conv or size + len(new) > block_chars:
                    if held > 16 * block_chars:
                        yield flush()
                    done.append((cid, 0, []))
                    spans.append([])
                    conv, size, n = cid, 0, 0
                if (role or "") in learned:
                    spans[-1].append((size + len(head), size + len(head) + len(body)))
                n += 1
                size += len(new)
                held += len(new)
                done[-1] = (cid, n, done[-1][2])
                done[-1][2].append(new)
        if done:
            yield flush()

    return sorted_rows.mapInArrow(run, FORMATTED)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, n_loss_tokens long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row of digests per conversation, from the rendered blocks and their loss spans alone.

    The blocks of a conversation stream through one task in order, as a SHA-256 must; memory holds
    one block.
    """
    slim = formatted.select(
        "conv_id",
        "part",
        "block",
        "formatted",
        F.transform("loss", lambda x: F.struct(x["first_char"].alias("a"), x["end_char"].alias("b"))).alias("loss"),
        F.size("token_ids").alias("n_tokens"),
        F.aggregate("loss", F.lit(0), lambda acc, x: acc + x["end_token"] - x["first_token"]).alias("n_loss_tokens"),
    )
    streams = slim.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        state: list | None = None
        out: list[list] = []

        def closed() -> list:
            return [state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), *state[5:]]

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in slices(batches, "formatted"):
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        out.append(closed())
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                text = row["formatted"]
                for role, said, _, _ in turns_of(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for x in row["loss"]:
                    said = unescape(text[x["a"] : x["b"]])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
                state[6] += row["n_tokens"]
                state[7] += row["n_loss_tokens"]
            if len(out) >= 4096:
                yield batch_of(out)
                out = []
        if state is not None:
            out.append(closed())
            yield batch_of(out)

    return streams.mapInArrow(run, DIGESTS)


@query("op1_chat_format")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_chats(rows, tokenizer_file("byte_bpe_50k.json")))
