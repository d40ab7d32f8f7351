"""Chat format, token counts, token files and packing."""

import collections
import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests_llm_brute import check_packing, edge_docs, edge_rows, no_docs, rows  # noqa: F401
from tokenizers import Tokenizer, models, pre_tokenizers

from regesto.llm import chat, packing, token_counts, token_files
from regesto.llm.common import ChunkEncoder, shared_path, table, tokenizer_file

SF = "/root/testdata/sf0.001"
WORD_BPE = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(WORD_BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


# -- chat


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    bits = ["<", "|", "\\", "[", "INST", "]", "/", "s", ">", "turn", "end", *chat.CONTROL, "é", "\n"]
    for _ in range(5000):
        text, role = ("".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) for _ in range(2))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROL)
        block = chat.TURN + chat.escape(role) + chat.TEXT + hidden + chat.END
        assert [x[:2] for x in chat.turns_of(block * 2)] == [(role, text)] * 2


def digests(conversations):
    by = collections.defaultdict(list)
    for c, turn, role, text in conversations:
        by[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("block_chars", [1, 300, 1 << 16])
def test_chat_edges(spark, block_chars):
    said = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, None, None),
        (2, 0, "assistant", None), (2, 1, "assistant", ""), (None, 0, "user", "x"), (None, None, "assistant", "y\\"), (3, 5, "tool<|end|>", "<|turn|>"),
        (4, 0, "assistant", "é漢🙂" * 20_000), (4, 0, "assistant", " lead and trail \n"), (4, 9, "system", "s"),
    ]
    df = spark.createDataFrame([(*x, 1, "f") for x in said], "conv_id long, turn long, role string, text string, part int, formatted string")
    got = chat.read_back(chat.format_chats(df, tokenizer_file("byte_bpe_50k.json"), block_chars=block_chars))
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r[0]: r[1:] for r in rows(got, *names)} == digests(said)


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(none, tokenizer_file("byte_bpe_50k.json"))).count() == 0


def test_op1_matches_brute_force(spark):
    said = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    x = "</s>[INST] ok [/INST]"
    want = digests([*said, (-1, 0, "user", x), (-1, 1, "assistant", x)])
    got = rows(chat.op1(spark, SF), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r[0]: r[1:] for r in got} == want and len(got) == len(want)


def test_loss_tokens_are_the_assistants_own():
    enc = chat.ChatEncoder(tokenizer_file("byte_bpe_50k.json"))
    block = chat.TURN + "user" + chat.TEXT + "hello there" + chat.END + chat.TURN + "assistant" + chat.TEXT + " well, é🙂 yes " + chat.END
    a = block.index(" well")
    (ids, loss), = enc.encode([block], [[(a, a + len(" well, é🙂 yes "))]])
    assert enc.tokenizer.decode(ids[loss[0][0] : loss[0][1]], skip_special_tokens=False) == " well, é🙂 yes "


# -- token counts


def unigram(pieces, unk, byte_fallback):
    t = Tokenizer(models.Unigram(pieces, unk, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(token_counts.MARK, "always", True)])
    return t


def test_counts_match_the_tokenizers_library(spark):
    pieces, whole = token_counts.read_pieces(tokenizer_file("piece_bpe_32k.model"))
    assert whole
    counter = token_counts.UnigramCounter(pieces, whole)
    known = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *pieces]
    model = unigram(known, 0, True)
    texts = [r["text"] for r in table(spark, SF, "documents").select("text").limit(60).collect()]
    texts += [x for x in ("a  b c\x1cd", "漢字🙂 ★", "", " ", "y" * 300) for _ in (0,)]
    for t in texts:
        assert counter.text(t)[0] == len(model.encode(t, add_special_tokens=False).ids), t[:80]


def test_counts_and_ties_on_random_vocabularies():
    rng = random.Random(7)
    for _ in range(60):
        names = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 14))}
        pieces = [(n, -float(rng.choice([1, 1, 2, 3]))) for n in sorted(names)]
        counter = token_counts.UnigramCounter(pieces, False)
        model = unigram([("<unk>", 0.0), *pieces], 0, False)
        for _ in range(20):
            t = " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 3)))
            assert counter.text(t)[0] == len(model.encode(t, add_special_tokens=False).ids), (pieces, t)


def test_token_count_edges(spark, edge_docs, no_docs):
    got = token_counts.count_tokens(edge_docs, tokenizer_file("piece_bpe_32k.model"))
    assert got.columns == [*edge_docs.columns, "n_tokens", "token_score"] and got.count() == edge_docs.count()
    by = {r["doc_id"]: r["n_tokens"] for r in got.where("doc_id in (2, 3, 4)").collect()}
    assert by == {2: 0, 3: 0, 4: 0}
    assert token_counts.count_tokens(no_docs, tokenizer_file("piece_bpe_32k.model")).count() == 0


# -- token files


def test_chunks_encode_like_whole_texts(plain):
    odd = ["İstanbul ǅ ﬁ it's <|endoftext|> x́y é e ́ ΑΣ ΣΑΣ. don't!! a,b 123 \x1c z q\xa0　 🙂 ñÑ, ß. ẞ", " ", "", None, "\n\n a\n", "ÀÉ. ŸŽ? ĳ", "<|startoftext|><|endoftext|>x<|ENDOFTEXT|> <|endoftext|", "A<|endoftext|>B <|endoftext|>", " <|endoftext|>\n"]
    odd += [r[1] for r in edge_rows()]
    enc = ChunkEncoder(WORD_BPE, cap=50)
    for _ in range(3):
        ids, n = enc.encode(odd)
        for text, got in zip(odd, np.split(ids, np.cumsum(n)[:-1])):
            assert got.tolist() == plain(text)


def file_rows(doc_rows, plain):
    import xxhash

    def tie(t):  # Spark's xxhash64: seed 42, signed; null gives the seed
        h = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42
        return h - (1 << 64) if h >> 63 else h

    out, start = [], 0
    for i, t in sorted(doc_rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]))):
        ids = [*plain(t), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_edges(spark, edge_docs, no_docs, plain):
    manifest = token_files.write_token_files(edge_docs, shared_path(spark, "t"), WORD_BPE)
    got = rows(token_files.read_token_files(manifest), "doc_id", "start", "n_tokens", "ids_crc32")
    want = file_rows([r[:2] for r in edge_rows()], plain)
    assert sorted(got, key=lambda r: r[1]) == want
    empty = token_files.write_token_files(no_docs, shared_path(spark, "t"), WORD_BPE)
    assert token_files.read_token_files(empty).count() == 0


def test_op7_matches_brute_force(spark, plain):
    docs = rows(table(spark, SF, "documents").select("doc_id", "text"))
    got = rows(token_files.op7(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(got, key=lambda r: r[1]) == file_rows(docs, plain)


def test_a_reader_decompresses_only_what_it_needs_and_checks_it():
    out = io.BytesIO()
    w = token_files.TokenFileWriter(out, frame_ids=100)
    docs = {k: np.arange(k * 37 % 260, dtype=np.uint32) + k for k in range(50)}
    for k, ids in docs.items():
        w.add(k, ids)
    w.add(49, np.array([5], np.uint32))  # a repeated doc_id
    w.close()
    raw = out.getvalue()
    reader = token_files.TokenFileReader(pa.BufferReader(raw))
    assert [x.tolist() for x in reader.read(20)] == [docs[20].tolist()]
    assert 0 < reader.frames_read <= 2 + len(docs[20]) // 100 < len(reader.seek)
    assert [len(x) for x in reader.read(49)] == [len(docs[49]), 1] and reader.read(99) == []
    # frames are plain zstandard
    import zstandard

    first = zstandard.ZstdDecompressor().decompress(raw[: int(reader.seek["compressed"][0])])
    assert len(first) == 400
    broken = bytearray(raw)
    broken[int(reader.frame_at[3]) - 1] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad = token_files.TokenFileReader(pa.BufferReader(bytes(broken)))
        [bad.read(k) for k in docs]


# -- packing


def gaps_of_best_fit(lengths, capacity):
    """Free places of the sequences, piece by piece: each into the smallest gap that holds it."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - n)
    return sorted(gaps)


def test_the_plan_leaves_the_gaps_of_best_fit_decreasing():
    rng = random.Random(8)
    cases = [([6, 5, 2, 2], 10)] + [([rng.randint(1, c) for _ in range(rng.randint(1, 80))], c) for c in [9, 10, 31, 64] * 100]
    for lengths, capacity in cases:
        used = collections.Counter()
        for n, a, b, first, _ in packing.plan_moves(dict(collections.Counter(lengths)), capacity):
            for r in range(b - a):
                used[first + r] += n
        assert sorted(capacity - u for u in used.values()) == gaps_of_best_fit(lengths, capacity)


def test_packing_edges(spark, edge_docs, no_docs, plain):
    got = rows(packing.pack_documents(edge_docs, WORD_BPE, 64), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    used, least = check_packing(got, [r[:2] for r in edge_rows()], plain, 64)
    assert used <= least + 3
    assert packing.pack_documents(no_docs, WORD_BPE).count() == 0


def test_op6_packs_tightly(spark, plain):
    got = rows(packing.op6(spark, SF), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    used, least = check_packing(got, rows(table(spark, SF, "documents").select("doc_id", "text")), plain, 2048)
    assert used <= 1.03 * least + 1


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_rounds_place_every_rank_once_and_pack_like_best_fit():
    rng = random.Random(0)
    for _ in range(150):
        capacity = rng.choice([5, 10, 31])
        counts = collections.Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 60)))
        spans, held = collections.defaultdict(list), collections.defaultdict(list)
        for n, a, b, first, offset in packing.plan_moves(dict(counts), capacity):
            spans[n].append((a, b))
            for r in range(a, b):
                held[first + r - a].append((offset, n))
        for n, c in counts.items():
            found = sorted(spans[n])
            assert found[0][0] == 0 and found[-1][1] == c and all(x[1] == y[0] for x, y in zip(found, found[1:]))
        assert len(held) <= best_fit(counts.elements(), capacity) + 1
        for parts in held.values():
            assert sum(n for _, n in parts) <= capacity
