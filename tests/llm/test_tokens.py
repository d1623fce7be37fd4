"""Encoding against the public tokenizer libraries, and packing against its rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from cardwatch.llm import bpe, packing
from cardwatch.llm.queries import op4_byte_bpe, op10_best_fit_packing
from cardwatch.llm.spans import chunks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, decoded string, part int, rank long, piece string"
ROWS = [
    (1, "It's they'll 'tis I'M don''t\n\n  x   y 12٣ 漢字 \U0001f600!! '", "a", "b", 1, 2, "c"),
    (2, None, None, None, None, None, None),
    (3, "", "", "", 0, 0, ""),
    (None, "\t \r\n", "x", "x", 0, 0, "x"),
    (1, "a" * 70_000 + " " * 9_000 + "b c " * 9_000, "x", "x", 0, 0, "x"),
    (1, "a" * 70_000 + " " * 9_000 + "b c " * 9_000, "x", "x", 0, 0, "x"),
    (9, "<|endoftext|> \x1c\x85 İ", "x", "x", 0, 0, "x"),
]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_random_texts_encode_as_the_library_does(reference):
    vocabulary, pick = bpe.Vocabulary(bpe.read_ranks(RANKS)), random.Random(5)
    signs = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "É", "1", "½", "!", " ", "　", "\x1c", "\x85"]
    signs += ["漢", "\U0001f600", "'ve", "I'm", "\r\n", "_", "​", "́", "Ⅷ", "the", " of", "tion"]
    texts = ["".join(pick.choices(signs, k=pick.randint(0, 30))) for _ in range(4000)]
    for chunk in chunks(pa.array(texts), 1 << 14):
        ids, ends = bpe.encode_chunk(chunk, vocabulary.resolve)
        assert bytes(vocabulary.decode(ids)[0]) == bytes(chunk.data[: chunk.size])
        for r in range(chunk.rows):
            assert ids[ends[r] : ends[r + 1]].tolist() == reference.encode_ordinary(texts[chunk.first + r])


def test_perfect_hash_finds_every_token_and_nothing_else():
    hashes = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    perfect = bpe.PerfectHash.build(hashes[:4000])
    assert len(perfect.ids) == 4000 and sorted(perfect.ids) == list(range(4000))
    assert perfect.find(hashes).tolist() == [*range(4000), *[-1] * 1000]


def test_encode_of_awkward_rows(spark, reference):
    got = bpe.encode(spark.createDataFrame(ROWS, SCHEMA), ranks=RANKS).collect()
    want = [(r[0], reference.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in ROWS]
    assert sorted(map(repr, ((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got))) == sorted(map(repr, want))
    assert bpe.encode(spark.createDataFrame([], SCHEMA), ranks=RANKS).count() == 0


def test_op4_digests(spark, small, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op4_byte_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def check_packing(rows, texts, tokenizer, capacity=2048):
    """Pieces rebuild the documents' ids, and sequences are gapless and within capacity."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        end = 0
        for n, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, end)
            assert r["length"] <= capacity and (n == 0 or r["length"] == capacity)
            assert r["ids_crc32"] == zlib.crc32(ids[end : end + r["length"]].tobytes())
            end += r["length"]
        assert end == len(ids) and len(own) == -(-len(ids) // capacity)
    return len(held)


def test_added_tokens_have_their_own_ids(tokenizer):
    encoder, pick = packing.WordEncoder(TOKENIZER), random.Random(7)
    signs = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", " world", "'s", "é", "<", "<|", "endoftext"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>", "", "<|endof", "text|>", ""]
    texts += ["".join(pick.choices(signs, k=pick.randint(0, 12))) for _ in range(600)]
    for size in (40, 1 << 14):
        for chunk in chunks(pa.array(texts), size):
            ids, ends = encoder.encode(chunk)
            for r in range(chunk.rows):
                assert ids[ends[r] : ends[r + 1]].tolist() == tokenizer.encode(texts[chunk.first + r], add_special_tokens=False).ids
    assert encoder.encode(next(chunks(pa.array(texts[:1]))))[0].tolist() == [31373, 220, 50256, 995]


def test_op10_pieces_and_sequences(spark, small, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op10_best_fit_packing(spark, small).collect()
    used = check_packing(rows, texts, tokenizer)
    assert used <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_of_awkward_rows(spark, tokenizer):
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(ROWS)], SCHEMA)
    packed = packing.pack_documents(docs, tokenizer=TOKENIZER, with_ids=True)
    check_packing(packed.collect(), {i: r[1] for i, r in enumerate(ROWS)}, tokenizer)
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in packed.collect())
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), tokenizer=TOKENIZER).count() == 0


def one_by_one(lengths, capacity):
    """Best-fit decreasing, one item at a time."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_runs_place_every_item_once(seed):
    pick = random.Random(seed)
    capacity = pick.choice([10, 30, 100])
    lengths = [pick.randint(1, pick.choice([capacity, capacity // 3, 4])) for _ in range(pick.choice([1, 7, 400]))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    bins, used, ranks = packing.pack_lengths(counts, capacity), {}, {}
    for length, rank, n, per, first, at in bins.runs:
        for k in range(n):
            used.setdefault(first + k // per, []).append((at + k % per * length, length))
            ranks.setdefault(length, []).append(rank + k)
    assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(n)) for x, n in counts.items()}
    for places in used.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in places) <= 2
    assert sorted(used) == list(range(bins.opened))
    assert bins.opened <= one_by_one(lengths, capacity) * 1.1 + 1
