"""Token file and byte-level BPE against the public libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, simple8b
from tidemark.plans.durable import work_folder

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = " \n\t\r\x0b\x1c\x85\xa0\u2003\u2029\u3000aAbé1٣'sS’lL!#中文😀"


@pytest.mark.parametrize("ids", [[], [0], [2**64 - 1, 0, 2**60, 2**60 - 1], [1] * 5000, [50_000, 1, 2, 3] * 3000, list(range(10_000))])
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, offsets, escaped = simple8b.encode_ids(ids)
    assert (simple8b.decode_ids(words, offsets, escaped, len(ids)) == ids).all()
    assert len(offsets) == -(-len(ids) // simple8b.BLOCK)



def test_words_hold_as_many_ids_as_fit():
    """Word by word against a plain greedy packing, block ends and escapes included; a segment is packed without a step per word."""
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2**63, 5000).astype(np.uint64) >> np.repeat(rng.integers(0, 64, 500), 10).astype(np.uint64)
    ids[100], ids[2047] = 2**61, 2**64 - 1
    words, offsets, escaped = simple8b.encode_ids(ids)
    plain, begun, place = [], [], 0
    while place < len(ids):
        if place % simple8b.BLOCK == 0:
            begun.append(len(plain))
        end = min(len(ids), (place // simple8b.BLOCK + 1) * simple8b.BLOCK)
        for selector in range(1, 16):
            held = ids[place : min(place + int(simple8b.COUNTS[selector]), end)] if selector < 15 else ids[place : place + 1]
            if selector == 15 or int(held.max()) < 1 << int(simple8b.WIDTHS[selector]):
                break
        plain.append((simple8b.ESCAPE if selector == 15 else selector, len(held)))
        place += len(held)
    assert [int(w) >> 60 for w in words] == [s for s, _ in plain] and offsets.tolist() == begun
    assert len(escaped) >= 2 and np.array_equal(simple8b.decode_ids(words, offsets, escaped, len(ids)), ids)

def test_small_ids_take_less_room():
    words, _, _ = simple8b.encode_ids(np.ones(2048, np.uint64))
    assert len(words) == 35


@pytest.mark.parametrize("table", ["docs", "sample", "no_docs"])
def test_token_file(spark, request, table):
    docs = request.getfixturevalue(table)
    path = work_folder(spark, "tokens")
    simple8b.write_tokens(docs, path, JSON, 2)
    found = sorted(tuple(r) for r in simple8b.token_digests(spark, path).collect() if r.doc_id is not None)
    tokenizer = Tokenizer.from_file(JSON)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        if doc_id is not None:
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == want
    read = {(r.doc_id, r.start): r.ids for r in simple8b.read_tokens(spark, path).collect()}
    assert all(len(read[d, s]) == n for d, s, n, _ in found)


def test_special_token_in_texts(spark):
    """Ids, lengths and starts are those of the library's call with add_special_tokens=False, which knows the token inside a text."""
    end = "<|endoftext|>"
    texts = [f"one{end}two", f"one {end} two", f"{end} one", f"one {end}", end, f"{end}{end}", f"a  {end}\n  b {end}  c", f"<|endoftext {end[1:]}", f"{'x' * 300}{end}{'y' * 300}", "plain"]
    path = work_folder(spark, "tokens")
    simple8b.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, JSON, 2)
    found = {r.doc_id: (r.start, list(r.ids)) for r in simple8b.read_tokens(spark, path).collect()}
    tokenizer, start = Tokenizer.from_file(JSON), 0
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert found[doc_id] == (start, ids)
        start += len(ids)


def _encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("table", ["docs", "sample", "no_docs"])
def test_bpe_documents(request, table):
    docs = request.getfixturevalue(table)
    _, encoding = _encoding()
    pattern = public_tokenizers.PATTERN
    found = bpe.digests(bpe.decode_documents(bpe.encode_documents(docs, RANKS, pattern), RANKS, pattern)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r.text or "").encode())))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_bpe_random_texts_and_small_table():
    ranks, encoding = _encoding()
    coder = bpe.byte_pairs(RANKS, public_tokenizers.PATTERN)
    coder.table.most = 500
    draw = random.Random(3)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(40))) for _ in range(4000)] + ["", "a" * 3000, " " * 300, "x" * 300 + " y"]
    found = []
    for ids, sizes in coder.encode(texts):
        ends = np.cumsum(sizes)
        found += [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)]
    assert found == [encoding.encode_ordinary(t) for t in texts]


def test_perfect_hash_is_minimal():
    ranks, _ = _encoding()
    keys = list(ranks)[:5000]
    table = bpe.PerfectHash(keys)
    assert sorted(table.lookup(keys)) == list(range(5000))
    assert table.lookup([b"no such key at all", b"\xff\xfe\xfd\xfc\xfb"]) == [-1, -1]
