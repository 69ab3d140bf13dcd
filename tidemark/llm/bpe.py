"""Byte-level BPE by a rank file, in two tiers, and back.

Tier one: a minimal perfect hash finds whole pre-tokens of the vocabulary, many at a time. Tier two: a pre-token that is
not in it is merged over a linked list of its bytes, the pair to merge next taken from a heap by rank, leftmost first.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import PieceTable, in_groups


class PerfectHash:
    """Minimal perfect hash of byte strings: levels of occupied slots; a key that shares its slot goes one level down.

    A key's number is the count of occupied slots before its own, so n keys have the numbers 0 to n - 1.
    """

    SLOTS_PER_KEY = 2

    def __init__(self, keys: list[bytes]) -> None:
        left = np.array([xxhash.xxh3_64_intdigest(key) for key in keys], np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys must differ")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        while len(left):
            slots = self.slots(left, len(self.levels), self.SLOTS_PER_KEY * len(left))
            used = np.bincount(slots, minlength=self.SLOTS_PER_KEY * len(left))
            alone = used == 1
            self.levels.append((alone, taken + np.cumsum(alone) - alone))
            taken += int(alone.sum())
            left = left[~alone[slots]]
        self.keys: list[bytes] = [b""] * len(keys)
        for key, number in zip(keys, self.numbers(keys).tolist(), strict=True):
            self.keys[number] = key

    @staticmethod
    def slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = (hashes ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        return (mixed % np.uint64(size)).astype(np.int64)

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        """Numbers of keys; a string that is no key gets any number or -1."""
        hashes = np.array([xxhash.xxh3_64_intdigest(key) for key in keys], np.uint64)
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, before) in enumerate(self.levels):
            if not len(left):
                break
            slots = self.slots(hashes[left], level, len(alone))
            hit = alone[slots]
            found[left[hit]] = before[slots[hit]]
            left = left[~hit]
        return found

    def lookup(self, keys: list[bytes]) -> list[int]:
        """Numbers of keys, -1 for a string that is no key."""
        mine = self.keys
        return [n if n >= 0 and mine[n] == key else -1 for key, n in zip(keys, self.numbers(keys).tolist(), strict=True)]


class BytePairs:
    """Encoder and decoder of one rank file."""

    def __init__(self, file: str, pattern: str) -> None:
        with open(file, "rb") as lines:
            self.ranks = {base64.b64decode(key): int(rank) for key, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.hash = PerfectHash(list(self.ranks))
        self.ids = [self.ranks[key] for key in self.hash.keys]
        self.bytes_of = {rank: key for key, rank in self.ranks.items()}
        self.table = PieceTable(self._encode)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        found = [[token.encode() for token in self.pattern.findall(text)] for text in texts]
        distinct = list({token for tokens in found for token in tokens})
        ids = {
            token: [self.ids[number]] if number >= 0 else self.merge(token)
            for token, number in zip(distinct, self.hash.lookup(distinct), strict=True)
        }
        return [[i for token in tokens for i in ids[token]] for tokens in found]

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token: of all adjacent parts whose bytes together have a rank, join those of the lowest, leftmost first."""
        ranks, n = self.ranks, len(word)
        # a part is named by its first byte; end[i] is 0 once part i has been joined to the one before it
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := word[i : i + 2]) in ranks]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (rank := ranks.get(word[i : end[stop]])) is not None:
                    heappush(heap, (rank, i, end[stop]))
            if (left := before[i]) >= 0 and (rank := ranks.get(word[left:stop])) is not None:
                heappush(heap, (rank, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each group of texts their ids one after the other and the number of each text's ids."""
        for group in in_groups(texts):
            yield self.table.encoded(group)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_MADE: dict[tuple[str, str], BytePairs] = {}


def byte_pairs(file: str, pattern: str) -> BytePairs:
    """A worker's coder of a rank file; it outlives tasks."""
    if (file, pattern) not in _MADE:
        _MADE[file, pattern] = BytePairs(file, pattern)
    return _MADE[file, pattern]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` its ``doc_id`` and ``ids``: little-endian unsigned 32-bit integers, packed.

    A null or empty text has no ids; rows, repeated ones and those with a null doc_id too, all stay. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(rank_file, pattern)
        for batch in batches:
            keys, at = batch.column(0), 0
            for ids, sizes in coder.encode(batch.column(1).to_pylist()):
                ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
                buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())]
                packed = pa.Array.from_buffers(pa.binary(), len(sizes), buffers)
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(sizes)), packed], ["doc_id", "ids"])
                at += len(sizes)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Rows of ``encode_documents`` with ``decoded``, the bytes that their ids stand for (null ids: none)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                decoded = pa.array([coder.decode(ids or b"") for ids in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame, with_ids: bool = False) -> DataFrame:
    """``n_tokens`` and the SHA-256 of ids and decoded bytes, per document; with the ids themselves if wanted."""
    return decoded.select(
        "doc_id",
        *(["ids"] if with_ids else []),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
