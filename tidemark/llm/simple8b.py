"""Token ids in a Simple-8b file format: 64-bit words that hold varying counts of ids, per-block offsets, escapes.

A file is a folder with two Parquet tables. ``segments`` has rows of whole documents, in ascending order of
(shard, segment): the documents' ids and lengths, the id stream as 64-bit little-endian words, the
word at which each block of ``BLOCK`` ids begins, and the escaped ids. ``shards`` has the number of ids before each shard.

A word's top four bits select how many ids of how many bits its other 60 bits hold, first id lowest. Selector 0 is the escape: the
payload is a place in the list of ids that need over 60 bits. Blocks begin on a word, so all blocks decode at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import PieceTable, in_groups

BLOCK = 2048
SEGMENT_IDS = 262_144

# Ids per word by selector; selector 0 escapes one id.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0], np.int64)
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], np.uint64)
ESCAPE = 0
# the widths of ids there are, and the least id too wide for each; 64 stands for an id that is escaped
ID_WIDTHS = np.append(np.unique(WIDTHS[1:15]), np.uint64(64)).astype(np.uint8)
TOO_WIDE = np.uint64(1) << np.unique(WIDTHS[1:15])

SEGMENTS = (
    "shard int, segment int, first_id long, n_ids long, doc_ids array<bigint>, n_tokens array<bigint>, "
    "block_offsets binary, words binary, escaped binary"
)


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each place of each block, a row of ``ids``, the selector of the word that would begin there."""
    widest = ID_WIDTHS[np.searchsorted(TOO_WIDE, ids, side="right")]
    chosen, span = np.zeros(ids.shape, np.uint8), 1
    for selector in range(14, 0, -1):
        while span < COUNTS[selector]:
            # two overlapping runs make a longer one; what a word holds past its block is padding and fits any width
            step = min(span, int(COUNTS[selector]) - span)
            widest = np.concatenate([np.maximum(widest[:, :-step], widest[:, step:]), widest[:, -step:]], axis=1)
            span += step
        np.copyto(chosen, selector, where=widest <= WIDTHS[selector].astype(np.uint8))
    return chosen


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block, and the escaped ids of unsigned 64-bit ``ids``."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    # a word may look past the last block
    padded = np.zeros(blocks * BLOCK + int(COUNTS.max()), np.uint64)
    padded[:n] = ids
    selectors = _selectors(padded[: blocks * BLOCK].reshape(blocks, BLOCK)).reshape(-1)
    # words of all blocks are found side by side
    starts = np.arange(blocks) * BLOCK
    at, end, begun = starts, np.minimum(starts + BLOCK, n), []
    while len(at):
        begun.append(at)
        at = at + COUNTS[selectors[at]]
        left = at < end
        if not left.all():
            at, end = at[left], end[left]
    begin = np.sort(np.concatenate([np.zeros(0, np.int64), *begun]))
    selector = selectors[begin]
    offsets = np.searchsorted(begin, starts).astype(np.uint32)
    words = selector.astype(np.uint64) << np.uint64(60)
    escaped = padded[begin[selector == ESCAPE]]
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[of] |= np.arange(len(of), dtype=np.uint64)
            continue
        along = np.arange(COUNTS[s])
        held = padded[begin[of, None] + along]
        room = BLOCK - begin[of] % BLOCK
        cut = np.flatnonzero(room < COUNTS[s])
        # ids of the next block are not this one's
        held[cut] *= along < room[cut, None]
        words[of] |= np.bitwise_or.reduce(held << (WIDTHS[s] * along.astype(np.uint64)), axis=1)
    return words, offsets, escaped


def decode_ids(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids that ``encode_ids`` packed."""
    out = np.zeros(n_ids, np.uint64)
    if not n_ids:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    counts = COUNTS[selector]
    before = np.cumsum(counts) - counts
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets.astype(np.int64), len(words))))
    begin = before - before[offsets.astype(np.int64)][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n_ids)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[begin[of]] = escaped[payload[of].astype(np.int64)]
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s]):
            place = begin[of] + k
            inside = place < end[of]
            out[place[inside]] = (payload[of[inside]] >> (WIDTHS[s] * np.uint64(k))) & mask
    return out


class _Encoders:
    """One tokenizer and piece table per file in a worker; they outlive tasks."""

    made: dict[str, PieceTable] = {}

    @classmethod
    def of(cls, file: str) -> PieceTable:
        if file not in cls.made:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(file)

            def encode(texts: list[str]) -> list[list[int]]:
                return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

            cls.made[file] = PieceTable(encode)
        return cls.made[file]


def _segment(shard: int, segment: int, first: int, doc_ids: list, lengths: list[int], ids: np.ndarray) -> dict:
    words, offsets, escaped = encode_ids(ids)
    return {
        "shard": shard,
        "segment": segment,
        "first_id": first,
        "n_ids": len(ids),
        "doc_ids": doc_ids,
        "n_tokens": lengths,
        "block_offsets": offsets.astype("<u4").tobytes(),
        "words": words.astype("<u8").tobytes(),
        "escaped": escaped.astype("<u8").tobytes(),
    }


SEGMENT_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("block_offsets", pa.binary()),
        ("words", pa.binary()),
        ("escaped", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None = None) -> None:
    """Encode ``text`` of every row with a tokenizers file and write the ids in ascending ``doc_id`` order to ``path``.

    Rows are dealt by ranges of doc_id, so a shard is a range and a segment a run of whole documents; a very long
    document is a segment of its own. A null or empty text has no id but ``end_id``. Null doc_ids come first;
    rows of one doc_id all stay, ordered by text. An empty table makes an empty file. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard = _Encoders.of(tokenizer_file), TaskContext.get().partitionId()
        tail = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        segment, first, held = 0, 0, 0
        doc_ids: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            nonlocal segment, first, held
            ids = np.concatenate(parts)
            made = _segment(shard, segment, first, list(doc_ids), list(lengths), ids)
            segment, first, held = segment + 1, first + len(ids), 0
            doc_ids.clear(), lengths.clear(), parts.clear()
            return pa.RecordBatch.from_pylist([made], SEGMENT_ARROW)

        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for group in in_groups(batch.column(1).to_pylist()):
                ids, sizes = table.encoded(group)
                ends = np.cumsum(sizes).tolist()
                for begin, end in zip([0, *ends], ends, strict=False):
                    parts += (ids[begin:end], tail)
                    lengths.append(end - begin + len(tail))
                    doc_ids.append(keys[at])
                    at += 1
                    held += lengths[-1]
                    if held >= SEGMENT_IDS:
                        yield row()
        if doc_ids:
            yield row()

    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
    )
    ordered.select("doc_id", "text").mapInArrow(encode, SEGMENTS).write.parquet(f"{path}/segments")
    # one row per written shard
    sizes = spark.read.schema(SEGMENTS).parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts.coalesce(1).write.parquet(f"{path}/shards")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The stored segments, each with the number of ids in the file before it as ``start``."""
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    shards = spark.read.schema("shard int, start long").parquet(f"{path}/shards")
    return segments.join(shards, "shard").withColumn("start", F.col("start") + F.col("first_id")).drop("first_id")


def _decoded(batch: pa.RecordBatch) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(start, doc ids, lengths, ids) of each segment."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        r = {name: batch.column(k)[i].as_py() for k, name in enumerate(names)}
        ids = decode_ids(
            np.frombuffer(r["words"], "<u8"),
            np.frombuffer(r["block_offsets"], "<u4"),
            np.frombuffer(r["escaped"], "<u8"),
            r["n_ids"],
        )
        yield r["start"], r["doc_ids"], np.array(r["n_tokens"], np.int64), ids


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file: ``doc_id``, ``start``, ``ids`` (in order)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, lengths, ids in _decoded(batch):
                ends = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(start + ends[:-1]),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64))),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return read_segments(spark, path).mapInArrow(decode, "doc_id long, start long, ids array<bigint>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of its ids, as read back."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, lengths, ids in _decoded(batch):
                ends = np.concatenate([[0], np.cumsum(lengths)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(start + ends[:-1]),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return read_segments(spark, path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
