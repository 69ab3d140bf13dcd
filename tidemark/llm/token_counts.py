"""Token counts by pre-token: each distinct pre-token is counted once, a join brings its count to the documents' frequencies.

Tasks cut whole texts into the tokenizer's own pre-tokens and write, flush by flush, the flush's distinct pre-tokens and, packed, how often
each of its documents holds them. Spark sorts the flushes' pre-tokens, so equal ones meet; the tokenizer's model counts the pieces
of each distinct one once, and the counts go back to the flushes in packed groups. A join on the flush brings
them to the frequencies, where they are summed per document. No sequence of token ids is ever made.

A flush names a pre-token once, so a pre-token that every document holds is no hot key: it has as many rows as there are flushes.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.chunks import CUT
from tidemark.plans.durable import cut_lineage

FLUSH_PAIRS = 1_000_000  # pairs of a document and a piece of text; a longer single text is a flush of its own
FLUSH_DOCS = 100_000
HELD_ANSWERS = 500_000

FLUSHES = "flush long, doc_ids array<long>, n_bytes array<long>, ends array<int>, places binary, times binary, pieces array<string>"
ANSWERS = "flush long, places binary, counts binary"


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32 by byte planes, compressed; high bytes hardly vary."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = np.frombuffer(pa.decompress(packed[4:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


class PreTokens:
    """A tokenizer file's pre-tokens and their counts of pieces.

    Strings of added tokens inside a text are tokens of their own, as the library takes them by default.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        added = parts["added_tokens"]
        kind = parts["pre_tokenizer"] or {}
        # what is cut at spaces below must not change under the file's other settings
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added)
        if kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"] or parts["normalizer"] or not plain:
            raise ValueError("pre-tokens are known for plain byte-level files only")
        tokenizer = Tokenizer.from_file(path)
        self.cut, self.model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model
        self.added = {t["content"] for t in added}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(longest_first)})") if longest_first else None

    def of(self, piece: str) -> list[str]:
        """Pre-tokens of a piece of text, in the byte-level alphabet; added tokens as they are."""
        if self.special is None or not self.special.search(piece):
            return [token for token, _ in self.cut(piece)]
        found = []
        for part in self.special.split(piece):
            found += [part] if part in self.added else [token for token, _ in self.cut(part)] if part else []
        return found

    def of_all(self, pieces: list[str], group: int = 1000) -> list[list[str]]:
        """:meth:`of` each of the pieces.

        Those that begin with a space and end with none are cut many at a time: no pre-token goes on from a character that is no
        white space into a space.
        """
        found: list[list[str]] = [[] for _ in pieces]
        joined = []
        for place, piece in enumerate(pieces):
            if piece[0] != " " or piece[-1].isspace() or (self.special is not None and self.special.search(piece)):
                found[place] = self.of(piece)
            else:
                joined.append(place)
        for at in range(0, len(joined), group):
            places = iter(joined[at : at + group])
            end, mine = 0, []
            for token, (start, _) in self.cut("".join([pieces[p] for p in joined[at : at + group]])):
                while start >= end:
                    place = next(places)
                    mine, end = found[place], end + len(pieces[place])
                mine.append(token)
        return found

    def count(self, token: str) -> int:
        """Number of a pre-token's pieces."""
        return 1 if token in self.added else len(self.model.tokenize(token))


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    """One instance per worker and file."""
    return PreTokens(path)


def _frequencies(path: str):
    """Documents to flushes of pre-token frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pre_tokens(path)
        flush = TaskContext.get().partitionId() << 32
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        ends: list[int] = []
        pieces: dict[str, int] = {}
        places: list[int] = []
        times: list[int] = []

        def written() -> pa.RecordBatch:
            """The flush's table by pieces as one by pre-tokens."""
            numbers: dict[str, int] = {}
            held = [[numbers.setdefault(token, len(numbers)) for token in group] for group in known.of_all(list(pieces))]
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            flat = np.fromiter((n for group in held for n in group), np.int64, int(lengths.sum()))
            first = np.cumsum(lengths) - lengths
            at, often = np.array(places, np.int64), np.array(times, np.int64)
            each = lengths[at]
            total = int(each.sum())
            begin = np.cumsum(each) - each
            token = flat[np.arange(total) + np.repeat(first[at] - begin, each)]
            doc = np.repeat(np.arange(len(doc_ids)), np.diff(np.append(0, np.append(begin, total)[ends])))
            # a document may hold a pre-token in several pieces
            width = max(len(numbers), 1)
            keys, inverse = np.unique(doc * width + token, return_inverse=True)
            sums = np.bincount(inverse, np.repeat(often, each), len(keys)).astype(np.int64)
            new_ends = np.searchsorted(keys, np.arange(1, len(doc_ids) + 1) * width)
            # each place as the step from the one before, modulo the number of pre-tokens
            steps = np.diff(np.append(0, keys % width)) % width
            arrays: list[pa.Array] = [pa.array([flush])]
            for values, kind in ((doc_ids, pa.int64()), (sizes, pa.int64()), (new_ends, pa.int32())):
                array = pa.array(values, kind)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array))
            arrays += [pa.array([_packed(steps)], pa.binary()), pa.array([_packed(sums)], pa.binary())]
            names = pa.array(list(numbers), pa.string())
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names))
            return pa.RecordBatch.from_arrays(arrays, ["flush", "doc_ids", "n_bytes", "ends", "places", "times", "pieces"])

        for batch in batches:
            for doc_id, text, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if text:
                    counted = Counter(CUT.split(text))
                    places += [pieces.setdefault(piece, len(pieces)) for piece in counted]
                    times += counted.values()
                doc_ids.append(doc_id)
                sizes.append(size)
                ends.append(len(places))
                if len(places) >= FLUSH_PAIRS or len(doc_ids) >= FLUSH_DOCS:
                    yield written()
                    flush += 1
                    for held in (doc_ids, sizes, ends, pieces, places, times):
                        held.clear()
        if doc_ids:
            yield written()

    return run


def _piece_counts(path: str):
    """Sorted rows of (piece, flush, place) to the flushes' counts; each distinct pre-token of the task is counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pre_tokens(path)
        last: tuple[str, int] | None = None
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def grouped() -> pa.RecordBatch:
            flush, place, n = (np.concatenate(a) for a in zip(*held, strict=True))
            order = np.lexsort((place, flush))
            flush, place, n = flush[order], place[order], n[order]
            first = np.flatnonzero(np.append(True, flush[1:] != flush[:-1]))
            bounds = list(zip(first.tolist(), np.append(first[1:], len(flush)).tolist(), strict=True))
            packed = [[_packed(values[lo:hi]) for lo, hi in bounds] for values in (place, n)]
            return pa.RecordBatch.from_arrays(
                [pa.array(flush[first]), *(pa.array(p, pa.binary()) for p in packed)], ["flush", "places", "counts"]
            )

        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            names = codes.dictionary.to_pylist()
            counts = []
            for name in names:
                if last is None or last[0] != name:
                    last = name, known.count(name)
                counts.append(last[1])
            n = np.array(counts, np.int64)[codes.indices.to_numpy()]
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), n))
            size += batch.num_rows
            if size >= HELD_ANSWERS:
                yield grouped()
                held, size = [], 0
        if held:
            yield grouped()

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flushes with their pre-tokens' counts to one row per document."""
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids, n_bytes, ends, answers = (batch.column(name)[row].values for name in ("doc_ids", "n_bytes", "ends", "answers"))
            parts = [] if answers is None else [(_unpacked(a["places"]), _unpacked(a["counts"])) for a in answers.to_pylist()]
            width = sum(len(place) for place, _ in parts)
            counts = np.zeros(max(width, 1), np.int64)
            for place, n in parts:
                counts[place] = n
            places = np.cumsum(_unpacked(batch.column("places")[row].as_py())) % max(width, 1)
            along = np.append(0, np.cumsum(counts[places] * _unpacked(batch.column("times")[row].as_py())))
            tokens = np.diff(np.append(0, along[ends.to_numpy()]))
            yield pa.RecordBatch.from_arrays([doc_ids, n_bytes, pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` names a byte-level tokenizers file. Counts are those of the library for the whole text without begin, end
    or other added tokens; strings of added tokens inside a text count as one token each. A null or empty text has 0
    bytes and 0 tokens. Every row has its own result: repeated rows, ties and rows with a null doc_id stay; an empty table gives an
    empty one; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    flushes = cut_lineage(chosen.mapInArrow(_frequencies(path), FLUSHES), "frequencies")
    asked = flushes.select(F.posexplode("pieces").alias("place", "piece"), "flush").select("piece", "flush", "place")
    answers = asked.repartition("piece").sortWithinPartitions("piece").mapInArrow(_piece_counts(path), ANSWERS)
    # a flush's answers are as many as its pre-tokens, which its pairs bound
    answers = answers.groupBy("flush").agg(F.collect_list(F.struct("places", "counts")).alias("answers"))
    both = flushes.drop("pieces").join(answers, "flush", "left").drop("flush")
    summed = both.mapInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")
    return summed.withColumn("over_limit", F.col("n_tokens") > limit)
