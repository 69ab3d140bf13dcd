"""Pieces of texts by vectorised hashing: cuts that no pre-token crosses, words, and a bounded table of encoded pieces.

The byte-level pattern's alternatives hold white space only in front or in runs of nothing else, so a cut
before a space that follows a character that is no white space never changes the pre-tokens.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

CUT = re.compile(r"(?<=\S)(?= )")
DEPTH = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
# a random number for each byte at each of the first places; the generator and its seed are fixed, so all tasks agree
TABLE = np.random.Generator(np.random.PCG64(20_240_607)).integers(0, 2**64, DEPTH * 256, np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit tabulation hashes of the byte runs ``data[start:end]``, which follow one another and are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    along = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    held = data if len(along) == len(data) else data[along + np.repeat(starts, lengths)]
    values = TABLE[((along & (DEPTH - 1)) << 8) | held]
    if int(lengths.max()) > DEPTH:
        # each later stretch of a long run has a multiplier of its own
        values *= (along >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = (np.add.reduceat(values, first) ^ lengths.astype(np.uint64)) * MIX
    return mixed ^ (mixed >> np.uint64(32))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of anything but space and U+0009 to U+000D in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    change = np.flatnonzero(inside[1:] != inside[:-1])
    return change[::2], change[1::2]


def _after_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place, not the first one, is white space of any kind."""
    last = data[at - 1]
    space = (last == 32) | ((last >= 9) & (last <= 13)) | ((last >= 0x1C) & (last <= 0x1F))
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        c, b, a = last[wide], data[at[wide] - 2], data[np.maximum(at[wide] - 3, 0)]
        two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
        three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
        three |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        space[wide] = two | three
    return space


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts that follow one another and begin at ``begins`` (only of texts that are not empty)."""
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    at = at[~_after_space(data, at)]
    starts = np.zeros(len(data), bool)
    starts[at] = True
    starts[begins] = True
    return np.flatnonzero(starts)


class PieceTable:
    """Token ids of pieces by hash, in arrays. It holds ``most`` pieces at most, then starts anew."""

    LONG = 200  # bytes; longer pieces are encoded each time
    WHOLE = 4_000_000  # bytes; a longer text is encoded piece by piece without the table

    def __init__(self, encode: Callable[[list[str]], Iterable[Sequence[int]]], most: int = 2_000_000) -> None:
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self, room: int = 0) -> None:
        """Forget all pieces; a single group may need more room than the table has otherwise."""
        slots = 1 << (2 * max(self.most, room) - 1).bit_length()
        self.keys, self.values = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self.offsets, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of known pieces, -1 for others."""
        mask = np.uint64(len(self.keys) - 1)
        found, left, slot = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), (hashes & mask).astype(np.int64)
        while len(left):
            held = self.keys[slot]
            hit = held == hashes[left]
            found[left[hit]] = self.values[slot[hit]]
            more = ~hit & (held != 0)
            left, slot = left[more], (slot[more] + 1) & int(mask)
        return found

    def _flat(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids one after the other, and the number of each one's."""
        found = list(self.encode(pieces))
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _insert(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        mask = len(self.keys) - 1
        numbers = np.arange(len(self.offsets), len(self.offsets) + len(hashes))
        self.offsets = np.append(self.offsets, len(self.pool) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.pool = np.append(self.pool, ids)
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            # of several that want one free slot the first gets it
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = hashes[left[first]], numbers[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], np.where(free[rest], slot[rest], (slot[rest] + 1) & mask)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and the number of each text's ids."""
        raw = [text.encode() for text in texts]
        if len(raw) == 1 and len(raw[0]) > self.WHOLE:
            return self._long(texts[0])
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        sizes = np.array([len(r) for r in raw], np.int64)
        begins = np.cumsum(sizes) - sizes
        starts = cuts(data, begins[sizes > 0])
        ends = np.append(starts[1:], len(data))
        hashes = run_hashes(data, starts, ends)
        hashes[hashes == 0] = 1
        brief = ends - starts <= self.LONG
        numbers = self._find(hashes)
        numbers[~brief] = -1
        fresh = np.flatnonzero((numbers < 0) & brief)
        new, first = np.unique(hashes[fresh], return_index=True)
        if len(self.offsets) + len(new) > self.most:
            fresh = np.flatnonzero(brief)
            new, first = np.unique(hashes[fresh], return_index=True)
            self._clear(len(new))
        places = fresh[first]
        self._insert(new, *self._flat([joined[starts[p] : ends[p]].decode() for p in places.tolist()]))
        numbers[brief] = self._find(hashes[brief])
        offsets, lengths, pool = self.offsets[numbers], self.lengths[numbers].astype(np.int64), self.pool
        single = np.flatnonzero(~brief)
        if len(single):
            extra, lengths[single] = self._flat([joined[starts[p] : ends[p]].decode() for p in single.tolist()])
            offsets[single] = len(pool) + np.cumsum(lengths[single]) - lengths[single]
            pool = np.append(pool, extra)
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = pool[np.arange(total) + np.repeat(offsets - before, lengths)]
        bounds = np.append(before, total)[np.searchsorted(starts, np.append(begins, len(data)))]
        return ids, np.diff(bounds)

    def _long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        parts, group, held = [], [], 0
        for piece in CUT.split(text):
            group.append(piece)
            held += len(piece)
            if held > self.WHOLE // 4:
                parts.append(self._flat(group)[0])
                group, held = [], 0
        parts.append(self._flat(group)[0])
        ids = np.concatenate([np.zeros(0, np.uint32), *parts])
        return ids, np.array([len(ids)])


def slices(column: pa.Array, most_rows: int = 500) -> Iterator[list]:
    """The values of a column, some rows at a time, so that a batch's texts are not all there twice."""
    for at in range(0, len(column), most_rows):
        yield column.slice(at, most_rows).to_pylist()


def release() -> None:
    """Give memory that is free in this worker back to the system, for the stages that come next."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def in_groups(texts: list[str | None], most_chars: int = 1_000_000) -> Iterator[list[str]]:
    """Consecutive texts (null as empty), in groups of about ``most_chars`` characters at most or of one text."""
    group: list[str] = []
    chars = 0
    for text in texts:
        text = text or ""
        if group and chars + len(text) > most_chars:
            yield group
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    if group:
        yield group
