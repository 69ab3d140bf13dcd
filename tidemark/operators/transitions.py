"""What a run of ordered changes does to one key, as a function of the state it starts from.

A state is absent, or a version and an owner (the payload never decides anything). A change applies only where the version is
the one it expects, or the owner is, so a run distinguishes few states: versions near an expected one, owners that some
eviction expects, and all others alike. A :class:`Transition` is the table of where each of them ends. It is built backwards, change by
change: a check of version e makes row e equal to what follows from e + 1, an eviction of owner x makes column x equal to
what follows from the next version without owner. Runs of one key can thus be summarised in parallel and
followed one after the other, a look-up each.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np

CREATE, UPDATE, RENEW, TAKE, EVICT, REMOVE = "create", "update", "renew", "take", "evict", "delete"
CHECKS = (UPDATE, RENEW, TAKE)
PASS = -1  # the owner, or the payload, that the run started with
CELLS = 1_000_000
RUN = 20_000

# op, expected version, expected owner, new owner, and the order value that names the change
Change = tuple[str, int | None, Any, Any, Any]
# version, owner, and the name of the change whose payload it holds (None: the one it started with)
State = tuple[int, Any, Any]


def transitions(changes: Sequence[Change]) -> Iterator["Transition"]:
    """The changes of one key, none after a delete, as transitions of bounded size, to be followed in order."""
    evicted = {c[2] for c in changes if c[0] == EVICT}
    expected = {c[1] for c in changes if c[0] in CHECKS and c[1] is not None}
    reach = sum(c[0] == EVICT and c[2] is None for c in changes) + 2 if evicted else 1
    cells = (len(expected) * (reach + 1) + 3) * (len(evicted) + 2)
    if len(changes) > 1 and (len(changes) > RUN or cells > CELLS):
        middle = len(changes) // 2
        yield from transitions(changes[:middle])
        yield from transitions(changes[middle:])
    else:
        yield _built(changes, sorted(expected), list(evicted - {None}), reach)


@dataclass
class Transition:
    """``cells`` holds alive, version, owner and change for each row (version) and column (owner).

    The last row is any other version, where the version is what is added to it; the last but one column is no owner, the last one any other
    owner. ``absent`` is the end of a run that starts without a row.
    """

    versions: np.ndarray
    columns: dict[Any, int]
    owners: list
    changes: list
    cells: tuple[np.ndarray, ...]
    absent: tuple[bool, int, int, int]

    def follow(self, state: State | None) -> State | None:
        if state is None:
            alive, version, owner, change = self.absent
            return (version, self.owners[owner], self.changes[change]) if alive else None
        row = int(np.searchsorted(self.versions, state[0]))
        known = row < len(self.versions) and self.versions[row] == state[0]
        row = row if known else len(self.versions)
        column = self.columns.get(state[1], len(self.columns))
        alive, version, owner, change = (a[row, column] for a in self.cells)
        if not alive:
            return None
        return (
            int(version) + (0 if known else state[0]),
            state[1] if owner == PASS else self.owners[owner],
            state[2] if change == PASS else self.changes[change],
        )

    def packed(self) -> bytes:
        return zlib.compress(pickle.dumps(self, protocol=5), 1)

    @staticmethod
    def unpacked(data: bytes) -> "Transition":
        return pickle.loads(zlib.decompress(data))


def _built(changes: Sequence[Change], expected: list[int], evicted: list, reach: int) -> Transition:
    """The table of a short run. ``reach``: by how many versions evictions in a row can move on, and one more."""
    near = {e - k for e in expected for k in range(reach)} | {e + 1 for e in expected}
    if any(c[0] == CREATE for c in changes):
        near.add(0)
    versions = np.array(sorted(near), np.int64)
    columns = {owner: i for i, owner in enumerate([*evicted, None])}
    owners: dict[Any, int] = {}
    other, nobody, no_owner = len(versions), len(columns) - 1, owners.setdefault(None, 0)
    shape = (len(versions) + 1, len(columns) + 1)
    alive = np.ones(shape, bool)
    version = np.repeat(np.append(versions, 0)[:, None], shape[1], 1)
    owner = np.full(shape, PASS, np.int32)
    change = np.full(shape, PASS, np.int32)
    absent = (False, 0, PASS, PASS)
    row_of = {v: i for i, v in enumerate(versions.tolist())}
    # of each version the row of the next one
    following = np.array([row_of.get(v + 1, other) for v in versions.tolist()] + [other], np.int64)
    beyond = following[:-1] == other

    def ends(row: int, value: Any, name: int) -> tuple[bool, int, int, int]:
        """Where a run ends that goes on with this row's version, a known owner, and change ``name``'s payload (if any)."""
        column = columns.get(value, len(columns))
        by, payload = owner[row, column], change[row, column]
        code = owners.setdefault(value, len(owners)) if by == PASS else int(by)
        return bool(alive[row, column]), int(version[row, column]), code, name if payload == PASS else int(payload)

    for place in range(len(changes) - 1, -1, -1):
        op, wanted, who, new, _ = changes[place]
        if op in CHECKS and wanted is not None:
            row, after = row_of[wanted], row_of[wanted + 1]
            if op == TAKE:
                alive[row], version[row], owner[row], change[row] = ends(after, new, PASS)
            else:
                alive[row], version[row], owner[row] = alive[after], version[after], owner[after]
                change[row] = np.where(change[after] == PASS, place, change[after]) if op == UPDATE else change[after]
        elif op == EVICT:
            column = columns[who]
            moved = version[following, nobody]
            moved[:-1] += np.where(beyond, versions + 1, 0)
            moved[-1] += 1
            gone = owner[following, nobody]
            alive[:, column], change[:, column] = alive[following, nobody], change[following, nobody]
            owner[:, column] = np.where(gone == PASS, no_owner, gone)
            version[:, column] = moved
        elif op == CREATE:
            absent = ends(row_of[0], new, place)
        elif op == REMOVE:
            alive[:] = False
            absent = (False, 0, PASS, PASS)
        elif op not in CHECKS:
            raise ValueError(f"unknown operation {op}")
    used, places = np.unique(np.append(change, absent[3]), return_inverse=True)
    # the used changes only; PASS is the first of them and stays
    names = [changes[p][4] for p in used.tolist() if p != PASS]
    places = places - int(used[0] == PASS)
    change = places[:-1].reshape(shape).astype(np.int32)
    return Transition(versions, columns, list(owners), names, (alive, version, owner, change), (*absent[:3], int(places[-1])))
