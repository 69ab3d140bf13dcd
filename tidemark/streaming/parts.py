"""Envelopes that come in parts, as streams: parts wait in keyed state for what the rest of their batch says.

A batch of one part needs no state. The parts of a larger one meet under the batch's columns. State keeps an envelope as JSON text;
it is written and read back in the JVM, so events and contexts of any type keep their type.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.envelopes import batch_columns, filter_any, require_events, unpack_envelopes

EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
# early parts of a batch held in memory within a micro-batch; more go to the state at once
EARLY = 1000


class _Parts(StatefulProcessor):
    """What both handlers share: an event-time timer that closes a batch. Each call to the state is a round trip, so there are few."""

    def __init__(self, timed: bool):
        self.timed = timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.kind)

    def close_after(self, event_ms: int | None) -> None:
        if self.timed and event_ms is not None:
            timers = list(self.handle.listTimers())
            if not timers or event_ms > max(timers):
                for timer in timers:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(event_ms)

    def close(self) -> None:
        pass


class _Matching(_Parts):
    """Holds a batch's parts until one of them matches; then passes on all of them."""

    kind = "matched boolean, seen long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getMapState("seen", "part long", "times long")
        self.held = handle.getListState("held", "payload string")

    def note(self, part: int, known: int) -> int:
        """The number of distinct parts with this one; ``known`` without it."""
        if self.seen.containsKey((part,)):
            return known
        self.seen.updateValue((part,), (1,))
        return known + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        matched, seen = self.state.get() or (False, 0)
        latest, parts = None, None
        for row in rows:
            seen = self.note(row.part, seen)
            latest = row.event_ms if latest is None or row.event_ms > latest else latest
            parts = row.parts
            if row.hit and not matched:
                matched = True
                for (payload,) in self.held.get():
                    yield Row(payload=payload, before=0)
                self.held.clear()
            if matched:
                yield Row(payload=row.payload, before=0)
            else:
                self.held.appendValue((row.payload,))
        if not self.timed and seen >= parts:
            # complete; without event time nothing else would end the state
            self._forget()
        else:
            self.state.update((matched, seen))
            self.close_after(latest)

    def _forget(self) -> None:
        for state in (self.state, self.seen, self.held):
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._forget()
        return iter(())


class _Numbering(_Parts):
    """Passes a batch's parts on in order, each with the number of events in the earlier ones; parts that come early wait."""

    kind = "next_part long, before long, seen long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "part long", "payload string, n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.state.get()
        expected, before, seen = known or (0, 0, 0)
        # parts that wait in the state; all those before the expected one have been passed on
        waiting = stored = seen - expected
        early: dict[int, tuple[str, int]] = {}
        latest, parts = None, None
        for row in rows:
            part, parts = row.part, row.parts
            latest = row.event_ms if latest is None or row.event_ms > latest else latest
            if 0 <= part < expected or part in early or (waiting and self.waiting.containsKey((part,))):
                continue
            seen += 1
            if part == expected:
                yield Row(payload=row.payload, before=before)
                expected, before = expected + 1, before + row.n
            elif len(early) < EARLY:
                early[part] = (row.payload, row.n)
            else:
                self.waiting.updateValue((part,), (row.payload, row.n))
                waiting, stored = waiting + 1, stored + 1
            while expected in early or (waiting and self.waiting.containsKey((expected,))):
                if expected in early:
                    payload, n = early.pop(expected)
                else:
                    payload, n = self.waiting.getValue((expected,))
                    self.waiting.removeKey((expected,))
                    waiting -= 1
                yield Row(payload=payload, before=before)
                expected, before = expected + 1, before + n
        if not self.timed and seen >= parts:
            if known or stored:
                self._forget()
            return
        for part, (payload, n) in early.items():
            self.waiting.updateValue((part,), (payload, n))
        self.state.update((expected, before, seen))
        self.close_after(latest)

    def _forget(self) -> None:
        for state in (self.state, self.waiting):
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # parts behind a gap that has not been filled
        _, before, _ = self.state.get()
        for (part,) in sorted(self.waiting.keys()):
            payload, n = self.waiting.getValue((part,))
            yield Row(payload=payload, before=before)
            before += n
        self._forget()


def _through_state(
    envelopes: DataFrame, processor: type[_Parts], keys: list[str], measures: dict[str, Column], event_time: str | None, delay: str | None
) -> DataFrame:
    """The batches of several parts through ``processor``: the envelopes it passes on, and ``__before``."""
    if (event_time is None) != (delay is None):
        raise ValueError("event_time and delay go together")
    if event_time is None and "parts" not in envelopes.columns:
        raise ValueError("a batch ends with its last part or in event time: give a column parts, or event_time and delay")
    timed = envelopes if event_time is None else envelopes.withWatermark(event_time, delay)
    moment = F.lit(0).cast("long") if event_time is None else F.unix_millis(F.col(event_time).cast("timestamp"))
    parts = F.col("parts").cast("long") if "parts" in envelopes.columns else F.lit(None).cast("long")
    slim = timed.select(
        *[F.col(c).alias(f"__key_{i}") for i, c in enumerate(keys)],
        *([] if event_time is None else [F.col(event_time).alias("__event_time")]),
        F.col("part").cast("long").alias("part"),
        parts.alias("parts"),
        moment.alias("event_ms"),
        F.to_json(F.struct(*envelopes.columns), EXACT).alias("payload"),
        *[column.alias(name) for name, column in measures.items()],
    )
    passed = slim.groupBy(*[f"__key_{i}" for i in range(len(keys))]).transformWithState(
        statefulProcessor=processor(event_time is not None),
        outputStructType="payload string, before long",
        outputMode="Append",
        timeMode="None" if event_time is None else "EventTime",
    )
    back = F.from_json("payload", T.StructType([T.StructField(f.name, f.dataType) for f in envelopes.schema]), EXACT)
    return passed.select(back.alias("e"), "before").select("e.*", F.col("before").alias("__before"))


def _parts_of(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelopes of batches that are one part, and all others."""
    if "parts" not in envelopes.columns:
        return envelopes.where("false"), envelopes
    single = F.coalesce(F.col("parts") == 1, F.lit(False))
    return envelopes.where(single), envelopes.where(~single)


def filter_stream(
    envelopes: DataFrame,
    predicate: Callable[[Column], Column],
    batch_key: Sequence[str] | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """``filter_any`` on a stream: whole batches with at least one event that matches, whichever micro-batches their parts come in.

    Envelopes without ``part`` stand alone and need no state. Otherwise a part that does not match waits in the state of its batch (``batch_key``,
    as in ``filter_any``) until another one matches. A batch is closed, and its parts forgotten, once all of its ``parts`` have come or, with
    ``event_time`` and ``delay``, once the watermark has passed its newest part; then repeated parts of it still find its
    verdict until that time. Null ``events`` raise an error. The state of one batch is one task's.
    """
    if "part" not in envelopes.columns:
        return filter_any(envelopes, predicate)
    keys = batch_columns(envelopes, batch_key)
    envelopes = require_events(envelopes)
    hit = F.exists("events", lambda e: F.coalesce(predicate(e), F.lit(False)))
    alone, several = _parts_of(envelopes)
    passed = _through_state(several, _Matching, keys, {"hit": hit, "n": F.lit(0).cast("long")}, event_time, delay)
    return alone.where(hit).unionByName(passed.drop("__before"))


def unpack_stream(
    envelopes: DataFrame,
    wanted: Callable[[Column], Column] | None = None,
    batch_key: Sequence[str] | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """``unpack_envelopes`` on a stream: ``event_index`` goes on from part to part of a batch, in whatever order they come.

    A part waits until all earlier ones of its batch have come. A part that comes again is left out. A batch is closed as in
    :func:`filter_stream`; parts behind a gap that event time closes are numbered on without it.
    """
    if "part" not in envelopes.columns:
        return unpack_envelopes(envelopes, wanted)
    keys = batch_columns(envelopes, batch_key)
    envelopes = require_events(envelopes)
    if wanted is not None:
        envelopes = envelopes.withColumn("events", F.filter("events", lambda e: F.coalesce(wanted(e), F.lit(False))))
    alone, several = _parts_of(envelopes)
    passed = _through_state(several, _Numbering, keys, {"hit": F.lit(False), "n": F.size("events").cast("long")}, event_time, delay)
    both = alone.withColumn("__before", F.lit(0).cast("long")).unionByName(passed)
    kept = [c for c in envelopes.columns if c != "events"]
    exploded = both.select(*kept, "__before", F.posexplode("events").alias("__place", "event"))
    return exploded.select(*kept, (F.col("__before") + F.col("__place")).cast("int").alias("event_index"), "event")
