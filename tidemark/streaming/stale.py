"""Keys that have stopped changing, found as the stream goes on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.state import MAX_AGE_DAYS


class _Quiet(StatefulProcessor):
    """Keeps a key's last version and change time, and whether its quiet was reported.

    A quiet period is over the limit once a later row of the key, or the watermark through
    a timer, is past it; so the reports do not depend on how rows fall into batches.
    """

    def __init__(self, duration_us: int, key_name: str):
        self.duration_us, self.key_name = duration_us, key_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = T.StructType(
            [
                T.StructField("version", T.LongType()),
                T.StructField("changed_us", T.LongType()),
                T.StructField("reported", T.BooleanType()),
            ]
        )
        self.state = handle.getValueState("seen", kind)

    def _reports(self, key, changes: list[int | None]) -> pd.DataFrame:
        return pd.DataFrame({self.key_name: [key[0]] * len(changes), "changed_us": pd.array(changes, dtype="Int64")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.state.exists()
        version, changed, reported = self.state.get() if known else (None, None, False)
        reports: list[int | None] = []
        # a key's share of one micro-batch; the trigger's size limit bounds it
        for row in pd.concat(list(rows), ignore_index=True).sort_values("seen_us", kind="stable").itertuples():
            if changed is not None and not reported and row.seen_us > changed + self.duration_us:
                reports.append(changed)
                reported = True
            if not known and row.owner is None:
                known, version, changed, reported = True, row.version, None, True
                reports.append(None)
            elif not known or row.version != version:
                known, version, changed, reported = True, row.version, int(row.seen_us), False
        if reports:
            yield self._reports(key, reports)
        self.state.update((int(version), changed, reported))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if changed is not None and not reported:
            # timers are in milliseconds; rounded up, so none is early
            self.handle.registerTimer(-(-(changed + self.duration_us) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        version, changed, reported = self.state.get()
        if changed is not None and not reported:
            self.state.update((version, changed, True))
            yield self._reports(key, [changed])

    def close(self) -> None:
        pass


def stream_stale_keys(
    scans: DataFrame,
    duration: dt.timedelta,
    delay: str,
    key: str = "key",
    scan_ts: str = "scan_ts",
) -> DataFrame:
    """Each key once per quiet period: when its version has not changed for longer than ``duration``.

    ``scans``: key, scan_ts, owner, version. Time is event time with the watermark ``delay``: rows that come
    later than that after the newest one are left out, so it must be as long as rows can be late. A
    key first seen unowned is reported at once with a null ``last_change``. No period is longer than a year.
    """
    schema = T.StructType([scans.schema[key], T.StructField("changed_us", T.LongType())])
    timed = scans.select(
        key, F.col(scan_ts).cast("timestamp").alias("event_time"), "owner", F.col("version").cast("long").alias("version")
    )
    seen = timed.withColumn("seen_us", F.unix_micros("event_time"))
    # beyond a year a key is stale whatever the duration
    limit = min(duration, dt.timedelta(days=MAX_AGE_DAYS))
    quiet = (
        seen.withWatermark("event_time", delay)
        .groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=_Quiet(limit // dt.timedelta(microseconds=1), key),
            outputStructType=schema,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return quiet.select(key, F.timestamp_micros("changed_us").alias("last_change"))
