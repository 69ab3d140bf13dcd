import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delivery as d
from tidemark.operators import monitor as m
from tidemark.plans.hot_ranges import RANGE, find_hot_ranges

T0 = dt.datetime(2024, 1, 1)
EVENTS = "stream_id long, namespace string, ts timestamp_ntz, event_id long"
SUBS = "consumer string, stream_id long, namespace string, start_ts timestamp_ntz, stop_ts timestamp_ntz"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def test_deliver_edges(spark, rows):
    events = spark.createDataFrame([(1, "n", at(i), i) for i in range(6)] + [(2, "n", at(1), 9), (1, "m", at(1), 8)], EVENTS)
    subs = spark.createDataFrame(
        [("a", 1, "n", at(1), at(3)), ("a", 1, "n", at(2), None), ("b", 2, "n", at(2), None), ("c", 1, "n", at(4), at(2))], SUBS
    )
    keys = ("stream_id", "namespace")
    got = rows(d.deliver(events, subs, keys), "consumer", "event_id")
    assert got == [("a", 1), ("a", 2), ("a", 2), ("a", 3), ("a", 4), ("a", 5)]
    assert rows(d.consumed_count(events, subs, keys)) == [("a", 6), ("b", 0), ("c", 0)]


@pytest.mark.parametrize("rows_per_range", [None, 40])
def test_consumed_count_equals_counted_deliveries(spark, rows, rows_per_range):
    rng = random.Random(3)
    events = spark.createDataFrame([(rng.choice([1, 1, 2, 3]), "n", at(rng.randrange(50)), i) for i in range(500)], EVENTS)
    subs = spark.createDataFrame(
        [
            (f"c{rng.randrange(6)}", rng.randrange(1, 5), "n", at(rng.randrange(50)), at(rng.choice([None, rng.randrange(60)])))
            for _ in range(60)
        ],
        SUBS,
    )
    counted = dict(rows(d.consumed_count(events, subs, rows_per_range=rows_per_range)))
    naive = dict(rows(d.deliver(events, subs).groupBy("consumer").count()))
    assert counted == {r[0]: naive.get(r[0], 0) for r in subs.select("consumer").distinct().collect()}


def test_deliver_of_a_hot_stream_in_ranges(spark, rows):
    rng = random.Random(11)
    events = spark.createDataFrame([(rng.choice([1, 1, 1, 2]), "n", at(rng.choice([rng.randrange(90), 5])), i) for i in range(600)] + [(1, "n", None, 600)], EVENTS)
    data = [(f"c{k}", rng.randrange(1, 4), "n", at(rng.randrange(90)), at(rng.choice([None, rng.randrange(95)]))) for k in range(80)]
    subs = spark.createDataFrame([*data, ("all", 1, "n", at(-5), None), ("never", 1, "n", None, None)], SUBS)
    whole = rows(d.deliver(events, subs, rows_per_range=math.inf), "consumer", "event_id")
    cut = d.deliver(events, subs, rows_per_range=40)
    assert rows(cut, "consumer", "event_id") == whole and len(whole) > 1000
    assert cut.columns == ["consumer", *events.columns]
    # the share of a hot stream that one task sees
    tagged = find_hot_ranges(events, ["stream_id"], ["ts"], 40).tag(events).groupBy("stream_id", RANGE).count()
    distinct = tagged.where("stream_id = 1").count()
    assert distinct >= 5


@pytest.mark.parametrize("rows_per_range", [None, 2])
def test_counter(spark, rows, rows_per_range):
    kinds = ["produce", "produce", "clear", "produce"]
    events = spark.createDataFrame([(1, i, k) for i, k in enumerate(kinds)] + [(2, 0, "produce")], "key long, at long, kind string")
    reset = F.col("kind") == "clear"
    got = d.reset_counter(events, "key", "at", reset, rows_per_range).where("key = 1").orderBy("at").collect()
    assert [r["emitted"] for r in got] == [0, 1, None, 0]
    assert [r["counter"] for r in got] == [1, 2, 0, 1]
    assert rows(d.produced_count(events, "key", "at", reset, rows_per_range)) == [(1, 1), (2, 1)]


def test_produced_count_after_a_final_reset(spark, rows):
    events = spark.createDataFrame([(1, 0, False), (1, 1, True), (2, 0, None)], "key long, at long, reset boolean")
    assert rows(d.produced_count(events, "key", "at", F.col("reset"))) == [(1, 0), (2, 1)]


def test_reconcile(spark, rows):
    pending = spark.createDataFrame([(0, t) for t in range(1, 6)] + [(1, 1), (1, 2)], "queue_id long, token long")
    delivered = spark.createDataFrame([(0, 3), (0, 1), (0, 3)], "queue_id long, token long")
    got = rows(d.reconcile_acks(pending, delivered))
    assert got == [(0, 1, "acked"), (0, 2, "redeliver"), (0, 3, "acked"), (0, 4, "pending"), (0, 5, "pending"), (1, 1, "pending"), (1, 2, "pending")]


def test_slow_operations(spark, rows):
    log = spark.createDataFrame([(1, 3000.0), (2, 3001.0), (3, 2.0)], "op_id long, duration_ms double")
    assert rows(m.slow_operations(log), "op_id") == [(2,)]
    timed = spark.createDataFrame([(1, at(0), at(1)), (2, at(0), T0 + dt.timedelta(milliseconds=3000))], "op_id long, started timestamp_ntz, ended timestamp_ntz")
    assert rows(m.slow_operations(m.with_duration(timed)), "op_id") == [(1,)]


@pytest.mark.parametrize("rows_per_range", [None, 3])
def test_failure_streaks(spark, rows_per_range):
    data = [(1, i, True) for i in range(6)] + [(1, 6, False), (1, 7, True)]
    events = spark.createDataFrame(data, "key long, at long, bad boolean")
    got = m.failure_streaks(events, "key", "at", F.col("bad"), rows_per_range=rows_per_range).orderBy("at").collect()
    assert [r["streak"] for r in got] == [1, 2, 3, 4, 5, 6, 0, 1]
    assert [r["severity"] for r in got] == ["warn"] * 5 + ["error", None, "warn"]
