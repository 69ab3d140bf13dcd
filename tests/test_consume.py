import datetime as dt

import pytest

from tidemark.functions.sequence import SHARD_END
from tidemark.operators import consume as c
from tidemark.sources import records as r

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def records(spark):
    data = [
        ("s1", "9", 0, "ab", T0),
        ("s1", "10", 0, "ab", T0 + dt.timedelta(milliseconds=1500)),
        ("s1", "10", 1, "é", T0 + dt.timedelta(seconds=2)),
        ("s2", "100", 0, None, T0),
        ("s3", "7", 0, "x", T0),
        ("s4", "8", 0, "x", T0),
    ]
    return spark.createDataFrame(data, "shard_id string, sequence_number string, sub_sequence long, data string, arrival_ts timestamp_ntz")


def points(df):
    return sorted((x["shard_id"], x["sequence_number"], x["sub_sequence"]) for x in df.collect())


def checkpoints(spark, *rows):
    return spark.createDataFrame(list(rows), "shard_id string, sequence_number string, sub_sequence long")


def test_after_checkpoint(spark, records):
    marks = checkpoints(spark, ("s1", "10", 0), ("s2", "TRIM_HORIZON", 0), ("s3", SHARD_END, 0))
    assert points(c.after_checkpoint(records, marks)) == [("s1", "10", 1), ("s2", "100", 0), ("s4", "8", 0)]


def test_high_water_mark(spark, records):
    marks = checkpoints(spark, ("s1", "9", 0), ("s3", SHARD_END, 0), ("s4", "9", 0))
    prior = checkpoints(spark, ("s2", "99", 5), ("s4", "9", 0), ("s5", "1", 1))
    assert points(c.high_water_mark(records, marks, prior)) == [("s1", "10", 1), ("s2", "100", 0), ("s4", "9", 0), ("s5", "1", 1)]
    assert points(c.high_water_mark(records)) == [("s1", "10", 1), ("s2", "100", 0), ("s3", "7", 0), ("s4", "8", 0)]


def commit(spark, requests, state, rows_per_range=None):
    asked = spark.createDataFrame(requests, "shard_id string, request_order long, sequence_number string, sub_sequence long")
    known = spark.createDataFrame(
        state,
        "shard_id string, last_sequence string, last_sub long, mark_sequence string, mark_sub long, end_sequence string",
    )
    done = c.checkpoint_commit(asked, known, rows_per_range=rows_per_range).orderBy("shard_id", "request_order").collect()
    return [(x["outcome"], x["recorded_sequence"], x["recorded_sub"]) for x in done]


@pytest.mark.parametrize("rows_per_range", [None, 2])
def test_commit_golden(spark, rows_per_range):
    asked = [("s", i, n, 0) for i, n in enumerate(["7", "6", "11", "7", "10"])]
    got = commit(spark, asked, [("s", "5", 0, "10", 0, None)], rows_per_range)
    assert [x[0] for x in got] == [c.ACCEPTED, c.REJECTED, c.REJECTED, c.NO_OP, c.ACCEPTED]


def test_commit_at_shard_end(spark):
    asked = [("s", i, n, 0) for i, n in enumerate(["7", "10", "10", "8"])]
    got = commit(spark, asked, [("s", "5", 0, "10", 0, "10")])
    assert got == [(c.ACCEPTED, "7", 0), (c.ACCEPTED, SHARD_END, 0), (c.REJECTED, None, None), (c.REJECTED, None, None)]


def test_commit_without_a_number_takes_the_mark(spark):
    asked = [("s", 0, None, None), ("s", 1, "9", 0), ("s", 2, None, None)]
    got = commit(spark, asked, [("s", "TRIM_HORIZON", 0, "10", 2, None)])
    assert got == [(c.ACCEPTED, "10", 2), (c.REJECTED, None, None), (c.NO_OP, None, None)]


def test_commit_equal_to_last_at_the_end_stays_a_no_op(spark):
    got = commit(spark, [("s", 0, "10", 0), ("s", 1, "10", 0)], [("s", "10", 0, "10", 0, "10")])
    assert [x[0] for x in got] == [c.NO_OP, c.NO_OP]


def test_commit_for_an_unknown_shard_is_rejected(spark):
    assert commit(spark, [("t", 0, "10", 0), ("t", 1, None, None)], [("s", "1", 0, "10", 0, None)]) == [(c.REJECTED, None, None)] * 2


@pytest.mark.parametrize("number,sub", [("x", 0), ("", 0), ("5", -1)])
def test_malformed_commit_raises(spark, number, sub):
    with pytest.raises(Exception, match="invalid checkpoint"):
        commit(spark, [("s", 0, number, sub)], [("s", "1", 0, "10", 0, None)])


def test_finished_shards(spark):
    shards = spark.createDataFrame([("a", "10"), ("b", "10"), ("c", None), ("d", "5"), ("e", "5")], "shard_id string, end_seq string")
    progress = checkpoints(spark, ("a", "10", 0), ("b", "9", 9), ("c", "99", 0), ("d", SHARD_END, 0))
    assert sorted(x[0] for x in c.finished_shards(shards, progress).collect()) == ["a", "d"]


def test_throughput_and_lag(spark, records, rows):
    assert rows(c.shard_throughput(records)) == [("s1", 3, 6), ("s2", 1, 0), ("s3", 1, 1), ("s4", 1, 1)]
    progress = spark.createDataFrame([("s1", T0 + dt.timedelta(milliseconds=500)), ("s2", T0)], "shard_id string, processed_ts timestamp_ntz")
    assert rows(c.shard_lag(records, progress), "shard_id", "lag_ms") == [("s1", 1500), ("s2", 0), ("s3", None), ("s4", None)]


def test_start_positions(records):
    def n(*args, **kw):
        return r.start_position(records, *args, **kw).count()

    assert n("TRIM_HORIZON") == 6 and n("LATEST") == 0 and n(SHARD_END) == 0
    assert n("AT_TIMESTAMP", ts=T0 + dt.timedelta(seconds=1)) == 2
    assert n("AT_SEQUENCE_NUMBER", seq="10") == 3 and n("AFTER_SEQUENCE_NUMBER", seq="10") == 2
    assert n("AFTER_SEQUENCE_NUMBER", seq="10", sub=1) == 1
    for bad in [(None,), ("NEVER",), ("AT_TIMESTAMP",), ("AT_SEQUENCE_NUMBER",)]:
        with pytest.raises(ValueError):
            n(*bad)


def test_timestamp_position_reaches_the_scan(spark, records, tmp_path):
    path = str(tmp_path / "records")
    records.write.parquet(path)
    found = r.scan_records(spark, path, "AT_TIMESTAMP", ts=T0 + dt.timedelta(seconds=1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(arrival_ts), GreaterThanOrEqual(arrival_ts" in plan
    assert found.count() == 2


def test_bounded_batch(records):
    assert points(r.bounded_batch(records, 2)) == [("s1", "10", 0), ("s1", "9", 0), ("s2", "100", 0), ("s3", "7", 0), ("s4", "8", 0)]
    assert r.bounded_batch(records, -1).count() == 6
    assert r.bounded_batch(records, -1, configured_max=1).count() == 4
    assert r.bounded_batch(records, 5, configured_max=2).count() == 6


def test_union_queues(spark, rows):
    queues = {q: spark.createDataFrame([(q * 10,)], "x long") for q in (0, 7)}
    assert rows(r.union_queues(queues), "queue_id", "x") == [(0, 0), (7, 70)]
    with pytest.raises(ValueError):
        r.union_queues({})
