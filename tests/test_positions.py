"""A consumer with a position per shard: restarts, new shards, start positions, limits, crashes."""

import datetime as dt

import pytest

from tidemark.functions import sequence as q
from tidemark.sources import records as r
from tidemark.streaming.positions import ShardConsumer

SCHEMA = "shard_id string, sequence_number string, sub_sequence long, arrival_ts timestamp_ntz, data string"
T0 = dt.datetime(2024, 1, 1)


def some(spark, shard, first, last):
    return spark.createDataFrame([(shard, str(n), None if n % 2 else 0, T0 + dt.timedelta(minutes=n), f"{shard}{n}") for n in range(first, last)], SCHEMA)


class Taken:
    def __init__(self):
        self.batches = []

    def __call__(self, batch, number):
        self.batches.append((number, sorted(x.data for x in batch.collect())))

    def all(self):
        return sorted(d for _, b in self.batches for d in b)


@pytest.fixture
def path(spark, tmp_path):
    place = str(tmp_path / "records")
    r.write_records(some(spark, "a", 8, 13).unionByName(some(spark, "b", 100, 102)), place)
    return place


def names(shard, first, last):
    return [f"{shard}{n}" for n in range(first, last)]


@pytest.mark.parametrize(
    ("position", "more", "old"),
    [
        (q.TRIM_HORIZON, {}, names("a", 8, 13) + names("b", 100, 102)),
        (q.LATEST, {}, []),
        (q.AT_SEQUENCE_NUMBER, {"seq": "10"}, names("a", 10, 13) + names("b", 100, 102)),
        (q.AFTER_SEQUENCE_NUMBER, {"seq": "0012"}, names("b", 100, 102)),
        (q.AT_TIMESTAMP, {"ts": "2024-01-01 00:11:00"}, names("a", 11, 13) + names("b", 100, 102)),
    ],
)
def test_restart_with_a_new_shard(spark, path, tmp_path, position, more, old):
    taken, folder = Taken(), str(tmp_path / "state")
    ShardConsumer(spark, path, folder, position, **more).run(taken)
    assert taken.all() == sorted(old)
    # a shard that appears later is read from its beginning, although its numbers are small
    r.write_records(some(spark, "a", 13, 15).unionByName(some(spark, "c", 1, 4)), path)
    again = Taken()
    assert ShardConsumer(spark, path, folder, position, **more).run(again) == 1
    assert again.all() == names("a", 13, 15) + names("c", 1, 4)
    assert ShardConsumer(spark, path, folder, position, **more).run(again) == 0


def test_limit_counts_records_of_a_shard(spark, path, tmp_path):
    taken = Taken()
    consumer = ShardConsumer(spark, path, str(tmp_path / "state"), limit=2)
    assert consumer.run(taken, most_batches=1) == 1 and consumer.run(taken) == 2
    assert [b for _, b in taken.batches] == [["a8", "a9", "b100", "b101"], ["a10", "a11"], ["a12"]]
    assert [n for n, _ in taken.batches] == [0, 1, 2]
    assert {x.key: (x.sequence_number, x.version) for x in consumer.positions().collect()} == {"a": ("12", 3), "b": ("101", 1)}


def test_a_batch_comes_again_as_it_was(spark, path, tmp_path):
    consumer, seen = ShardConsumer(spark, path, str(tmp_path / "state")), []

    def breaks(batch, number):
        seen.append((number, batch.count()))
        raise OSError("gone")

    with pytest.raises(OSError):
        consumer.run(breaks)
    r.write_records(some(spark, "a", 13, 20), path)
    taken = Taken()
    assert consumer.run(taken) == 2
    assert seen == [(0, 7)] and [len(b) for _, b in taken.batches] == [7, 7] and taken.all() == sorted(names("a", 8, 20) + names("b", 100, 102))


def test_of_two_consumers_one_fails(spark, path, tmp_path):
    folder = str(tmp_path / "state")

    def meanwhile(batch, number):
        if not other.batches:
            ShardConsumer(spark, path, folder).run(other)

    other = Taken()
    with pytest.raises(RuntimeError, match="another consumer"):
        ShardConsumer(spark, path, folder).run(meanwhile)
    assert len(other.all()) == 7


def test_only_files_beyond_the_positions_are_read(spark, path):
    before = set(spark.read.parquet(path).inputFiles())
    marks = spark.createDataFrame([("a", "12", 0), ("b", "101", 0)], "shard_id string, sequence_number string, sub_sequence long")
    assert r.files_beyond(spark, path, marks) == []
    r.write_records(some(spark, "a", 13, 15), path)
    assert set(r.files_beyond(spark, path, marks)) == set(spark.read.parquet(path).inputFiles()) - before
    assert len(r.files_beyond(spark, path, marks.where("shard_id = 'a'"))) > 0
    # a file without an index is not missed
    some(spark, "a", 1, 2).selectExpr("*", "1 AS seq_length", "'1' AS seq_digits").write.mode("append").parquet(path + "/written=x")
    assert any("written=x" in f for f in r.files_beyond(spark, path, marks))
