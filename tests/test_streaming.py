"""Streams over several files give what the batch operators give, across restarts too."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import delivery, envelopes, journal
from tidemark.sources import records, sinks
from tidemark.streaming import batches, parts, stale
from tidemark.streaming import delivery as stream_delivery
from tidemark.streaming import journal as stream_journal

T0 = dt.datetime(2024, 1, 1)
SAID = "entity_id long, seq long, message string"


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, path, checkpoint, mode="append"):
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch_id={n}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.parquet(path)


@pytest.fixture
def said(spark, tmp_path):
    """Messages in three files, each with its own part of every entity's sequence."""
    data = [(e, i, f"{e}:{i}") for e in range(5) for i in range(30)]
    path = str(tmp_path / "said")
    for third in range(3):
        part = [row for row in data if row[1] // 10 == third]
        random.Random(third).shuffle(part)
        spark.createDataFrame(part, SAID).coalesce(1).write.mode("append").parquet(path)
    return path


def test_journal(spark, said, tmp_path, rows):
    out = run(stream_journal.stream_journal(stream(spark, said, SAID)), str(tmp_path / "o"), str(tmp_path / "c"), "update")
    assert out.count() == 15  # one row per entity and batch
    last = out.groupBy("entity_id").agg(F.max_by(F.struct("version", "message_count", "last_message"), "version").alias("s"))
    assert rows(last, "entity_id", "s.*") == rows(journal.journal_fold(spark.read.parquet(said)))


def test_journal_versions_with_replays_and_a_restart(spark, said, tmp_path, rows):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    versions = stream_journal.stream_journal_versions(stream(spark, said, SAID))
    batches.resume_stream(versions, out, checkpoint).awaitTermination()
    expected = rows(journal.journal_versions(spark.read.parquet(said)), "entity_id", "seq", "version", "line")
    assert rows(spark.read.parquet(out), "entity_id", "seq", "version", "line") == expected

    # the same events again, and one new one that comes twice
    spark.read.parquet(said).coalesce(1).write.mode("append").parquet(said)
    spark.createDataFrame([(0, 30, "new"), (0, 30, "new")], SAID).coalesce(1).write.mode("append").parquet(said)
    batches.resume_stream(versions, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out), "entity_id", "seq", "version", "line") == sorted(
        [*expected, (0, 30, 31, "User 0 (version 31) says: new")]
    )


@pytest.mark.parametrize("rows_per_range", [None, 4])
def test_appended_versions_with_replays_and_a_restart(spark, said, tmp_path, rows, rows_per_range):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")

    def take():
        source = stream(spark, said, SAID)
        stream_journal.append_journal_versions(source, out, checkpoint, rows_per_range=rows_per_range).awaitTermination()
        return rows(spark.read.parquet(out + "/versions"), "entity_id", "seq", "version", "line")

    expected = rows(journal.journal_versions(spark.read.parquet(said)), "entity_id", "seq", "version", "line")
    assert take() == expected
    spark.read.parquet(said).coalesce(1).write.mode("append").parquet(said)
    spark.createDataFrame([(0, 30, "new"), (0, 30, "new"), (77, 1, "x")], SAID).coalesce(1).write.mode("append").parquet(said)
    more = [(0, 30, 31, "User 0 (version 31) says: new"), (77, 1, 1, "User 77 (version 1) says: x")]
    assert take() == sorted([*expected, *more])


def test_positions_are_compacted(spark, tmp_path, rows):
    said, out, sizes = str(tmp_path / "in"), str(tmp_path / "o"), []
    for step in range(9):
        new = [(e, 2 * step + i, f"m{step}") for e in (step % 3, 10 + step % 2, 40) for i in range(2)]
        spark.createDataFrame(new, SAID).coalesce(1).write.mode("append").parquet(said)
        source = stream(spark, said, SAID)
        stream_journal.append_journal_versions(source, out, str(tmp_path / "c"), compact_every=2).awaitTermination()
        sizes.append(len(list((tmp_path / "o" / "state").glob("*_id=*"))))
        touched = spark.read.parquet(f"{out}/state/batch_id={step}")
        assert touched.count() == 3
    expected = rows(journal.journal_versions(spark.read.parquet(said)), "entity_id", "seq", "version", "line")
    assert rows(spark.read.parquet(out + "/versions"), "entity_id", "seq", "version", "line") == expected
    assert max(sizes) <= 5 and sizes[-1] == sizes[-3]


def test_snapshots_per_batch(spark, said, tmp_path, rows):
    out = str(tmp_path / "o")
    state = stream_journal.stream_journal(stream(spark, said, SAID))
    batches.write_snapshots(state, out, str(tmp_path / "c")).awaitTermination()
    written = spark.read.schema(state.schema).json(out)
    assert written.count() == 15
    assert rows(written.groupBy("entity_id").agg(F.max("version"))) == [(e, 30) for e in range(5)]


def test_consumed_count(spark, tmp_path, rows):
    rng = random.Random(4)
    path = str(tmp_path / "events")
    schema = "stream_id long, ts timestamp_ntz"
    for _ in range(3):
        data = [(rng.randrange(3), T0 + dt.timedelta(minutes=rng.randrange(60))) for _ in range(50)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    subs = spark.createDataFrame(
        [("a", 0, T0, None), ("a", 0, T0, T0 + dt.timedelta(minutes=30)), ("b", 2, T0 + dt.timedelta(minutes=20), None)],
        "consumer string, stream_id long, start_ts timestamp_ntz, stop_ts timestamp_ntz",
    )
    folder, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for _ in range(2):  # a second start finds nothing new
        query = stream_delivery.stream_consumed_count(stream(spark, path, schema), subs, folder, checkpoint, rows_per_range=10)
        query.awaitTermination()
    assert spark.read.parquet(folder).select("batch_id").distinct().count() == 3
    assert rows(stream_delivery.consumed_so_far(spark, folder)) == rows(delivery.consumed_count(spark.read.parquet(path), subs))


@pytest.mark.parametrize("files", [1, 4])
def test_stale_keys_do_not_depend_on_the_batches(spark, tmp_path, rows, files):
    schema = "key string, scan_ts timestamp_ntz, owner string, version long"
    minutes = {"quiet": [(0, 1), (5, 1), (6, 2), (30, 2), (31, 3)], "busy": [(m, m) for m in range(0, 60, 5)], "free": [(1, 1), (40, 1)]}
    data = [(k, T0 + dt.timedelta(minutes=m), None if k == "free" else "w", v) for k, times in minutes.items() for m, v in times]
    data.sort(key=lambda r: r[1])
    path = str(tmp_path / "scans")
    size = -(-len(data) // files)
    for i in range(files):
        spark.createDataFrame(data[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    found = stale.stream_stale_keys(stream(spark, path, schema), dt.timedelta(minutes=10), delay="0 seconds")
    batches.resume_stream(found, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "o")).select("key", F.col("last_change").cast("timestamp_ntz")))
    assert got == [("free", None), ("quiet", T0 + dt.timedelta(minutes=6)), ("quiet", T0 + dt.timedelta(minutes=31))]


def test_resume_makes_no_duplicates(spark, said, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for expected in (150, 150, 151):
        if expected == 151:
            spark.createDataFrame([(9, 9, "x")], SAID).write.mode("append").parquet(said)
        batches.resume_stream(stream(spark, said, SAID), out, checkpoint).awaitTermination()
        assert spark.read.parquet(out).count() == expected


def test_failed_batches_are_kept_and_skipped(spark, said, tmp_path):
    done, refused = str(tmp_path / "done"), str(tmp_path / "refused")
    calls = []

    def process(batch, n):
        if n == 1:
            raise ValueError("no")
        batch.write.mode("overwrite").parquet(f"{done}/batch_id={n}")

    batches.process_batches(
        stream(spark, said, SAID),
        str(tmp_path / "c"),
        refused,
        process,
        initialize=lambda: calls.append("init"),
        shutdown=calls.append,
        on_error=lambda n, problem: calls.append((n, str(problem))),
    )
    assert calls == ["init", (1, "no"), "finished"]
    kept, skipped = spark.read.parquet(done), spark.read.parquet(refused)
    assert (kept.count(), skipped.count()) == (100, 50)
    assert kept.select(*SAID.split(" ")[0:1]).count() + skipped.count() == 150


def test_observer(spark, said, tmp_path):
    seen = []
    observer = batches.StreamObserver(
        on_next=lambda n, rows: seen.append(("next", rows)),
        on_error=lambda problem: seen.append(("error",)),
        on_completed=lambda: seen.append(("completed",)),
    )
    spark.streams.addListener(observer)
    try:
        batches.resume_stream(stream(spark, said, SAID), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
        broken = stream(spark, said, SAID).select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
        with pytest.raises(Exception):
            batches.resume_stream(broken, str(tmp_path / "p"), str(tmp_path / "d")).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(observer)
    assert [x for x in seen if x == ("next", 50)] == [("next", 50)] * 3
    assert ("completed",) in seen and ("error",) in seen


def test_filter_and_publish(spark, tmp_path, rows):
    schema = "stream_id long, events array<int>"
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, [1, 2]), (2, []), (3, [0])], schema).write.parquet(path)
    kept = stream_delivery.filter_stream(stream(spark, path, schema), lambda e: e > 1)
    out = str(tmp_path / "out")
    sinks.publish_stream(kept, out, str(tmp_path / "c"), n=4).awaitTermination()
    assert rows(spark.read.parquet(out), "stream_id", "events") == [(1, [1, 2])]


PARTS = "batch long, part long, parts long, at timestamp, file string, events array<struct<n: int, at: timestamp, raw: binary>>, request_context map<string,string>"


def part(batch, number, parts, numbers, file="f", day=0):
    moment = dt.datetime(2024, 1, 1, 0, 0, 0, 123456) + dt.timedelta(days=day)
    return (batch, number, parts, moment, file, [(n, moment, bytearray([n])) for n in numbers], {"k": None, "b": str(batch)})


def files(spark, path, groups):
    for group in groups:
        spark.createDataFrame(group, PARTS).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


@pytest.fixture
def parted(spark, tmp_path):
    """Parts of five batches over four files; batch 4 never ends."""
    path = str(tmp_path / "parts")
    files(spark, path, [
        [part(1, 2, 3, [7]), part(2, 0, 1, [1, 9]), part(3, 0, 2, [1])],
        [part(1, 0, 3, [1, 2], "g"), part(4, 1, 3, [9])],
        [part(3, 1, 2, [2]), part(5, 0, 1, [3]), part(4, 0, 3, [4])],
        [part(1, 1, 3, [9, 3], "h"), part(None, 0, 2, [9]), part(None, 1, 2, [5])],
    ])
    return path


def test_filter_stream_keeps_all_parts_of_a_batch(spark, parted, tmp_path, rows):
    given = spark.read.parquet(parted)
    for batch_key in (["batch"],):
        kept = stream_delivery.filter_stream(stream(spark, parted, PARTS), lambda e: e["n"] == 9, batch_key)
        got = run(kept, str(tmp_path / "o"), str(tmp_path / "c")).drop("batch_id")
        wanted = envelopes.filter_any(given, lambda e: e["n"] == 9, batch_key)
        assert got.dtypes == wanted.dtypes
        assert sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)
        assert got.count() == 8


def test_unpack_stream_numbers_over_parts(spark, parted, tmp_path):
    given = spark.read.parquet(parted).where("batch is null or batch <> 4")
    read = stream_delivery.unpack_stream(stream(spark, parted, PARTS), lambda e: e["n"] != 2, ["batch"])
    got = run(read, str(tmp_path / "o"), str(tmp_path / "c")).drop("batch_id")
    wanted = envelopes.unpack_envelopes(given, lambda e: e["n"] != 2, ["batch"])
    assert got.dtypes == wanted.dtypes
    in_order = got.where("batch is null or batch <> 4")
    assert sorted(in_order.collect(), key=str) == sorted(wanted.collect(), key=str)
    # batch 4 waits for its last part, but the first two have come
    assert [r.event_index for r in got.where("batch = 4").orderBy("event_index").collect()] == [0, 1]


def test_unpack_stream_numbers_many_early_parts(spark, tmp_path, rows):
    """Parts in falling order, more than are held in memory, over two micro-batches and with repeated ones."""
    path, count = str(tmp_path / "in"), 2 * parts.EARLY + 300
    falling = [part(1, p, count, [p % 100] * 2) for p in range(count - 1, -1, -1)]
    files(spark, path, [falling[:-200], [*falling[100:110], *falling[-200:]]])
    read = stream_delivery.unpack_stream(stream(spark, path, PARTS), None, ["batch"])
    got = run(read, str(tmp_path / "o"), str(tmp_path / "c")).select("event_index", "event.n")
    assert rows(got) == [(i, i // 2 % 100) for i in range(2 * count)]


@pytest.mark.parametrize("order, most_calls", [([0, 1, 2, 3], 1), ([3, 1, 0, 2], 1), ([2, 3, 1], 5)])
def test_parts_of_one_micro_batch_hardly_touch_the_state(order, most_calls):
    """Each call to the state is a round trip of a task; what comes together needs none but the look for earlier parts."""
    calls = []

    class State:
        def __getattr__(self, name):
            return lambda *given: calls.append(name)

    class Handle:
        def getValueState(self, *given):
            return State()

        def getMapState(self, *given):
            return State()

    handler = parts._Numbering(timed=False)
    handler.init(Handle())
    given = [Row(part=p, parts=4, payload=str(p), n=2, event_ms=0) for p in order]
    passed = [(r.payload, r.before) for r in handler.handleInputRows((1,), iter(given), None)]
    assert passed == ([(str(p), 2 * p) for p in range(4)] if 0 in order else [])
    assert len(calls) <= most_calls


def test_parts_wait_over_a_restart(spark, tmp_path, rows):
    path, out, checkpoint = (str(tmp_path / n) for n in "ioc")
    files(spark, path, [[part(1, 0, 2, [1])]])
    start = lambda: run(stream_delivery.filter_stream(stream(spark, path, PARTS), lambda e: e["n"] == 9, ["batch"]), out, checkpoint)
    assert start().count() == 0
    files(spark, path, [[part(1, 1, 2, [9])]])
    assert rows(start(), "batch", "part") == [(1, 0), (1, 1)]


def test_event_time_closes_a_batch(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    schema = PARTS.replace("parts long, ", "")
    rows_of = lambda group: [(*r[:2], *r[3:]) for r in group]
    groups = [
        [part(1, 0, None, [1]), part(2, 1, None, [9])],
        [part(9, 0, None, [1], day=5)],
        [part(9, 1, None, [1], day=10)],
        # batch 1 is closed without a match, so the match comes too late; so does part 0 of batch 2
        [part(1, 1, None, [9], day=0), part(2, 0, None, [1], day=0), part(9, 2, None, [9], day=10)],
    ]
    for group in groups:
        spark.createDataFrame(rows_of(group), schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    given = stream(spark, path, schema)
    kept = stream_delivery.filter_stream(given, lambda e: e["n"] == 9, ["batch"], "at", "1 day")
    assert rows(run(kept, str(tmp_path / "o"), str(tmp_path / "c")), "batch", "part") == [(2, 1), (9, 0), (9, 1), (9, 2)]
    read = stream_delivery.unpack_stream(given, None, ["batch"], "at", "1 day")
    # part 1 of batch 2 waits for part 0 until event time closes the batch
    assert rows(run(read, str(tmp_path / "p"), str(tmp_path / "d")), "batch", "part", "event_index") == [
        (1, 0, 0), (2, 1, 0), (9, 0, 0), (9, 1, 1), (9, 2, 2)
    ]


def test_streams_with_parts_are_refused_where_state_is_needed(spark, parted):
    given = stream(spark, parted, PARTS)
    with pytest.raises(ValueError, match="filter_stream"):
        envelopes.filter_any(given, lambda e: e["n"] == 9, ["batch"])
    with pytest.raises(ValueError, match="unpack_stream"):
        envelopes.unpack_envelopes(given, None, ["batch"])
    with pytest.raises(ValueError, match="event_time"):
        stream_delivery.filter_stream(given.drop("parts"), lambda e: e["n"] == 9, ["batch"])


def test_latest_reads_only_files_written_later(spark, tmp_path):
    path = str(tmp_path / "said")
    spark.createDataFrame([(1, 1, "old")], SAID).write.mode("append").parquet(path)
    time.sleep(0.05)
    since = dt.datetime.now(dt.timezone.utc)
    time.sleep(0.05)

    def take(name):
        later = records.scan_records(spark, path, "LATEST", ts=since, schema=spark.read.parquet(path).schema, streaming=True)
        batches.resume_stream(later, str(tmp_path / name), str(tmp_path / "c")).awaitTermination()
        return spark.read.schema(SAID).parquet(str(tmp_path / name)).count()

    assert take("o") == 0
    spark.createDataFrame([(1, 2, "new")], SAID).write.mode("append").parquet(path)
    assert take("o") == 1


def test_records_as_a_stream(spark, tmp_path):
    schema = "shard_id long, sequence_number string, sub_sequence long, arrival_ts timestamp_ntz"
    path = str(tmp_path / "records")
    spark.createDataFrame([(1, str(i), 0, T0 + dt.timedelta(days=i)) for i in range(9)], schema).write.parquet(path)
    kind = spark.read.parquet(path).schema
    df = records.scan_records(spark, path, "AT_TIMESTAMP", ts=T0 + dt.timedelta(days=6), schema=kind, streaming=True, max_files_per_trigger=2)
    assert df.isStreaming
    assert run(df, str(tmp_path / "o"), str(tmp_path / "c")).count() == 3
    with pytest.raises(ValueError):
        records.scan_records(spark, path, "LATEST", streaming=True)
