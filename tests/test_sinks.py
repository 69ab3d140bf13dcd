import pytest
from pyspark.sql import functions as F

from tidemark.operators import envelopes
from tidemark.plans import durable
from tidemark.sources import sinks, tables


@pytest.fixture(scope="module")
def packed(spark):
    events = spark.createDataFrame([(s, i, f"{s}/{i}") for s in range(20) for i in range(3)], "stream_id long, at long, word string")
    return envelopes.pack_envelopes(events, ["stream_id"], ["stream_id"], "at", ["word"])


def test_publish_appends_and_routes_whole_streams(spark, packed, tmp_path):
    path = str(tmp_path / "queues")
    sinks.publish(packed, path, n=4)
    sinks.publish(packed, path, n=4)
    back = spark.read.parquet(path)
    assert back.count() == 40
    assert back.groupBy("stream_id").agg(F.countDistinct("queue_id").alias("n")).where("n > 1").isEmpty()
    assert {r[0] for r in back.select("queue_id").distinct().collect()} <= {0, 1, 2, 3}


def test_publish_refuses_a_sequence_token(spark, packed, tmp_path):
    none = packed.withColumn("seq", F.lit(None).cast("long"))
    sinks.publish(none, str(tmp_path / "ok"))
    with pytest.raises(Exception, match="sequence token"):
        sinks.publish(packed.withColumn("seq", F.lit(1)), str(tmp_path / "bad"))


@pytest.mark.parametrize("fmt", sinks.SNAPSHOT_FORMATS)
def test_snapshot_of_a_batch_is_replaced(spark, tmp_path, fmt):
    path = str(tmp_path / "snapshot")
    state = spark.createDataFrame([(1, "a")], "entity_id long, last_message string")
    sinks.write_snapshot(state, path, 7, fmt)
    folder = sinks.write_snapshot(state, path, 7, fmt)
    sinks.write_snapshot(state, path, 8, fmt)
    assert spark.read.format(fmt).schema(state.schema).load(folder).collect() == state.collect()
    with pytest.raises(ValueError):
        sinks.write_snapshot(state, path, 9, "csv")


def test_jdbc_options():
    assert sinks.jdbc_options("jdbc:x:y", "t") == {"url": "jdbc:x:y", "dbtable": "t", "batchsize": "1000"}
    options = sinks.jdbc_options("jdbc:x:y", "t", user="u", password="p", batch=5)
    assert options["user"] == "u" and options["password"] == "p" and options["batchsize"] == "5"


def test_scans(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    spark.createDataFrame([(i, f"v{i}") for i in range(10)], "key long, value string").write.parquet(path)
    assert tables.scan_state(spark, path).count() == 10
    assert tables.scan_state(spark, path, 3).count() == 3
    assert rows(tables.lookup_key(tables.scan_state(spark, path), 4)) == [(4, "v4")]
    assert tables.lookup_key(tables.scan_state(spark, path), 40).isEmpty()
    assert "EqualTo(key,4)" in tables.lookup_key(spark.read.parquet(path), 4)._jdf.queryExecution().executedPlan().toString()
    assert not tables.is_state_empty(spark.read.parquet(path))
    assert rows(tables.distinct_shard_ids(tables.scan_shards(spark, path), "key")) == [(i,) for i in range(10)]
    with pytest.raises(FileNotFoundError):
        tables.scan_shards(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        tables.scan_state(spark, path, -1)


def test_work_folders_are_in_the_shared_folder(spark):
    folder = durable.shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    a, b = durable.work_folder(spark, "x"), durable.work_folder(spark, "x")
    assert a != b and a.startswith(folder + "/x-")


def test_cut_lineage_starts_from_files(spark):
    df = durable.cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 20
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan
