"""Range-by-range results equal those of one plain window per key."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import hot_ranges
from tidemark.plans.hot_ranges import find_hot_keys, find_hot_ranges
from tidemark.plans.lookup import join_one_per_key
from tidemark.plans.positions import with_positions
from tidemark.plans.running import (
    first_rows,
    greatest_before,
    latest,
    previous,
    row_count,
    running,
    running_since,
    total,
)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    data = []
    for i in range(6000):
        # key 0 and the null key are hot, the others are small
        key = rng.choice([0, 0, 0, None, rng.randrange(1, 40)])
        kind = rng.choice(["a", "b", "c", None])
        data.append((key, i if rng.random() < 0.999 else 10**15 + i, kind, rng.randrange(100)))
    return spark.createDataFrame(data, "key long, pos long, kind string, value long").repartition(5).cache()


def measures():
    return {
        "n": row_count(),
        "sum": total(F.col("value")),
        "top": greatest_before(F.when(F.col("kind") == "a", F.struct("value", "pos"))),
        "last": latest(F.when(F.col("kind") == "b", F.col("value"))),
        "prev": previous(F.col("kind")),
    }


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_keys_are_split(events):
    ranges = find_hot_ranges(events, ["key"], ["pos"], 200)
    tagged = ranges.tag(events)
    per_key = {r["key"]: r["n"] for r in tagged.where("__range is not null").groupBy("key").agg(F.countDistinct("__range").alias("n")).collect()}
    assert set(per_key) == {0, None} and min(per_key.values()) >= 3
    assert tagged.count() == events.count()
    sizes = tagged.where("__range is not null").groupBy("key", "__range").count()
    assert sizes.agg(F.max("count")).first()[0] < events.count() / 5


def test_no_hot_key(events):
    assert find_hot_ranges(events, ["key"], ["pos"], 100_000) is None
    assert find_hot_keys(events, ["key"]) is None
    assert find_hot_keys(events, ["key"], math.inf) is None


@pytest.mark.parametrize("keys,rows_per_range", [(["key"], 100), (["key"], 1500), (["key", "kind"], 150)])
def test_running_equals_plain_window(events, keys, rows_per_range):
    ranges = find_hot_ranges(events, keys, ["pos"], rows_per_range)
    assert ranges is not None
    split = running(events, keys, ["pos"], measures(), ranges)
    assert same(split, running(events, keys, ["pos"], measures(), None))


def test_null_order_sorts_first(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 1), (1, 4, 2), (1, 5, 9), (1, 6, 7)], "key long, pos long, value long")
    ranges = find_hot_ranges(df, ["key"], ["pos"], 2)
    assert same(running(df, ["key"], ["pos"], {"s": total(F.col("value"))}, ranges), running(df, ["key"], ["pos"], {"s": total(F.col("value"))}, None))


def test_text_and_struct_orders(spark, events):
    texts = events.withColumn("at", F.struct(F.lpad(F.col("pos").cast("string"), 20, "0").alias("t"), "value"))
    ranges = find_hot_ranges(texts, ["key"], ["at"], 300)
    split = running(texts, ["key"], ["at"], measures(), ranges)
    assert same(split, running(texts, ["key"], ["at"], measures(), None))


def test_running_since(events):
    args = (["key"], ["pos"], F.col("kind").isin("a", "b"), F.col("kind") == "c", "since")
    ranges = find_hot_ranges(events, ["key"], ["pos"], 150)
    assert same(running_since(events, *args, ranges), running_since(events, *args, None))


def test_result_does_not_depend_on_the_edges(events, monkeypatch):
    monkeypatch.setattr(hot_ranges, "SAMPLED_PER_RANGE", 1)
    ranges = find_hot_ranges(events, ["key"], ["pos"], 120)
    assert same(running(events, ["key"], ["pos"], measures(), ranges), running(events, ["key"], ["pos"], measures(), None))


def test_no_hot_key_is_left_whole(spark):
    """1,500 hot keys of 20 rows, and one with a third of all rows: ranges in proportion to rows."""
    many = spark.range(30_000).select((F.col("id") % 1500).alias("key"), F.col("id").alias("pos"))
    df = many.union(spark.range(15_000).select(F.lit(-1).alias("key"), F.col("id").alias("pos")))
    ranges = find_hot_ranges(df, ["key"], ["pos"], 10)
    sizes = ranges.tag(df).groupBy("key", "__range").count()
    assert sizes.where("__range is null").isEmpty()
    assert sizes.where("key = -1").count() > 1000 and sizes.where("key = -1").agg(F.max("count")).first()[0] < 100
    per_key = sizes.groupBy("key").agg(F.count("*").alias("n"))
    assert per_key.count() == 1501 and per_key.agg(F.min("n")).first()[0] >= 2
    got = running(df, ["key"], ["pos"], {"n": row_count()}, ranges)
    assert same(got, running(df, ["key"], ["pos"], {"n": row_count()}, None))


def test_nested_values_read_their_input_once(spark, events, tmp_path):
    events.write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    ranges = find_hot_ranges(stored, ["key"], ["pos"], 150)
    df = running_since(stored, ["key"], ["pos"], F.col("kind") == "a", F.col("kind") == "c", "since", ranges)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in plan and plan.count("FileScan") == 2  # the tagged rows and the carries


def test_first_rows_both_ways(spark, events):
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    plain = first_rows(events, ["key"], ["pos"], 700)
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        split = first_rows(events, ["key"], ["pos"], 700, rows_per_range=200)
    finally:
        spark.conf.set(name, before)
    assert "WindowGroupLimit" in plain._jdf.queryExecution().executedPlan().toString()
    assert same(plain, split)


def test_join_one_per_key(events):
    singles = events.where("key is not null and key % 2 = 0").groupBy("key").agg(F.max("pos").alias("top"))
    known = events.where("key is not null")
    plain = known.join(singles, "key", "left")
    split = join_one_per_key(known, singles, ["key"], 200)
    assert same(split.select(*plain.columns), plain)


def test_split_plan_shuffles_the_rows_once(events):
    ranges = find_hot_ranges(events, ["key"], ["pos"], 150)
    df = running_since(events, ["key"], ["pos"], F.col("kind") == "a", F.col("kind") == "c", "since", ranges)
    plan = df._jdf.queryExecution().executedPlan().toString()
    main = plan.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning(key") == 1


def test_rows_partitioned_by_key_are_spread_again(spark, events):
    """A shuffled join on the key must not leave a hot key's ranges in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = events.where("key is not null").groupBy("key").agg(F.max("kind").alias("name"))
        joined = events.join(names, "key")
        ranges = find_hot_ranges(joined, ["key"], ["pos"], 150)
        df = running(joined, ["key"], ["pos"], {"n": row_count()}, ranges)
        main = df._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        assert "Exchange hashpartitioning(key" in main and "__range" in main.split("Exchange hashpartitioning(key")[1].split(")")[0]
        assert same(df, running(joined, ["key"], ["pos"], {"n": row_count()}, None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_positions(spark):
    table = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("v"), F.lit("x").alias("odd.name")).repartition(7)
    placed = with_positions(table, F.col("v").desc(), name="place")
    assert placed.columns == ["v", "odd.name", "place"]
    assert placed.where("place <> 5000 - v").count() == 0 and placed.select("place").distinct().count() == 5_000
    assert with_positions(table.where("false"), F.col("v")).count() == 0
    ties = with_positions(spark.createDataFrame([(1,), (1,), (None,)], "v long"), F.col("v").asc_nulls_last()).collect()
    assert sorted((r.position, r.v) for r in ties) == [(1, 1), (2, 1), (3, None)]
