import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing as h
from tidemark.operators import expand as x

RECORDS = (
    "shard_id string, sequence_number string, partition_key string, data binary, arrival_ts timestamp_ntz, "
    "partition_keys array<string>, explicit_hash_keys array<string>, items array<struct<pk_index:int,ehk_index:int,data:binary>>"
)
MAGIC = bytes.fromhex("F3899AC2")


def framed(message):
    return MAGIC + message + hashlib.md5(message).digest()


def test_decimal_to_hex(spark):
    rng = random.Random(1)
    numbers = [0, 1, 2**32 - 1, 2**32, 2**64, 10**38, 2**128 - 1] + [rng.randrange(2 ** rng.randrange(1, 129)) for _ in range(200)]
    df = spark.createDataFrame([(str(n), f"{n:032x}") for n in numbers], "n string, want string")
    assert df.where(h.decimal_to_hex128("n") != F.col("want")).count() == 0


def test_effective_hash_key(spark):
    df = spark.createDataFrame([("é", None), ("a", "255")], "pk string, ehk string")
    got = [r[0] for r in df.select(h.effective_hash_key("pk", "ehk")).collect()]
    assert got == [hashlib.md5("é".encode()).hexdigest(), f"{255:032x}"]


def test_route_to_queue(spark):
    df = spark.range(2000).withColumn("ns", F.lit("n"))
    routed = df.select("id", h.route_to_queue("id").alias("q"), h.route_to_queue("id", "ns", 3).alias("r"))
    counts = {r["q"]: r["count"] for r in routed.groupBy("q").count().collect()}
    assert set(counts) == set(range(8)) and min(counts.values()) > 150
    assert {r[0] for r in routed.select("r").distinct().collect()} == {0, 1, 2}
    for bad in (0, -1, 2.0, "8", True):
        with pytest.raises(ValueError):
            h.route_to_queue("id", n=bad)


@pytest.mark.parametrize("digits", [1, 2, 3, None])
def test_route_by_hash_range(spark, digits):
    keys = [f"k{i}" for i in range(300)]
    edges = [0, 2**125, 2**127 - 3, 2**128]
    shards = [(f"s{i}", f"{lo:032x}", f"{hi - 1:032x}") for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    exact = hashlib.md5(b"k7").hexdigest()
    shards.append(("one", exact, exact))
    records = spark.createDataFrame([(k,) for k in keys], "partition_key string")
    listed = spark.createDataFrame(shards, "shard_id string, start_hash string, end_hash string")
    got = {(r["partition_key"], r["shard_id"]) for r in x.route_by_hash_range(records, listed, digits=digits).collect()}
    assert got == {(k, i) for k in keys for i, lo, hi in shards if lo <= hashlib.md5(k.encode()).hexdigest() <= hi}


def test_dyadic_cover_is_exact_and_small(spark):
    draw, bits = random.Random(2), 8
    ranges = [(f"r{i}", *sorted(draw.randrange(256) for _ in range(2))) for i in range(100)] + [("all", 0, 255), ("none", 9, 8)]
    shards = spark.createDataFrame([(i, f"{a:02x}" + "0" * 30, f"{b:02x}" + "f" * 30) for i, a, b in ranges], "shard_id string, start_hash string, end_hash string")
    found = {}
    for row in x.dyadic_cover(shards, bits).collect():
        found.setdefault(row.shard_id, []).append(range(row.node << row.level, (row.node + 1) << row.level))
    for i, a, b in ranges:
        places = [p for block in found.get(i, []) for p in block]
        assert sorted(places) == list(range(a, b + 1)) and len(found.get(i, [])) <= 2 * bits
    assert len(found["all"]) == 1


def test_many_shards_are_one_candidate_per_prefix_length(spark):
    n = 100_000
    step = 2**128 // n
    edges = spark.range(n).selectExpr("id AS shard_id")
    # ranges that do not end at round prefixes
    limits = F.udf(lambda i: [f"{i * step:032x}", f"{(i + 1) * step - 1 if i < n - 1 else 2**128 - 1:032x}"], "array<string>")
    shards = edges.withColumn("r", limits("shard_id")).selectExpr("shard_id", "r[0] AS start_hash", "r[1] AS end_hash")
    records = spark.range(3000).selectExpr("cast(id AS string) AS partition_key")
    routed = x.route_by_hash_range(records, shards)
    wanted = {str(i): int(hashlib.md5(str(i).encode()).hexdigest(), 16) // step for i in range(3000)}
    assert {r.partition_key: min(r.shard_id, n - 1) for r in routed.collect()} == {k: min(v, n - 1) for k, v in wanted.items()}
    cover = x.dyadic_cover(shards, n.bit_length() + 2)
    # a prefix is in the cover of one shard, or of the two whose edge it holds
    most = cover.groupBy("level", "node").count().agg(F.max("count"), F.count("*")).first()
    assert most[0] <= 2 and most[1] < 20 * n
    assert x.route_by_hash_range(records, shards.limit(0)).count() == 0


def test_is_aggregated(spark):
    cases = [
        (framed(b"x"), True),
        (framed(b"hello world"), True),
        (MAGIC + hashlib.md5(b"").digest(), False),  # nothing but the digest behind the mark
        (framed(b"hello")[:-1] + b"\x00", False),
        (b"\x00" + framed(b"hello")[1:], False),
        (MAGIC, False),
        (b"", False),
        (None, False),
    ]
    df = spark.createDataFrame([(d, w) for d, w in cases], "data binary, want boolean")
    assert [r[0] for r in df.select(x.is_aggregated("data")).collect()] == [w for _, w in cases]


def test_deaggregate(spark):
    low, high = "0", str(2**128 - 1)
    items = [(0, 0, b"d0"), (1, 0, b"d1")]
    data = [
        ("half", "1", "p", framed(b"m"), None, ["a", "b"], [low], items),
        ("half", "2", "p", framed(b"m"), None, ["a", "b"], [low, high], [(0, 0, b"d0"), (1, 1, b"d1")]),
        ("half", "3", "p", b"plain", None, None, None, None),
        ("full", "4", "p", framed(b"m"), None, ["a", "b"], [low, high], [(1, None, b"d0"), (0, 1, b"d1")]),
    ]
    records = spark.createDataFrame(data, RECORDS)
    shards = spark.createDataFrame([("half", "0" * 32, "7" + "f" * 31), ("full", "0" * 32, "f" * 32)], "shard_id string, start_hash string, end_hash string")
    got = x.deaggregate(records, shards).orderBy("sequence_number", "sub_sequence").collect()
    assert [(r["sequence_number"], r["sub_sequence"], r["partition_key"], r["explicit_hash_key"], bytes(r["data"]), r["aggregated"]) for r in got] == [
        ("1", 0, "a", low, b"d0", True),
        ("1", 1, "b", low, b"d1", True),
        ("3", 0, "p", None, b"plain", False),
        ("4", 0, "b", None, b"d0", True),
        ("4", 1, "a", high, b"d1", True),
    ]
    assert x.deaggregate(records).count() == 7
