import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.sequence import AT_TIMESTAMP, LATEST, SHARD_END, TRIM_HORIZON
from tidemark.operators import lineage as li

NODES = "id string, parent_id string, adjacent_parent_id string, start_seq string, end_seq string, start_hash string, end_hash string"


def nodes_of(spark, parents, open_ids):
    data = [
        (i, (p + [None, None])[0], (p + [None, None])[1], str(n * 7), None if i in open_ids else str(n * 7 + 6), None, None)
        for n, (i, p) in enumerate(parents.items())
    ]
    return spark.createDataFrame(data, NODES)


@pytest.fixture(scope="module")
def reshard(spark):
    parents = {str(i): [] for i in range(6)}
    parents |= {"6": ["0", "1"], "7": ["2", "3"], "8": ["6", "7"], "9": ["5"], "10": ["5"]}
    return nodes_of(spark, parents, {"4", "8", "9", "10"}).cache()


ALL = [str(i) for i in range(11)]


@pytest.mark.parametrize(
    "tracked,position,expected",
    [
        (["3", "4", "5"], LATEST, {"2": LATEST, "6": LATEST, "7": TRIM_HORIZON, "8": TRIM_HORIZON, "9": TRIM_HORIZON, "10": TRIM_HORIZON}),
        (["3", "4", "5"], TRIM_HORIZON, dict.fromkeys(["0", "1", "2", "6", "7", "8", "9", "10"], TRIM_HORIZON)),
        (["3", "4", "5"], AT_TIMESTAMP, dict.fromkeys(["0", "1", "2", "6", "7", "8", "9", "10"], AT_TIMESTAMP)),
        ([], LATEST, dict.fromkeys(["4", "8", "9", "10"], LATEST)),
        ([], TRIM_HORIZON, dict.fromkeys(ALL, TRIM_HORIZON)),
        ([], AT_TIMESTAMP, dict.fromkeys(ALL, AT_TIMESTAMP)),
    ],
)
def test_reshard_example(spark, reshard, tracked, position, expected):
    keys = spark.createDataFrame([(t,) for t in tracked], "id string")
    plan = li.lineage_backfill_plan(reshard, keys, position).collect()
    assert {r["id"]: r["checkpoint"] for r in plan} == expected
    # fixture ids rise with the starting sequence number
    assert [int(r["id"]) for r in plan] == sorted(int(r["id"]) for r in plan)


def reach(start, step):
    found, todo = set(start), list(start)
    while todo:
        for n in step(todo.pop()):
            if n not in found:
                found.add(n)
                todo.append(n)
    return found


def expected_plan(parents, open_ids, tracked, position):
    up = {c: [p for p in ps if p in parents] for c, ps in parents.items()}
    down = {p: [c for c in up if p in up[c]] for p in parents}
    read = reach(tracked & set(parents), lambda n: down[n]) if position == LATEST else set(parents)
    visited = reach(open_ids - tracked, lambda n: [p for p in up[n] if p not in tracked])
    new = (open_ids - tracked) | {
        p for c in visited if any(q in read for q in up[c]) for p in up[c] if p not in tracked
    }
    if position == AT_TIMESTAMP:
        return dict.fromkeys(new, AT_TIMESTAMP)
    return {n: TRIM_HORIZON if n in read else position for n in new}


@pytest.mark.parametrize("seed,position", [(1, LATEST), (3, TRIM_HORIZON)])
def test_backfill_on_random_graphs(spark, seed, position):
    rng = random.Random(seed)
    # parent ids include ones that are gone
    parents = {str(i): [str(p) for p in rng.sample(range(-2, max(i, 1)), k=min(i, rng.choice([0, 1, 1, 2])))] for i in range(30)}
    open_ids = {i for i in parents if not any(i in ps for ps in parents.values())}
    tracked = set(rng.sample(sorted(parents), 4)) | {"gone"}
    keys = spark.createDataFrame([(t,) for t in tracked], "id string")
    plan = li.lineage_backfill_plan(nodes_of(spark, parents, open_ids), keys, position).collect()
    assert {r["id"]: r["checkpoint"] for r in plan} == expected_plan(parents, open_ids, tracked, position)


def test_closure(spark, reshard):
    def closure(seeds, direction):
        found = li.lineage_closure(reshard, spark.createDataFrame([(s,) for s in seeds], "id string"), direction)
        return {r["id"]: r["depth"] for r in found.collect()}

    assert closure(["0", "5", "none"], "descendants") == {"0": 0, "6": 1, "8": 2, "5": 0, "9": 1, "10": 1}
    assert closure(["8", "6"], "ancestors") == {"8": 0, "6": 0, "7": 1, "0": 1, "1": 1, "2": 2, "3": 2}
    with pytest.raises(ValueError):
        closure(["0"], "sideways")


def test_long_chain(spark):
    parents = {str(i): [str(i - 1)] if i else [] for i in range(7)}
    chain = nodes_of(spark, parents, {"6"})
    found = li.lineage_closure(chain, spark.createDataFrame([("0",)], "id string"), "descendants")
    assert {r["id"]: r["depth"] for r in found.collect()} == {str(i): i for i in range(7)}


def test_edges_and_torn_listing(spark, reshard, rows):
    torn = reshard.where("id <> '0'").withColumn("end_seq", F.when(F.col("id") != "7", F.col("end_seq")))
    assert ("0", "6") not in rows(li.children_of(torn)) and ("1", "6") in rows(li.children_of(torn))
    assert rows(li.unclosed_parents(torn)) == [("7",)]
    assert rows(li.unclosed_parents(reshard)) == []
    assert rows(li.open_shards(reshard), "id") == [("10",), ("4",), ("8",), ("9",)]
    twice = nodes_of(spark, {"a": [], "b": ["a", "a"]}, {"b"})
    assert rows(li.children_of(twice)) == [("a", "b")]


def test_hash_coverage(spark, rows):
    data = [
        ("a", None, None, "1", "2", "10", "4f"),
        ("a1", "a", None, "3", None, "10", "2f"),
        ("a2", "a", None, "3", None, "40", "4f"),  # the gap 30-3f does not count
        ("b", None, None, "1", "2", "50", "6f"),
        ("b1", "b", None, "3", None, "51", "6f"),
        ("c", None, None, "1", "2", "70", "7f"),
    ]
    nodes = spark.createDataFrame(data, NODES)
    closed = spark.createDataFrame([("a",), ("b",), ("c",), ("a1",), ("zz",)], "id string")
    assert rows(li.hash_coverage(nodes, closed)) == [
        ("a", "covered"), ("a1", "not closed"), ("b", "not covered"), ("c", "no children"), ("zz", "absent"),
    ]


def test_dependency_gate(spark, reshard):
    state = spark.createDataFrame([("0", SHARD_END), ("1", None), ("2", SHARD_END), ("5", "12")], "key string, checkpoint string")
    ready = {r["id"] for r in li.dependency_gate(reshard, state).where("ready").collect()}
    assert ready == set(ALL) - {"6", "9", "10"}


def test_garbage_and_finished_keys(spark, reshard, rows):
    state = spark.createDataFrame([("8", ["6"]), ("20", ["8", "x"]), ("21", ["x"]), ("22", [])], "key string, parents array<string>")
    assert rows(li.garbage_keys(state, reshard)) == [("20", "inconsistent"), ("21", "delete"), ("22", "delete"), ("8", "keep")]
    marks = [("0", SHARD_END), ("1", "5"), ("6", "3"), ("2", SHARD_END), ("7", TRIM_HORIZON), ("5", SHARD_END), ("9", "1"), ("8", SHARD_END)]
    tracked = spark.createDataFrame(marks, "key string, checkpoint string")
    # 0: its child has begun; 2: its child has not; 5: child 10 has no row; 8: no children
    assert rows(li.finished_keys(tracked, li.children_of(reshard))) == [("0",)]


def test_order_keys(spark):
    nodes = spark.createDataFrame([("a", None, None, "100", None, None, None), ("b", None, None, "9", None, None, None), ("c", None, None, "9", None, None, None)], NODES)
    state = spark.createDataFrame([(k,) for k in ["zz", "a", "c", "b"]], "key string")
    assert [r[0] for r in li.order_keys(state, nodes).collect()] == ["b", "c", "a", "zz"]
