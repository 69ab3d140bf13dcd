import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import state as s
from tidemark.operators import transitions

T0 = dt.datetime(2024, 1, 1)
TARGET = "key string, version long, owner string, amount long"
CHANGES = "key string, seq long, op string, expected_version long, expected_owner string, new_owner string, amount long"


def test_snapshot_diff_partitions_the_keys(spark, rows):
    old = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "key long, version long")
    new = spark.createDataFrame([(2, 2), (3, None), (4, 0)], "key long, version long")
    assert rows(s.snapshot_diff(old, new), "key", "status") == [(1, "removed"), (2, "changed"), (3, "unchanged"), (4, "added")]


def test_lists(spark, rows):
    def keys(*ks):
        return spark.createDataFrame([(k,) for k in ks], "key long")

    assert rows(s.shard_list_diff(keys(1, 2, 3), keys(1), keys(2))) == [(3,)]
    assert rows(s.tracked_keys(None, keys(1))) == [(1,)]
    assert rows(s.tracked_keys(keys(1), keys(1, 2))) == [(1,), (1,), (2,)]
    assert [r[0] for r in s.order_desc(keys(2, 9, 4)).collect()] == [9, 4, 2]


def apply_one(state, change):
    """What one change does to a (version, owner, amount) or None."""
    _, _, op, version, owner, new_owner, amount = change
    if op == "create":
        return (state is None, state or (0, new_owner, amount))
    if op == "delete":
        return (True, None)
    if state is None or (state[1] != owner if op == "evict" else state[0] != version):
        return (False, state)
    v, o, a = state
    return True, {"update": (v + 1, o, amount), "renew": (v + 1, o, a), "take": (v + 1, new_owner, a), "evict": (v + 1, None, a)}[op]


def test_merge_golden(spark, rows):
    target = spark.createDataFrame([("a", 3, "w", 1), ("b", 3, "w", 1), ("c", 3, "w", 1), ("d", 3, "w", 1), ("e", 3, None, 1), ("f", 3, "w", 1), ("g", 1, "w", 7)], TARGET)
    changes = spark.createDataFrame(
        [
            ("a", 0, "update", 3, None, None, 5),
            ("b", 0, "update", 2, None, None, 5),
            ("c", 0, "create", None, None, "x", 5),
            ("d", 0, "evict", None, "other", None, 5),
            ("e", 0, "evict", None, None, None, 5),
            ("f", 0, "delete", None, None, None, None),
            ("h", 0, "create", None, None, "x", 5),
            ("i", 0, "take", 0, None, "x", 5),
        ],
        CHANGES,
    )
    merged, outcomes = s.versioned_merge(target, changes, ["amount"])
    assert rows(outcomes, "key", "applied") == [("a", True), ("b", False), ("c", False), ("d", False), ("e", True), ("f", True), ("h", True), ("i", False)]
    assert rows(merged) == [("a", 4, "w", 5), ("b", 3, "w", 1), ("c", 3, "w", 1), ("d", 3, "w", 1), ("e", 4, None, 1), ("g", 1, "w", 7), ("h", 0, "x", 5)]


def test_unknown_operation_raises(spark):
    target = spark.createDataFrame([("a", 3, "w", 1)], TARGET)
    changes = spark.createDataFrame([("a", 0, "explode", 3, None, None, 5)], CHANGES)
    with pytest.raises(Exception, match="unknown operation"):
        s.versioned_merge(target, changes)


def test_several_changes_of_a_key_are_refused(spark):
    target = spark.createDataFrame([("a", 3, "w", 1)], TARGET)
    changes = spark.createDataFrame([("a", i, "renew", 3, None, None, 5) for i in range(2)], CHANGES)
    with pytest.raises(Exception, match="several changes of key a"):
        s.versioned_merge(target, changes)


@pytest.mark.parametrize("rows_per_range", [None, 30])
def test_ordered_merge_equals_a_fold(spark, rows, rows_per_range):
    rng = random.Random(11)
    ops = ["create", "update", "update", "renew", "take", "evict", "delete"]
    owners = ["w0", "w1", None]
    # one key holds most changes; numbers beyond 2^53 must survive
    changes = [
        (rng.choice("aaaab"), 2**60 + i, rng.choice(ops), rng.randrange(4), rng.choice(owners), rng.choice(["w0", "w1"]), 2**60 + i)
        for i in range(300)
    ]
    start = {"a": (1, "w0", 5), "z": (9, None, 2**60 + 1)}
    state, expected = dict(start), []
    for change in changes:
        applied, state[change[0]] = apply_one(state.get(change[0]), change)
        expected.append((change[0], change[1], change[2], applied))
    target = spark.createDataFrame([(k, *v) for k, v in start.items()], TARGET)
    merged, outcomes = s.versioned_merge_ordered(target, spark.createDataFrame(changes, CHANGES).repartition(3), "seq", ["amount"], rows_per_range)
    assert rows(outcomes) == sorted(expected)
    assert rows(merged) == sorted((k, *v) for k, v in state.items() if v)


OPS = ["create", "update", "update", "renew", "take", "evict", "delete"]


@pytest.mark.parametrize("seed", range(6))
def test_transitions_follow_every_state(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(transitions, "RUN", 7 if seed % 2 else 10_000)
    monkeypatch.setattr(transitions, "CELLS", 60 if seed % 3 == 0 else 1_000_000)
    for _ in range(60):
        owners = rng.sample(["a", "b", "c", None], rng.randint(1, 4))
        highest, ops = rng.choice([2, 4, 9]), rng.choice([OPS[:-1], ["evict", "update"], ["take", "evict", "renew"], ["create", "evict"]])
        made = [(rng.choice(ops), rng.choice([rng.randrange(highest), None]), rng.choice(owners), rng.choice(owners), 100 + i) for i in range(rng.randrange(1, 25))]
        if rng.random() < 0.2:
            made.append(("delete", None, None, None, 999))
        pieces = list(transitions.transitions(made))
        assert seed % 2 == 0 or len(made) <= 7 or len(pieces) > 1
        for start in [None, *[(v, o, None) for v in range(-3, highest + 3) for o in ["a", "b", "c", "d", None]]]:
            state = start
            for op, version, owner, new, name in made:
                _, state = apply_one(state, (None, None, op, version, owner, new, name))
            got = start
            for piece in pieces:
                got = transitions.Transition.unpacked(piece.packed()).follow(got)
            assert got == state, (made, start)


def one_hot_key(n, deletes=False):
    """A chain that goes on over the whole key: each change knows the state but for some that do not apply."""
    rng = random.Random(n)
    state, changes, expected = (5, "w0", 1), [], []
    for i in range(n):
        version, owner = (state[0], state[1]) if state and rng.random() < 0.8 else (rng.randrange(50), rng.choice(["w0", "w1", None]))
        op = rng.choice(OPS[:-1] if state else ["create", "update"])
        if deletes and rng.random() < 0.002:
            op = "delete"
        change = ("hot", i, op, version, owner, rng.choice(["w0", "w1", "w2"]), i)
        applied, state = apply_one(state, change)
        changes.append(change)
        expected.append(("hot", i, op, applied))
    return changes, expected, state


@pytest.mark.parametrize(("n", "deletes", "amount"), [(20_000, False, ["amount"]), (6_000, True, ["amount"]), (3_000, True, [])])
def test_a_hot_chain_runs_in_pieces(spark, rows, monkeypatch, n, deletes, amount):
    changes, expected, state = one_hot_key(n, deletes)
    target = spark.createDataFrame([("hot", 5, "w0", 1), ("cold", 1, None, 2)], TARGET)
    given = spark.createDataFrame([*changes, ("cold", 0, "renew", 1, None, None, 0)], CHANGES).repartition(4)
    seen = []
    cut = s._cut_at_ranges

    def kept(*args):
        result = cut(*args)
        seen.append(result[0].groupBy("key", "__chain", "__piece").count().agg(F.max("count"), F.count("*")).first())
        return result

    monkeypatch.setattr(s, "_cut_at_ranges", kept)
    merged, outcomes = s.versioned_merge_ordered(target, given, "seq", amount, rows_per_range=1000)
    assert rows(outcomes) == sorted([*expected, ("cold", 0, "renew", True)])
    assert rows(merged) == [("cold", 2, None, 2)[: 3 + len(amount)], *([("hot", *state)[: 3 + len(amount)]] if state else [])]
    largest, pieces = seen[0]
    # no piece is longer than two ranges
    assert largest <= 2000 and pieces > n // 2000


def test_null_keys_are_errors(spark):
    target = spark.createDataFrame([("a", 3, "w", 1)], TARGET)
    change = spark.createDataFrame([("a", 0, "renew", 3, None, None, 5)], CHANGES)
    no_key = spark.createDataFrame([(None, 0, "create", None, None, "x", 5)], CHANGES)
    no_target = spark.createDataFrame([(None, 3, "w", 1)], TARGET)
    for given, changes in ((target, no_key), (no_target, change)):
        for merge in (lambda t, c: s.versioned_merge(t, c, ["amount"]), lambda t, c: s.versioned_merge_ordered(t, c, "seq", ["amount"])):
            with pytest.raises(Exception, match="without key"):
                merged, outcomes = merge(given, changes)
                merged.collect()


def test_bursts_on_one_version_are_settled_in_parallel(spark, rows, monkeypatch):
    burst = [("a", 100 * v + i, "take", v, None, f"w{i}", 0) for v in range(3) for i in range(50)]
    repeats = [("a", 900 + i, "evict", None, "w0", None, 0) for i in range(5)] + [("a", 950 + i, "create", None, None, "x", 0) for i in range(5)]
    again = [("b", i, "evict", None, None, None, 0) for i in range(3)]  # no owner before and after: each applies
    seen = []
    walker = s._chain_walker
    monkeypatch.setattr(s, "_chain_walker", lambda payload: seen.append(payload) or walker(payload))
    target = spark.createDataFrame([("a", 0, "w", 1), ("b", 0, None, 1)], TARGET)
    merged, outcomes = s.versioned_merge_ordered(target, spark.createDataFrame(burst + repeats + again, CHANGES), "seq")
    assert rows(merged) == [("a", 4, None), ("b", 3, None)]
    applied = rows(outcomes.where("applied"), "key", "seq")
    assert applied == [("a", 0), ("a", 100), ("a", 200), ("a", 900), ("b", 0), ("b", 1), ("b", 2)]
    assert outcomes.count() == len(burst + repeats + again) and seen == [[]]


def scans(spark, data):
    return spark.createDataFrame([(k, n, T0 + dt.timedelta(seconds=t), o, v) for k, n, t, o, v in data], "key string, scan_order long, scan_ts timestamp_ntz, owner string, version long")


@pytest.mark.parametrize("rows_per_range", [None, 2])
def test_stale_keys(spark, rows, rows_per_range):
    data = [
        ("new", 1, 0, None, 1), ("new", 2, 1, "w", 1), ("new", 3, 2, "w", 2), ("new", 4, 3, "w", 2),
        ("own", 1, 0, "w", 1), ("own", 2, 10, "w", 1), ("own", 3, 10.001, "w", 1),
        ("gap", 1, 0, "w", 1), ("gap", 3, 20, "w", 1), ("gap", 4, 29, "w", 1),
    ]
    got = rows(s.stale_keys(scans(spark, data), 10, rows_per_range=rows_per_range), "key", "scan_order", "stale")
    assert got == [
        ("gap", 1, False), ("gap", 3, False), ("gap", 4, False),
        ("new", 1, True), ("new", 2, True), ("new", 3, False), ("new", 4, False),
        ("own", 1, False), ("own", 2, False), ("own", 3, True),
    ]


def test_a_year_is_stale_whatever_the_duration(spark, rows):
    data = [("k", 1, 0, "w", 1), ("k", 2, 365 * 86400, "w", 1), ("k", 3, 365 * 86400 + 1, "w", 1)]
    assert rows(s.stale_keys(scans(spark, data), 1e9), "scan_order", "stale") == [(1, False), (2, False), (3, True)]


@pytest.mark.parametrize("rows_per_range", [None, 3])
def test_owner_switches(spark, rows_per_range):
    data = [("k", i, o, c) for i, (o, c) in enumerate([("a", False), ("b", False), (None, False), ("c", False), ("a", False), ("b", True), ("c", False)])]
    history = spark.createDataFrame(data, "key string, scan_order long, owner string, done boolean")
    got = s.owner_switches(history, is_checkpoint=F.col("done"), rows_per_range=rows_per_range).orderBy("scan_order")
    assert [r["owner_switches"] for r in got.collect()] == [0, 1, 1, 1, 2, 0, 1]


def assignments(spark, loads, expired=0, free=0):
    data = [(o, False) for o, n in loads.items() for _ in range(n)] + [("x", True)] * expired + [(None, False)] * free
    return spark.createDataFrame(data, "owner string, expired boolean")


def owners(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "owner string")


def test_load_report(spark, rows):
    got = rows(s.load_report(assignments(spark, {"a": 4, "b": 3}), owners(spark, "c", "a")))
    assert got == [("a", 4, 3, 0, -1), ("b", 3, 3, 0, 0), ("c", 0, 3, 0, 3)]
    few = s.load_report(assignments(spark, {"a": 3}), owners(spark, "b", "c", "d", "e"))
    assert {r["target"] for r in few.collect()} == {1}
    capped = s.load_report(assignments(spark, {"a": 4, "b": 3}), max_per_owner=2).collect()
    assert {(r["target"], r["spillover"]) for r in capped} == {(2, 2)}
    # a cap applies only where there are fewer owners than rows
    assert {r["target"] for r in s.load_report(assignments(spark, {"a": 1}), max_per_owner=0).collect()} == {1}


def test_rebalance(spark, rows):
    report = s.load_report(assignments(spark, {"a": 9, "b": 1}), owners(spark, "c"))
    assert rows(s.rebalance_count(report, 0, 2), "owner", "needed", "take_moved", "moved_from") == [("a", 0, 0, None), ("b", 3, 2, "a"), ("c", 4, 2, "a")]
    level = s.load_report(assignments(spark, {"a": 2, "b": 2}, free=2), owners(spark, "c"))
    assert rows(s.rebalance_count(level), "owner", "take_moved", "moved_from") == [("a", 0, None), ("b", 0, None), ("c", 1, "a")]
    report = s.load_report(assignments(spark, {"a": 9, "b": 1}, expired=3), owners(spark, "c"))
    assert rows(s.rebalance_count(report, 3, 2), "owner", "needed", "take_expired", "take_moved") == [("a", 0, 0, 0), ("b", 4, 3, 0), ("c", 5, 3, 0)]


def test_null_operations_and_orders_are_errors(spark):
    target = spark.createDataFrame([(1, 5, "a")], "key long, version long, owner string")
    kind = "key long, op string, expected_version long, expected_owner string, new_owner string, at long"
    null_op = spark.createDataFrame([(1, None, None, None, None, 1)], kind)
    null_order = spark.createDataFrame([(1, "update", 5, None, None, None)], kind)
    with pytest.raises(Exception, match="unknown operation null"):
        s.versioned_merge(target, null_op.drop("at"))[0].collect()
    for changes in (null_op, null_order):
        with pytest.raises(Exception, match="a change without"):
            s.versioned_merge_ordered(target, changes, "at")[0].collect()
