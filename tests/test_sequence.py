import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import sequence as s

BIG = "49590338271490256608559692538361571095921575989136588898"
SENTINELS_LOW = [s.AT_TIMESTAMP, s.TRIM_HORIZON, s.LATEST]


def ordered(spark, pairs):
    df = spark.createDataFrame(list(pairs), "seq string, sub long")
    return [tuple(r) for r in df.orderBy(s.seq_key("seq", "sub")).collect()]


def test_golden_order(spark):
    expected = [(x, 0) for x in SENTINELS_LOW] + [("9", 0), ("10", 0), ("10", 1), (BIG, 0), (s.SHARD_END, 0)]
    assert ordered(spark, reversed(expected)) == expected


def test_leading_zeros_are_equal_and_shard_end_ignores_sub(spark):
    df = spark.createDataFrame([("01", 0, "1", 0), (s.SHARD_END, 3, s.SHARD_END, 0), ("0", 0, "000", 0)], "a string, x long, b string, y long")
    assert df.where(s.seq_key("a", "x") == s.seq_key("b", "y")).count() == 3


def test_sentinels_are_tied_by_sub_sequence(spark):
    assert ordered(spark, [(s.LATEST, 2), (s.LATEST, 1)]) == [(s.LATEST, 1), (s.LATEST, 2)]


@pytest.mark.parametrize("bad", ["abc", "", None, "-1", "1.5", "latest"])
def test_other_strings_raise(spark, bad):
    df = spark.createDataFrame([(bad,)], "seq string")
    with pytest.raises(Exception, match="expected digits or a sentinel"):
        df.select(s.seq_key("seq")).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 10**60), st.integers(0, 3)), min_size=2, max_size=40))
def test_order_is_that_of_integers(spark, numbers):
    got = ordered(spark, [(str(n), sub) for n, sub in numbers])
    assert [(int(n), sub) for n, sub in got] == sorted(numbers)


def test_validate_sequence(spark):
    cases = [("1", 0, True), ("1", -1, False), ("", 0, False), (None, 0, False), ("a", 0, False), ("1", None, False), (s.LATEST, 0, False)]
    df = spark.createDataFrame(cases, "seq string, sub long, want boolean")
    assert df.where(s.validate_sequence("seq", "sub") != F.col("want")).count() == 0


def test_initial_checkpoint(spark):
    df = spark.createDataFrame([(p,) for p in s.INITIAL_POSITIONS], "p string")
    assert [r[0] for r in df.select(s.initial_checkpoint("p")).collect()] == list(s.INITIAL_POSITIONS)
    with pytest.raises(Exception, match="no initial position"):
        spark.createDataFrame([("SHARD_END",)], "p string").select(s.initial_checkpoint("p")).collect()
