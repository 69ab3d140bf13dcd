import pytest

from tidemark.operators import journal


@pytest.fixture(scope="module")
def said(spark):
    return spark.createDataFrame(
        [(10, 2, "b"), (10, 1, "a"), (11, 5, "x"), (11, 7, None), (12, 1, "y")], "entity_id long, seq long, message string"
    )


def test_fold(said, rows):
    assert rows(journal.journal_fold(said)) == [(10, 2, 2, "b"), (11, 2, 2, None), (12, 1, 1, "y")]


@pytest.mark.parametrize("rows_per_range", [None, 1])
def test_versions(said, rows, rows_per_range):
    got = rows(journal.journal_versions(said, rows_per_range=rows_per_range), "entity_id", "seq", "version", "message_count", "line")
    assert got == [
        (10, 1, 1, 1, "User 10 (version 1) says: a"),
        (10, 2, 2, 2, "User 10 (version 2) says: b"),
        (11, 5, 1, 1, "User 11 (version 1) says: x"),
        (11, 7, 2, 2, "User 11 (version 2) says: "),
        (12, 1, 1, 1, "User 12 (version 1) says: y"),
    ]


def test_as_of(said, rows):
    assert rows(journal.journal_as_of(said, 1)) == [(10, 1, 1, "a"), (11, 1, 1, "x"), (12, 1, 1, "y")]
    assert rows(journal.journal_as_of(said, 9)) == rows(journal.journal_fold(said))
    with pytest.raises(ValueError):
        journal.journal_as_of(said, 0)


def test_last_message(said, rows):
    assert rows(journal.last_message(said)) == [(10, "User said b"), (11, None), (12, "User said y")]


def test_fold_shuffles_partial_aggregates_only(said):
    plan = journal.journal_fold(said)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
