"""Every registered query has a SQL counterpart; a few are compared here, all of them by check.py."""

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check import TABLES, duck_rows, spark_rows
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMOKE_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "version", "message_count", "last_message"] and df.count() > 0


@pytest.mark.parametrize(
    "name",
    ["journal_fold_events", "after_checkpoint", "checkpoint_commit", "consumed_count", "deaggregate", "versioned_merge", "versioned_merge_ordered", "stale_keys"]
    + ["filter_any", "unpack_envelopes", "filter_stream", "unpack_stream", "route_by_hash_range", "scan_records_at_sequence_number", "union_queues"]
    + ["scan_state", "scan_state_limited", "lookup_key", "is_state_empty", "tracked_keys", "order_desc", "stream_observer"]
    + ["commit_merge", "commit_merge_outcomes", "diff_versions", "append_journal_versions", "order_keys_positions", "order_desc_positions"],
)
def test_query_equals_sql(spark, connection, name):
    assert spark_rows(queries()[name](spark, SMOKE_DIR)) == duck_rows(connection, oracle_sql()[name])


@pytest.mark.parametrize(
    "name",
    ["stream_journal", "stream_journal_versions", "append_journal_versions", "resume_stream", "process_batches", "publish_stream"],
)
def test_streams_read_tables_of_several_files(spark, connection, tmp_path, name):
    """A table may be a folder of files; as one file it is what the other tests read."""
    for table in ("events", "conversations"):
        spark.read.parquet(f"{SMOKE_DIR}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    expected = duck_rows(connection, oracle_sql()[name])
    assert spark_rows(queries()[name](spark, str(tmp_path))) == expected
    assert spark_rows(queries()[name](spark, SMOKE_DIR)) == expected
