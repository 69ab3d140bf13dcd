"""Input views over the given tables, in SQL that Spark and DuckDB both read.

Spark builds them from the parquet files, the SQL checks repeat them as CTEs. All of them read
whole tables. Conditions such as ``id % 11 <> 7`` give the data the gaps an operator is about (keys that
one snapshot lacks, nodes that are gone, undelivered messages).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("events", "conversations", "part", "orders")

# name -> (views and tables it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_records": (
        ("events",),
        """SELECT user_id % 8 AS shard_id, CAST(event_id * 7 + 1 AS STRING) AS sequence_number,
                  CAST(0 AS BIGINT) AS sub_sequence, CAST(user_id AS STRING) AS partition_key,
                  props AS data, ts AS arrival_ts
           FROM events""",
    ),
    "fx_checkpoints": (
        ("events",),
        """SELECT user_id % 8 AS shard_id, CAST(MAX(event_id * 7 + 1) AS STRING) AS sequence_number,
                  CAST(0 AS BIGINT) AS sub_sequence
           FROM events WHERE user_id % 8 < 5 AND ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id % 8
           UNION ALL SELECT CAST(6 AS BIGINT), 'TRIM_HORIZON', CAST(0 AS BIGINT)
           UNION ALL SELECT CAST(7 AS BIGINT), 'SHARD_END', CAST(0 AS BIGINT)""",
    ),
    "fx_prior": (
        ("events",),
        """SELECT user_id % 8 AS shard_id,
                  CAST(CASE WHEN user_id % 8 = 2 THEN MAX(event_id) * 70 ELSE MIN(event_id) * 7 + 1 END AS STRING)
                      AS sequence_number,
                  CAST(0 AS BIGINT) AS sub_sequence
           FROM events WHERE user_id % 8 <> 4 GROUP BY user_id % 8""",
    ),
    "fx_progress": (
        ("events",),
        """SELECT user_id % 8 AS shard_id, CAST(MAX(event_id * 7 + 1) AS STRING) AS sequence_number,
                  CAST(0 AS BIGINT) AS sub_sequence, MAX(ts) AS processed_ts
           FROM events WHERE user_id % 8 <> 7 AND ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY user_id % 8""",
    ),
    "fx_shards": (
        ("events",),
        """SELECT user_id % 8 AS shard_id,
                  CASE user_id % 8 WHEN 0 THEN CAST(MIN(event_id) * 7 + 1 AS STRING)
                                   WHEN 2 THEN CAST(MAX(event_id) * 7 + 1 AS STRING)
                                   WHEN 4 THEN '90' WHEN 7 THEN '5' END AS end_seq
           FROM events GROUP BY user_id % 8""",
    ),
    "fx_hash_shards": (
        ("events",),
        """SELECT user_id % 8 AS shard_id,
                  concat(substr('02468ace', CAST(user_id % 8 AS INT) + 1, 1), repeat('0', 31)) AS start_hash,
                  concat(substr('13579bdf', CAST(user_id % 8 AS INT) + 1, 1), repeat('f', 31)) AS end_hash
           FROM events GROUP BY user_id % 8
           UNION ALL SELECT CAST(100 AS BIGINT), concat('3', repeat('0', 31)), concat('a', repeat('8', 31))""",
    ),
    "fx_requests": (
        ("events",),
        """SELECT user_id % 8 AS shard_id, event_id AS request_order,
                  CASE WHEN event_id % 4999 = 4998 THEN NULL
                       ELSE CAST(CAST(FLOOR(event_id / 2.0) AS BIGINT) + (event_id * 37) % 101 AS STRING) END
                      AS sequence_number,
                  event_id % 3 AS sub_sequence
           FROM events""",
    ),
    "fx_commit_state": (
        ("events",),
        """SELECT user_id % 8 AS shard_id, '50' AS last_sequence, CAST(1 AS BIGINT) AS last_sub,
                  CAST(CAST(FLOOR(MAX(event_id) / 3.0) AS BIGINT) + 60 AS STRING) AS mark_sequence,
                  CAST(0 AS BIGINT) AS mark_sub,
                  CASE WHEN user_id % 8 IN (0, 2, 4) THEN CAST(CAST(FLOOR(MAX(event_id) / 3.0) AS BIGINT) + 60 AS STRING)
                       END AS end_sequence
           FROM events WHERE user_id % 8 <> 5 GROUP BY user_id % 8""",
    ),
    "fx_journal": (
        ("conversations",),
        "SELECT conv_id AS entity_id, turn AS seq, role, text AS message FROM conversations",
    ),
    "fx_subscriptions": (
        ("events",),
        """SELECT concat('c', CAST(event_id % 20 AS STRING)) AS consumer, user_id AS stream_id, ts AS start_ts,
                  CASE event_id % 5 WHEN 1 THEN ts + INTERVAL '1' DAY WHEN 2 THEN ts + INTERVAL '3' DAY
                                    WHEN 3 THEN ts + INTERVAL '9' DAY WHEN 4 THEN ts - INTERVAL '1' DAY END AS stop_ts
           FROM events WHERE event_type = 'signup'
           UNION ALL SELECT 'idle', CAST(-1 AS BIGINT), MIN(ts), NULL FROM events""",
    ),
    "fx_pending": (("events",), "SELECT user_id % 9 AS queue_id, event_id AS token FROM events"),
    "fx_delivered": (
        ("events",),
        """SELECT user_id % 9 AS queue_id, event_id AS token FROM events
           WHERE event_id % 10 <> 3 AND user_id % 9 <> 8 AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
    ),
    "fx_op_log": (
        ("events",),
        "SELECT event_id AS op_id, event_type AS operation, ts AS started, value * 100 AS duration_ms FROM events",
    ),
    "fx_nodes": (
        ("part",),
        """SELECT e.id, e.parent_id, e.adjacent_parent_id, CAST(e.id * 10 AS STRING) AS start_seq,
                  CASE WHEN p.id IS NOT NULL THEN CAST(e.id * 10 + 9 AS STRING) END AS end_seq,
                  lpad(CAST(e.pos * e.width AS STRING), 32, '0') AS start_hash,
                  lpad(CAST(e.pos * e.width + e.width - 1 AS STRING), 32, '0') AS end_hash
           FROM (SELECT id, CASE WHEN id >= 2 THEN CAST(FLOOR(id / 2.0) AS BIGINT) END AS parent_id,
                        CASE WHEN id >= 5 AND id % 5 = 0 THEN CAST(FLOOR(id / 2.0) AS BIGINT) + 1 END AS adjacent_parent_id,
                        id - CAST(POWER(2, length(bin(id)) - 1) AS BIGINT) AS pos,
                        CAST(POWER(2, 41 - length(bin(id))) AS BIGINT) AS width
                 FROM (SELECT CAST(p_partkey AS BIGINT) AS id FROM (SELECT p_partkey + 1 AS p_partkey FROM part) q1) n) e
           LEFT JOIN (SELECT DISTINCT id FROM (
                        SELECT CAST(FLOOR(p_partkey / 2.0) AS BIGINT) AS id FROM (SELECT p_partkey + 1 AS p_partkey FROM part) q2 WHERE p_partkey >= 2
                        UNION ALL SELECT CAST(FLOOR(p_partkey / 2.0) AS BIGINT) + 1 FROM (SELECT p_partkey + 1 AS p_partkey FROM part) q3
                                  WHERE p_partkey >= 5 AND p_partkey % 5 = 0) q) p
           ON e.id = p.id""",
    ),
    # a listing torn by a reshard: some parents look open, some nodes are gone
    "fx_torn_nodes": (
        ("fx_nodes",),
        """SELECT id, parent_id, adjacent_parent_id, start_seq, CASE WHEN id % 4 <> 1 THEN end_seq END AS end_seq,
                  start_hash, CASE WHEN id % 9 = 0 THEN start_hash ELSE end_hash END AS end_hash
           FROM fx_nodes WHERE id % 11 <> 7""",
    ),
    "fx_closed_ids": (
        ("fx_nodes",),
        "SELECT id FROM fx_nodes WHERE id % 3 = 0 OR id % 4 = 1 UNION ALL SELECT -id FROM fx_nodes WHERE id % 5 = 0",
    ),
    "fx_tracked": (
        ("fx_nodes",),
        """SELECT id, CASE WHEN id % 2 = 0 THEN 'SHARD_END' WHEN id % 3 = 0 THEN 'TRIM_HORIZON'
                           WHEN id % 5 = 0 THEN NULL ELSE CAST(id * 10 + 1 AS STRING) END AS checkpoint
           FROM fx_nodes WHERE id % 7 = 3 OR id % 5 < 3""",
    ),
    "fx_some_tracked": (("fx_nodes",), "SELECT id FROM fx_nodes WHERE id % 7 = 3 AND id > 20"),
    "fx_key_rows": (
        ("fx_nodes",),
        """SELECT CASE WHEN id % 4 = 0 THEN id + 1000000000 WHEN id % 4 = 1 THEN id + 2000000000 ELSE id END AS key,
                  CASE WHEN id % 4 = 1 THEN -id ELSE parent_id END AS parent_a,
                  CASE WHEN id % 4 = 1 THEN NULL ELSE adjacent_parent_id END AS parent_b
           FROM fx_nodes""",
    ),
    "fx_history": (
        ("events",),
        """SELECT user_id AS key, event_id AS scan_order, ts AS scan_ts,
                  CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS owner, event_type = 'signup' AS is_checkpoint
           FROM events""",
    ),
    # one scan per day: the last state of every user that did something that day
    "fx_scans": (
        ("events",),
        """SELECT d.key, d.scan_order, e.ts AS scan_ts, CASE WHEN e.event_type = 'view' THEN NULL ELSE e.event_type END AS owner,
                  CAST(SUM(d.n) OVER (PARTITION BY d.key ORDER BY d.scan_order) AS BIGINT) AS version
           FROM (SELECT user_id AS key, CAST(EXTRACT(DOY FROM ts) AS BIGINT) AS scan_order, MAX(event_id) AS last_event,
                        SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS n
                 FROM events GROUP BY user_id, CAST(EXTRACT(DOY FROM ts) AS BIGINT)) d
           JOIN events e ON e.event_id = d.last_event""",
    ),
    "fx_versions": (
        ("events",),
        """SELECT user_id AS key, ts AS scan_ts, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS owner,
                  CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version
           FROM events""",
    ),
    "fx_state": (
        ("orders",),
        """SELECT o_orderkey AS key, o_orderkey % 3 AS version,
                  CASE WHEN o_orderstatus <> 'P' THEN concat('w', CAST(o_custkey % 5 AS STRING)) END AS owner,
                  o_totalprice AS amount
           FROM orders""",
    ),
    "fx_new_state": (("orders",), "SELECT -1 - o_orderkey AS key, o_orderkey % 5 AS version FROM orders"),
    "fx_snapshot_old": (
        ("orders",),
        "SELECT o_orderkey AS key, o_orderkey % 3 AS version FROM orders WHERE o_orderkey % 11 <> 0",
    ),
    "fx_snapshot_new": (
        ("orders",),
        """SELECT o_orderkey AS key, o_orderkey % 3 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS version
           FROM orders WHERE o_orderkey % 13 <> 0""",
    ),
    "fx_target": (
        ("orders",),
        """SELECT o_orderkey AS key, o_orderkey % 3 AS version,
                  CASE WHEN o_orderstatus <> 'P' THEN concat('w', CAST(o_custkey % 5 AS STRING)) END AS owner,
                  o_totalprice AS amount
           FROM orders WHERE o_orderkey % 11 <> 0""",
    ),
    "fx_changes": (
        ("orders",),
        """SELECT o_orderkey AS key,
                  CASE o_orderkey % 7 WHEN 0 THEN 'create' WHEN 1 THEN 'update' WHEN 2 THEN 'renew' WHEN 3 THEN 'take'
                                      WHEN 4 THEN 'evict' WHEN 5 THEN 'delete' ELSE 'create' END AS op,
                  o_custkey % 3 AS expected_version,
                  CASE WHEN o_custkey % 2 = 0 THEN concat('w', CAST(o_custkey % 5 AS STRING)) END AS expected_owner,
                  concat('n', CAST(o_custkey % 4 AS STRING)) AS new_owner, o_totalprice * 2 AS amount
           FROM orders WHERE o_orderkey % 13 <> 0""",
    ),
    "fx_user_target": (
        ("events",),
        """SELECT user_id AS key, MIN(event_id) % 3 AS version, 'w0' AS owner, MIN(event_id) AS amount
           FROM events WHERE user_id % 3 <> 0 GROUP BY user_id""",
    ),
    "fx_user_changes": (
        ("events",),
        """SELECT user_id AS key, event_id AS seq,
                  CASE WHEN event_id % 17 = 0 THEN 'delete' WHEN event_type = 'signup' THEN 'create'
                       WHEN event_type = 'view' THEN 'renew' WHEN event_type = 'click' THEN 'take'
                       WHEN event_type = 'error' THEN 'evict' ELSE 'update' END AS op,
                  event_id % 4 AS expected_version, CASE WHEN event_id % 3 > 0 THEN concat('w', CAST(event_id % 2 AS STRING)) END
                      AS expected_owner,
                  concat('w', CAST(event_id % 2 AS STRING)) AS new_owner, event_id AS amount
           FROM events""",
    ),
    "fx_assignments": (
        ("events",),
        """SELECT event_id AS item, CASE WHEN event_id % 50 <> 0 THEN concat('w', CAST(user_id % 5 + user_id % 2 AS STRING)) END
                      AS owner, event_type = 'error' AS expired
           FROM events""",
    ),
    "fx_owners": (("events",), "SELECT DISTINCT concat('w', CAST(user_id % 8 AS STRING)) AS owner FROM events"),
    "fx_batches": (
        ("events",),
        """SELECT CAST(FLOOR(event_id / 4.0) AS BIGINT) AS batch, event_id % 4 AS place, user_id, props,
                  CASE WHEN event_id % 7 = 0 THEN '340282366920938463463374607431768211455'
                       WHEN event_id % 7 = 1 THEN '0' END AS explicit_hash_key, ts
           FROM events""",
    ),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        if name in VIEWS:
            for needed in (*_closure(VIEWS[name][0]), name):
                if needed not in ordered:
                    ordered.append(needed)
    return ordered


def _tables(names: list[str]) -> list[str]:
    return [t for t in BASE_TABLES if any(t in VIEWS[n][0] for n in names)]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    names = _closure((name,))
    tables = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in _tables(names)]
    ctes = tables + [f"{n} AS ({VIEWS[n][1]})" for n in names]
    return spark.sql(f"WITH {', '.join(ctes)} SELECT * FROM {name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(names: tuple[str, ...], body: str, recursive: bool = False) -> str:
    """SQL whose CTEs are the named views followed by ``body``, which may start with more CTEs."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in _closure(names))
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{body}"
