"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from registry.views import with_views

RECORD_COLUMNS = "shard_id, sequence_number, partition_key, arrival_ts"


def _q(names: tuple[str, ...], body: str, recursive: bool = False) -> str:
    return with_views(names, "\n" + body, recursive)


def _queue(key: str, n: int) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT) % {n}"


EDGES = """, edges AS (
  SELECT DISTINCT p.id AS parent, c.id AS child FROM {nodes} c JOIN {nodes} p
  ON p.id = c.parent_id OR p.id = c.adjacent_parent_id)"""

CHAIN = """, changes AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS rn FROM fx_user_changes),
users AS (SELECT key FROM fx_user_changes UNION SELECT key FROM fx_user_target),
fold AS (
  SELECT u.key, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS BOOLEAN) AS applied,
         t.key IS NOT NULL AS alive, t.version, CAST(t.owner AS VARCHAR) AS owner, t.amount
  FROM users u LEFT JOIN fx_user_target t ON t.key = u.key
  UNION ALL
  SELECT key, rn, seq, op, ok,
         CASE WHEN NOT ok THEN alive ELSE op <> 'delete' END,
         CASE WHEN NOT ok THEN version WHEN op = 'create' THEN 0 WHEN op = 'delete' THEN NULL ELSE version + 1 END,
         CASE WHEN NOT ok THEN owner WHEN op IN ('create', 'take') THEN new_owner WHEN op IN ('evict', 'delete') THEN NULL ELSE owner END,
         CASE WHEN NOT ok THEN amount WHEN op IN ('create', 'update') THEN new_amount WHEN op = 'delete' THEN NULL ELSE amount END
  FROM (SELECT f.key, c.rn, c.seq, c.op, f.alive, f.version, f.owner, f.amount, c.new_owner, c.amount AS new_amount,
               CASE c.op WHEN 'create' THEN NOT f.alive WHEN 'delete' THEN TRUE
                         WHEN 'evict' THEN f.alive AND f.owner IS NOT DISTINCT FROM c.expected_owner
                         ELSE f.alive AND f.version = c.expected_version END AS ok
        FROM fold f JOIN changes c ON c.key = f.key AND c.rn = f.rn + 1) s)"""

COMMIT = """, q AS (
  SELECT r.shard_id, r.request_order, s.shard_id IS NOT NULL AS known,
         CAST(coalesce(r.sequence_number, s.mark_sequence) AS BIGINT) AS seq,
         CASE WHEN r.sequence_number IS NULL THEN s.mark_sub ELSE r.sub_sequence END AS sub,
         r.sequence_number IS NULL AS unchecked,
         CAST(s.mark_sequence AS BIGINT) AS mark, s.mark_sub, CAST(s.end_sequence AS BIGINT) AS fin,
         CAST(s.last_sequence AS BIGINT) AS first_seq, s.last_sub AS first_sub,
         row_number() OVER (PARTITION BY r.shard_id ORDER BY r.request_order) AS rn
  FROM fx_requests r LEFT JOIN fx_commit_state s ON s.shard_id = r.shard_id),
walk AS (
  SELECT shard_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS request_order, CAST(NULL AS VARCHAR) AS outcome,
         CAST(NULL AS BIGINT) AS rec_seq, CAST(NULL AS BIGINT) AS rec_sub, FALSE AS at_end, first_seq AS last_seq, first_sub AS last_sub
  FROM q WHERE rn = 1
  UNION ALL
  SELECT shard_id, rn, request_order, outcome,
         CASE WHEN outcome <> 'accepted' THEN NULL WHEN is_end THEN -2 ELSE seq END,
         CASE WHEN outcome <> 'accepted' THEN NULL WHEN is_end THEN 0 ELSE sub END,
         CASE WHEN outcome = 'accepted' THEN is_end ELSE at_end END,
         CASE WHEN outcome = 'accepted' THEN seq ELSE last_seq END,
         CASE WHEN outcome = 'accepted' THEN sub ELSE last_sub END
  FROM (SELECT q.shard_id, q.rn, q.request_order, q.seq, q.sub, w.at_end, w.last_seq, w.last_sub,
               coalesce(q.seq = q.fin AND q.sub = 0, FALSE) AS is_end,
               CASE WHEN NOT q.known THEN 'rejected'
                    WHEN NOT w.at_end AND q.seq = w.last_seq AND q.sub = w.last_sub THEN 'no-op'
                    WHEN q.unchecked THEN 'accepted'
                    WHEN NOT w.at_end AND (w.last_seq, w.last_sub) <= (q.seq, q.sub) AND (q.seq, q.sub) <= (q.mark, q.mark_sub)
                    THEN 'accepted' ELSE 'rejected' END AS outcome
        FROM walk w JOIN q ON q.shard_id = w.shard_id AND q.rn = w.rn + 1) s)
SELECT shard_id, request_order, outcome,
       CASE WHEN rec_seq IS NULL THEN '' WHEN rec_seq = -2 THEN 'SHARD_END' ELSE CAST(rec_seq AS VARCHAR) END AS recorded_sequence,
       coalesce(rec_sub, -1) AS recorded_sub
FROM walk WHERE rn > 0"""

LONG_NUMBERS = """WITH numbers AS (
  SELECT event_id, user_id, event_id % 5 AS sub,
         CASE event_id % 40 WHEN 1 THEN 'AT_TIMESTAMP' WHEN 2 THEN 'TRIM_HORIZON' WHEN 3 THEN 'LATEST' WHEN 4 THEN 'SHARD_END'
         ELSE CASE WHEN event_id % 3 = 0 THEN '00' ELSE '' END || CAST(event_id * 7 + 1 AS VARCHAR)
              || repeat(CAST(event_id % 10 AS VARCHAR), user_id % 50) END AS seq
  FROM events),
keys AS (
  SELECT *, CASE seq WHEN 'AT_TIMESTAMP' THEN -3 WHEN 'TRIM_HORIZON' THEN -2 WHEN 'LATEST' THEN -1 WHEN 'SHARD_END' THEN 1 ELSE 0 END AS r,
         CASE WHEN seq SIMILAR TO '[0-9]+' THEN ltrim(seq, '0') ELSE '' END AS d FROM numbers)
"""


def _backfill(position: str) -> str:
    read = (
        """read_ids AS (SELECT n.id FROM fx_nodes n JOIN fx_some_tracked t ON t.id = n.id
  UNION SELECT e.child FROM read_ids r JOIN edges e ON e.parent = r.id)"""
        if position == "LATEST"
        else "read_ids AS (SELECT id FROM fx_nodes)"
    )
    start = "'AT_TIMESTAMP'" if position == "AT_TIMESTAMP" else f"CASE WHEN r.id IS NOT NULL THEN 'TRIM_HORIZON' ELSE '{position}' END"
    body = f"""{EDGES.format(nodes="fx_nodes")}, {read},
visited AS (
  SELECT id FROM fx_nodes WHERE end_seq IS NULL AND id NOT IN (SELECT id FROM fx_some_tracked)
  UNION SELECT e.parent FROM visited v JOIN edges e ON e.child = v.id WHERE e.parent NOT IN (SELECT id FROM fx_some_tracked)),
joining AS (
  SELECT DISTINCT e.child FROM edges e JOIN visited v ON v.id = e.child JOIN read_ids r ON r.id = e.parent),
started AS (
  SELECT id FROM fx_nodes WHERE end_seq IS NULL AND id NOT IN (SELECT id FROM fx_some_tracked)
  UNION SELECT e.parent FROM edges e JOIN joining j ON j.child = e.child WHERE e.parent NOT IN (SELECT id FROM fx_some_tracked))
SELECT s.id, {start} AS checkpoint FROM started s LEFT JOIN (SELECT DISTINCT id FROM read_ids) r ON r.id = s.id"""
    return with_views(("fx_nodes", "fx_some_tracked"), body, recursive=True)


def _closure(parent: str, child: str) -> str:
    body = f"""{EDGES.format(nodes="fx_nodes")}, reach AS (
  SELECT n.id, 0 AS depth FROM fx_nodes n JOIN fx_some_tracked t ON t.id = n.id
  UNION SELECT e.{child}, r.depth + 1 FROM reach r JOIN edges e ON e.{parent} = r.id)
SELECT id, CAST(MIN(depth) AS INTEGER) AS depth FROM reach GROUP BY id"""
    return with_views(("fx_nodes", "fx_some_tracked"), body, recursive=True)


def _load(expired: str, cap: str) -> str:
    return f""", loads AS (
  SELECT o.owner, COUNT(a.item) AS load
  FROM (SELECT owner FROM fx_owners UNION SELECT owner FROM fx_assignments WHERE NOT {expired} AND owner IS NOT NULL) o
  LEFT JOIN fx_assignments a ON a.owner = o.owner AND NOT {expired} GROUP BY o.owner),
totals AS (SELECT (SELECT COUNT(*) FROM fx_assignments) AS n_items, (SELECT COUNT(*) FROM loads) AS k),
report AS (
  SELECT owner, load, CAST(CASE WHEN k >= n_items THEN 1 ELSE least((n_items + k - 1) // k, {cap}) END AS BIGINT) AS target,
         CAST(CASE WHEN k >= n_items THEN 0 ELSE greatest((n_items + k - 1) // k - {cap}, 0) END AS BIGINT) AS spillover
  FROM loads, totals)"""


NO_CAP = "9223372036854775807"

JOURNAL_STATE = """SELECT {e} AS {name}, COUNT(*) AS version, COUNT(*) AS message_count, arg_max({m}, {o}) AS last_message
FROM {t} GROUP BY {e}"""

DEAGGREGATED = """, ranges AS (
  SELECT shard_id, {low} AS lo, {high} AS hi FROM fx_hash_shards),
items AS (
  SELECT CASE WHEN batch % 2 = 0 THEN 100 ELSE batch % 8 END AS shard_id, batch, place, CAST(user_id AS VARCHAR) AS pk,
         explicit_hash_key, props, ts,
         CASE WHEN explicit_hash_key = '0' THEN repeat('0', 32) WHEN explicit_hash_key IS NOT NULL THEN repeat('f', 32)
              ELSE md5(CAST(user_id AS VARCHAR)) END AS h
  FROM fx_batches),
batches AS (
  SELECT i.shard_id, i.batch, MAX(i.ts) AS arrival_ts, CAST(SUM(strlen(i.props)) AS BIGINT) AS size, i.batch % 4 IN (0, 1) AS aggregated,
         bool_and(coalesce(i.h >= r.lo AND i.h <= r.hi, TRUE)) AS inside
  FROM items i LEFT JOIN ranges r ON r.shard_id = i.shard_id GROUP BY i.shard_id, i.batch)
SELECT CAST(b.shard_id AS BIGINT) AS shard_id, CAST(b.batch AS VARCHAR) AS sequence_number, i.place AS sub_sequence, i.pk AS partition_key,
       coalesce(i.explicit_hash_key, '') AS explicit_hash_key, CAST(strlen(i.props) AS BIGINT) AS n_bytes, b.arrival_ts, TRUE AS aggregated
FROM batches b JOIN items i ON i.batch = b.batch WHERE b.aggregated AND b.inside
UNION ALL
SELECT CAST(shard_id AS BIGINT), CAST(batch AS VARCHAR), 0, 'outer', '', CASE WHEN batch % 4 = 3 THEN size + 20 ELSE size END, arrival_ts, FALSE
FROM batches WHERE NOT aggregated"""

EMPTY_RECORDS = f"SELECT {RECORD_COLUMNS} FROM fx_records WHERE FALSE"

ORACLE: dict[str, str] = {
    "journal_fold": _q(("fx_journal",), JOURNAL_STATE.format(e="entity_id", name="entity_id", m="message", o="seq", t="fx_journal")),
    "journal_fold_events": JOURNAL_STATE.format(e="user_id", name="user_id", m="event_type", o="event_id", t="events"),
    "journal_versions": _q(
        ("fx_journal",),
        """SELECT entity_id, seq, v AS version, v AS message_count,
       'User ' || entity_id || ' (version ' || v || ') says: ' || message AS line
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY seq) AS v FROM fx_journal)""",
    ),
    "journal_versions_events": """SELECT user_id, event_id, v AS version, v AS message_count,
       'User ' || user_id || ' (version ' || v || ') says: ' || event_type AS line
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS v FROM events)""",
    "journal_as_of": _q(
        ("fx_journal",),
        """SELECT entity_id, COUNT(*) AS version, COUNT(*) AS message_count, arg_max(message, seq) AS last_message
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY seq) AS v FROM fx_journal) WHERE v <= 3 GROUP BY entity_id""",
    ),
    "journal_as_of_events": """SELECT user_id, COUNT(*) AS version, COUNT(*) AS message_count, arg_max(event_type, event_id) AS last_message
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS v FROM events) WHERE v <= 20 GROUP BY user_id""",
    "last_message": _q(
        ("fx_journal",),
        "SELECT entity_id, 'User said ' || arg_max(message, seq) AS last_message FROM fx_journal GROUP BY entity_id",
    ),
    "speak": "SELECT conv_id AS entity_id, turn AS seq, 'User said ' || text AS spoken FROM conversations",
    "format_journal_line": """SELECT conv_id AS entity_id, turn AS seq,
       'User ' || conv_id || ' (version ' || (turn + 1) || ') says: ' || text AS line FROM conversations""",
    "seq_key": LONG_NUMBERS
    + """SELECT event_id, CAST(r AS INTEGER) AS seq_rank, CAST(length(d) AS INTEGER) AS seq_length, d AS seq_digits,
       CASE WHEN r = 1 THEN 0 ELSE sub END AS seq_sub FROM keys""",
    "seq_key_max": LONG_NUMBERS
    + """SELECT user_id, seq, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY r DESC, lpad(d, 80, '0') DESC, sub DESC, seq DESC, event_id DESC) AS rn
  FROM keys) WHERE rn = 1""",
    "validate_sequence": """SELECT event_id, event_id % 6 IN (4, 5) AND user_id % 3 - 1 >= 0 AS valid FROM events""",
    "initial_checkpoint": _q(
        ("fx_nodes",),
        "SELECT id, CASE id % 3 WHEN 0 THEN 'LATEST' WHEN 1 THEN 'TRIM_HORIZON' ELSE 'AT_TIMESTAMP' END AS checkpoint FROM fx_nodes",
    ),
    "start_position_trim_horizon": _q(("fx_records",), f"SELECT {RECORD_COLUMNS} FROM fx_records"),
    "start_position_latest": _q(("fx_records",), EMPTY_RECORDS),
    "start_position_shard_end": _q(("fx_records",), EMPTY_RECORDS),
    "start_position_at_timestamp": _q(
        ("fx_records",), f"SELECT {RECORD_COLUMNS} FROM fx_records WHERE arrival_ts >= TIMESTAMP '2024-01-15 00:00:00'"
    ),
    "start_position_at_sequence_number": _q(
        ("fx_records",), f"SELECT {RECORD_COLUMNS} FROM fx_records WHERE CAST(sequence_number AS BIGINT) >= 5006"
    ),
    "start_position_after_sequence_number": _q(
        ("fx_records",), f"SELECT {RECORD_COLUMNS} FROM fx_records WHERE CAST(sequence_number AS BIGINT) > 5006"
    ),
    "scan_records": _q(
        ("fx_records",), f"SELECT {RECORD_COLUMNS} FROM fx_records WHERE arrival_ts >= TIMESTAMP '2024-01-10 00:00:00'"
    ),
    "bounded_batch": _q(
        ("fx_records",),
        f"""SELECT {RECORD_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY CAST(sequence_number AS BIGINT)) AS rn FROM fx_records) WHERE rn <= 100""",
    ),
    "union_queues": _q(("fx_records",), "SELECT shard_id AS queue_id, sequence_number FROM fx_records"),
    "scan_shards": _q(("fx_nodes",), "SELECT id, start_seq FROM fx_nodes"),
    "distinct_shard_ids": "SELECT DISTINCT user_id % 8 AS shard_id FROM events",
    "scan_state": _q(("fx_state",), "SELECT key, version FROM fx_state"),
    "scan_state_limited": _q(("fx_state",), "SELECT least(count(*), 100) AS n FROM fx_state"),
    "lookup_key": _q(("fx_state",), "SELECT key, version, amount FROM fx_state WHERE key = 10"),
    "is_state_empty": _q(
        ("fx_state",),
        """SELECT 'all' AS part, count(*) = 0 AS empty FROM fx_state
UNION ALL SELECT 'negative', count(*) = 0 FROM fx_state WHERE version < 0
UNION ALL SELECT 'owned', count(*) = 0 FROM fx_state WHERE owner IS NOT NULL""",
    ),
    "after_checkpoint": _q(
        ("fx_records", "fx_checkpoints"),
        """SELECT r.shard_id, r.sequence_number, r.partition_key, r.arrival_ts
FROM fx_records r LEFT JOIN fx_checkpoints c ON c.shard_id = r.shard_id
WHERE c.shard_id IS NULL OR c.sequence_number IN ('TRIM_HORIZON', 'LATEST', 'AT_TIMESTAMP')
   OR TRY_CAST(r.sequence_number AS BIGINT) > TRY_CAST(c.sequence_number AS BIGINT)""",
    ),
    "high_water_mark": _q(
        ("fx_records", "fx_checkpoints", "fx_prior"),
        """SELECT shard_id, CAST(MAX(s) AS VARCHAR) AS sequence_number, CAST(0 AS BIGINT) AS sub_sequence FROM (
  SELECT r.shard_id, CAST(r.sequence_number AS BIGINT) AS s
  FROM fx_records r LEFT JOIN fx_checkpoints c ON c.shard_id = r.shard_id
  WHERE c.shard_id IS NULL OR c.sequence_number = 'TRIM_HORIZON'
     OR CAST(r.sequence_number AS BIGINT) > TRY_CAST(c.sequence_number AS BIGINT)
  UNION ALL SELECT shard_id, CAST(sequence_number AS BIGINT) FROM fx_prior) GROUP BY shard_id""",
    ),
    "checkpoint_commit": _q(("fx_requests", "fx_commit_state"), COMMIT, recursive=True),
    "finished_shards": _q(
        ("fx_shards", "fx_progress"),
        """SELECT s.shard_id, s.end_seq FROM fx_shards s JOIN fx_progress p ON p.shard_id = s.shard_id
WHERE CAST(p.sequence_number AS BIGINT) >= CAST(s.end_seq AS BIGINT)""",
    ),
    "shard_throughput": _q(
        ("fx_records",),
        "SELECT shard_id, COUNT(*) AS records, CAST(SUM(strlen(data)) AS BIGINT) AS bytes FROM fx_records GROUP BY shard_id",
    ),
    "shard_lag": _q(
        ("fx_records", "fx_progress"),
        """SELECT r.shard_id, r.tip_ts,
       coalesce((epoch_us(r.tip_ts) - epoch_us(p.processed_ts)) // 1000, -1) AS lag_ms
FROM (SELECT shard_id, MAX(arrival_ts) AS tip_ts FROM fx_records GROUP BY shard_id) r LEFT JOIN fx_progress p ON p.shard_id = r.shard_id""",
    ),
    "queue_depth": "SELECT user_id % 9 AS queue_id, COUNT(*) AS depth FROM events GROUP BY 1",
    "pack_envelopes": """SELECT conv_id AS entity_id, COUNT(*) AS n, string_agg(role || ':' || text, '|' ORDER BY turn) AS events_text,
       arg_min(role, turn) AS opened_by FROM conversations GROUP BY conv_id""",
    "unpack_envelopes": """SELECT conv_id AS entity_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS event_index,
       text AS message FROM conversations WHERE role = 'assistant'""",
    "unpack_envelopes_all": """SELECT conv_id AS entity_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS event_index,
       role FROM conversations""",
    "filter_any": """SELECT conv_id AS entity_id, COUNT(*) AS n FROM conversations GROUP BY conv_id HAVING bool_or(role = 'system')""",
    "apply_context": """SELECT conv_id AS entity_id, CAST(row_number() OVER w - 1 AS INTEGER) AS event_index,
       first_value(role) OVER w AS opened_by, TRUE AS no_entry FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "assign_sequence": """SELECT user_id % 8 AS queue_id, event_id, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1 AS seq
FROM events""",
    "route_to_queue": f"""SELECT event_id, {_queue("CAST(user_id AS VARCHAR)", 8)} AS queue_id,
       {_queue("CAST(user_id AS VARCHAR) || '/' || event_type", 5)} AS queue_of_namespace FROM events""",
    "payload_adapter": """SELECT conv_id AS entity_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS event_index,
       text AS message FROM conversations""",
    "publish": f"""SELECT conv_id AS entity_id, {_queue("CAST(conv_id AS VARCHAR)", 8)} AS queue_id, COUNT(*) AS n
FROM conversations GROUP BY conv_id""",
    "write_snapshot": JOURNAL_STATE.format(e="user_id", name="user_id", m="event_type", o="event_id", t="events"),
    "effective_hash_key": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN lpad(lower(hex(event_id * 1000003 * 7919)), 32, '0')
       ELSE md5(CAST(user_id AS VARCHAR)) END AS hash_key FROM events""",
    "route_by_hash_range": _q(
        ("fx_records", "fx_hash_shards"),
        """SELECT r.sequence_number, s.shard_id FROM fx_records r JOIN fx_hash_shards s
ON md5(r.partition_key) BETWEEN s.start_hash AND s.end_hash""",
    ),
    "deaggregate": _q(
        ("fx_batches", "fx_hash_shards"),
        DEAGGREGATED.format(
            low="CASE WHEN shard_id < 100 THEN repeat('0', 32) ELSE start_hash END",
            high="CASE WHEN shard_id < 100 THEN 'e' || repeat('0', 31) ELSE end_hash END",
        ),
    ),
    "deaggregate_any_range": _q(
        ("fx_batches", "fx_hash_shards"), DEAGGREGATED.format(low="repeat('0', 32)", high="repeat('f', 32)")
    ),
    "deliver": _q(
        ("fx_subscriptions",),
        """SELECT s.consumer, e.user_id AS stream_id, e.event_id FROM events e JOIN fx_subscriptions s
ON s.stream_id = e.user_id AND e.ts >= s.start_ts AND (s.stop_ts IS NULL OR e.ts < s.stop_ts)""",
    ),
    "consumed_count": _q(
        ("fx_subscriptions",),
        """SELECT s.consumer, COUNT(e.event_id) AS consumed FROM fx_subscriptions s LEFT JOIN events e
ON s.stream_id = e.user_id AND e.ts >= s.start_ts AND (s.stop_ts IS NULL OR e.ts < s.stop_ts) GROUP BY s.consumer""",
    ),
    "reset_counter": """WITH e AS (SELECT *, SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS epoch FROM events),
c AS (SELECT event_id, event_type, CAST(SUM(CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END)
    OVER (PARTITION BY user_id, epoch ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS counter FROM e)
SELECT event_id, counter, CASE WHEN event_type = 'signup' THEN -1 ELSE counter - 1 END AS emitted FROM c""",
    "produced_count": """SELECT user_id, COUNT(*) FILTER (WHERE event_type <> 'signup' AND (r IS NULL OR event_id > r)) AS produced
FROM (SELECT *, MAX(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id) AS r FROM events) GROUP BY user_id""",
    "reconcile_acks": _q(
        ("fx_pending", "fx_delivered"),
        """SELECT p.queue_id, p.token, CASE WHEN h.high IS NULL OR p.token > h.high THEN 'pending'
       WHEN d.token IS NOT NULL THEN 'acked' ELSE 'redeliver' END AS status
FROM fx_pending p LEFT JOIN (SELECT queue_id, MAX(token) AS high FROM fx_delivered GROUP BY queue_id) h ON h.queue_id = p.queue_id
LEFT JOIN fx_delivered d ON d.queue_id = p.queue_id AND d.token = p.token""",
    ),
    "children_of": _q(("fx_torn_nodes",), EDGES.format(nodes="fx_torn_nodes") + " SELECT parent, child FROM edges"),
    "open_shards": _q(("fx_nodes",), "SELECT id, start_seq FROM fx_nodes WHERE end_seq IS NULL"),
    "unclosed_parents": _q(
        ("fx_torn_nodes",),
        EDGES.format(nodes="fx_torn_nodes")
        + " SELECT id FROM fx_torn_nodes WHERE end_seq IS NULL AND id IN (SELECT parent FROM edges)",
    ),
    "hash_coverage": _q(
        ("fx_torn_nodes", "fx_closed_ids"),
        EDGES.format(nodes="fx_torn_nodes")
        + """ SELECT DISTINCT c.id, CASE WHEN n.id IS NULL THEN 'absent' WHEN n.end_seq IS NULL THEN 'not closed'
  WHEN s.lo IS NULL THEN 'no children' WHEN s.lo <= n.start_hash AND s.hi >= n.end_hash THEN 'covered' ELSE 'not covered' END AS status
FROM fx_closed_ids c LEFT JOIN fx_torn_nodes n ON n.id = c.id
LEFT JOIN (SELECT e.parent, MIN(k.start_hash) AS lo, MAX(k.end_hash) AS hi FROM edges e JOIN fx_torn_nodes k ON k.id = e.child
           GROUP BY e.parent) s ON s.parent = c.id""",
    ),
    "dependency_gate": _q(
        ("fx_nodes", "fx_tracked"),
        """SELECT n.id, NOT EXISTS (SELECT 1 FROM fx_tracked t WHERE t.id IN (n.parent_id, n.adjacent_parent_id)
                        AND (t.checkpoint IS NULL OR t.checkpoint <> 'SHARD_END')) AS ready FROM fx_nodes n""",
    ),
    "garbage_keys": _q(
        ("fx_key_rows", "fx_torn_nodes"),
        """SELECT k.key, CASE WHEN k.key IN (SELECT id FROM fx_torn_nodes) THEN 'keep'
  WHEN EXISTS (SELECT 1 FROM fx_torn_nodes n WHERE n.id = k.parent_a OR n.id = k.parent_b) THEN 'inconsistent' ELSE 'delete' END AS status
FROM fx_key_rows k""",
    ),
    "finished_keys": _q(
        ("fx_nodes", "fx_tracked"),
        EDGES.format(nodes="fx_nodes")
        + """ SELECT t.id AS key FROM fx_tracked t JOIN (
  SELECT e.parent, COUNT(*) AS n, COUNT(c.id) AS tracked, COUNT(*) FILTER (WHERE c.checkpoint = 'TRIM_HORIZON') AS waiting
  FROM edges e LEFT JOIN fx_tracked c ON c.id = e.child GROUP BY e.parent) x ON x.parent = t.id
WHERE t.checkpoint = 'SHARD_END' AND x.n = x.tracked AND x.waiting = 0""",
    ),
    "order_keys": _q(("fx_tracked",), "SELECT id AS key FROM fx_tracked"),
    "order_keys_positions": _q(
        ("fx_tracked", "fx_torn_nodes"),
        """SELECT t.id AS key, row_number() OVER (ORDER BY n.start_seq::HUGEINT NULLS LAST, t.id::VARCHAR) AS position
FROM fx_tracked t LEFT JOIN fx_torn_nodes n ON n.id = t.id""",
    ),
    "consume_by_position": _q(("fx_records",), "SELECT shard_id, sequence_number, sub_sequence, partition_key FROM fx_records"),
    "lineage_descendants": _closure("parent", "child"),
    "lineage_ancestors": _closure("child", "parent"),
    "lineage_backfill_latest": _backfill("LATEST"),
    "lineage_backfill_trim_horizon": _backfill("TRIM_HORIZON"),
    "lineage_backfill_at_timestamp": _backfill("AT_TIMESTAMP"),
    "snapshot_diff": _q(
        ("fx_snapshot_old", "fx_snapshot_new"),
        """SELECT coalesce(o.key, n.key) AS key, coalesce(o.version, -1) AS old_version, coalesce(n.version, -1) AS new_version,
  CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' WHEN o.version = n.version THEN 'unchanged' ELSE 'changed' END AS status
FROM fx_snapshot_old o FULL OUTER JOIN fx_snapshot_new n ON n.key = o.key""",
    ),
    "shard_list_diff": _q(
        ("fx_nodes", "fx_torn_nodes", "fx_some_tracked"),
        "SELECT id AS key FROM fx_nodes EXCEPT SELECT id FROM fx_torn_nodes EXCEPT SELECT id FROM fx_some_tracked",
    ),
    "tracked_keys": _q(
        ("fx_state", "fx_new_state"), "SELECT key, version FROM fx_state UNION ALL SELECT * FROM fx_new_state"
    ),
    "order_desc": _q(("fx_state",), "SELECT key, version FROM fx_state ORDER BY key DESC"),
    "order_desc_positions": _q(
        ("fx_state",), "SELECT key, version, row_number() OVER (ORDER BY key DESC) AS position FROM fx_state"
    ),
    "versioned_merge": _q(
        ("fx_target", "fx_changes"),
        """, j AS (
  SELECT coalesce(t.key, c.key) AS key, t.key IS NOT NULL AS alive, t.version, t.owner, t.amount, c.op, c.new_owner, c.amount AS new_amount,
         CASE WHEN c.op = 'create' THEN t.key IS NULL WHEN c.op = 'delete' THEN TRUE
              WHEN c.op = 'evict' THEN t.key IS NOT NULL AND t.owner IS NOT DISTINCT FROM c.expected_owner
              ELSE coalesce(t.version = c.expected_version, FALSE) END AND c.op IS NOT NULL AS ok
  FROM fx_target t FULL OUTER JOIN fx_changes c ON c.key = t.key)
SELECT key, CASE WHEN NOT ok THEN version WHEN op = 'create' THEN 0 ELSE version + 1 END AS version,
       coalesce(CASE WHEN NOT ok THEN owner WHEN op IN ('create', 'take') THEN new_owner WHEN op = 'evict' THEN NULL ELSE owner END, '') AS owner,
       CASE WHEN ok AND op IN ('create', 'update') THEN new_amount ELSE amount END AS amount
FROM j WHERE (ok AND op <> 'delete') OR (NOT ok AND alive)""",
    ),
    "versioned_merge_outcomes": _q(
        ("fx_target", "fx_changes"),
        """SELECT c.key, c.op, CASE WHEN c.op = 'create' THEN t.key IS NULL WHEN c.op = 'delete' THEN TRUE
       WHEN c.op = 'evict' THEN t.key IS NOT NULL AND t.owner IS NOT DISTINCT FROM c.expected_owner
       ELSE coalesce(t.version = c.expected_version, FALSE) END AS applied
FROM fx_changes c LEFT JOIN fx_target t ON t.key = c.key""",
    ),
    # of two writers on one version the second changes nothing
    "commit_merge_outcomes": _q(
        ("fx_target", "fx_changes"),
        """SELECT c.key, c.op, CASE WHEN c.op = 'create' THEN t.key IS NULL WHEN c.op = 'delete' THEN TRUE
       WHEN c.op = 'evict' THEN t.key IS NOT NULL AND t.owner IS NOT DISTINCT FROM c.expected_owner
       ELSE coalesce(t.version = c.expected_version, FALSE) END AS first_applied, FALSE AS late_applied
FROM fx_changes c LEFT JOIN fx_target t ON t.key = c.key""",
    ),
    "diff_versions": _q(
        ("fx_snapshot_old", "fx_snapshot_new"),
        """SELECT coalesce(o.key, n.key) AS key, coalesce(o.version, -1) AS old_version, coalesce(n.version, -1) AS new_version,
  CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' ELSE 'changed' END AS status
FROM fx_snapshot_old o FULL OUTER JOIN fx_snapshot_new n ON n.key = o.key WHERE o.version IS DISTINCT FROM n.version""",
    ),
    "versioned_merge_ordered": _q(
        ("fx_user_target", "fx_user_changes"),
        CHAIN
        + """ SELECT key, version, coalesce(owner, '') AS owner, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS back FROM fold) WHERE back = 1 AND alive""",
        recursive=True,
    ),
    "versioned_merge_ordered_outcomes": _q(
        ("fx_user_target", "fx_user_changes"), CHAIN + " SELECT key, seq, op, applied FROM fold WHERE rn > 0", recursive=True
    ),
    "stale_keys": _q(
        ("fx_scans",),
        """, a AS (SELECT *, lag(scan_order) OVER w AS before, lag(version) OVER w AS old FROM fx_scans
  WINDOW w AS (PARTITION BY key ORDER BY scan_order)),
b AS (SELECT *, CASE WHEN before IS NULL OR scan_order - before > 1 THEN CASE WHEN owner IS NULL THEN TIMESTAMP '1970-01-01' ELSE scan_ts END
                     WHEN version <> old THEN scan_ts END AS change FROM a),
c AS (SELECT *, last_value(change IGNORE NULLS) OVER (PARTITION BY key ORDER BY scan_order ROWS UNBOUNDED PRECEDING) AS last_change FROM b)
SELECT key, scan_order, last_change, scan_ts - last_change > INTERVAL '2' DAY AS stale FROM c""",
    ),
    "owner_switches": _q(
        ("fx_history",),
        """, a AS (SELECT *, lag(owner) OVER w AS old,
    SUM(CASE WHEN is_checkpoint THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY scan_order ROWS UNBOUNDED PRECEDING) AS epoch
  FROM fx_history WINDOW w AS (PARTITION BY key ORDER BY scan_order))
SELECT key, scan_order, CAST(SUM(CASE WHEN NOT is_checkpoint AND old IS NOT NULL AND owner IS NOT NULL AND old <> owner THEN 1 ELSE 0 END)
    OVER (PARTITION BY key, epoch ORDER BY scan_order ROWS UNBOUNDED PRECEDING) AS BIGINT) AS owner_switches FROM a""",
    ),
    "load_report": _q(
        ("fx_assignments", "fx_owners"),
        _load("expired", NO_CAP) + " SELECT owner, load, target, spillover, target - load AS deficit FROM report",
    ),
    "load_report_capped": _q(
        ("fx_assignments", "fx_owners"),
        _load("expired", "90") + " SELECT owner, load, target, spillover, target - load AS deficit FROM report",
    ),
    "rebalance_expired": _q(
        ("fx_assignments", "fx_owners"),
        _load("expired", NO_CAP)
        + """ SELECT owner, greatest(target - load, 0) AS needed,
       least(greatest(target - load, 0), (SELECT COUNT(*) FROM fx_assignments WHERE expired)) AS take_expired,
       CAST(0 AS BIGINT) AS take_moved FROM report""",
    ),
    "rebalance_moved": _q(
        ("fx_assignments", "fx_owners"),
        _load("FALSE", NO_CAP)
        + """, top AS (SELECT owner AS o, load AS l FROM report ORDER BY load DESC, owner LIMIT 1),
m AS (SELECT owner, greatest(target - load, 0) AS needed, o,
  CASE WHEN target - load <= 0 OR l < target THEN 0
       WHEN least(target - load, l - target) = 0 THEN CASE WHEN target - load > 1 THEN 1 ELSE 0 END
       ELSE least(target - load, l - target, 25) END AS n FROM report, top)
SELECT owner, needed, CAST(n AS BIGINT) AS take_moved, CASE WHEN n > 0 THEN o ELSE '' END AS moved_from FROM m""",
    ),
    "slow_operations": _q(("fx_op_log",), "SELECT * FROM fx_op_log WHERE duration_ms > 3000"),
    "failure_streaks": """WITH e AS (SELECT event_id, user_id % 8 AS shard_id, event_type IN ('error', 'view', 'click') AS bad FROM events),
g AS (SELECT *, SUM(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY shard_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM e),
s AS (SELECT event_id, CAST(SUM(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY shard_id, island ORDER BY event_id ROWS UNBOUNDED PRECEDING)
      AS BIGINT) AS streak FROM g)
SELECT event_id, streak, CASE WHEN streak > 5 THEN 'error' WHEN streak > 0 THEN 'warn' ELSE '' END AS severity FROM s""",
    "stream_journal": _q(
        ("fx_journal",), JOURNAL_STATE.format(e="entity_id", name="entity_id", m="message", o="seq", t="fx_journal")
    ),
    "stream_journal_versions": _q(
        ("fx_journal",),
        """SELECT entity_id, seq, v AS version, 'User ' || entity_id || ' (version ' || v || ') says: ' || message AS line
FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY seq) AS v FROM fx_journal)""",
    ),
    "stream_consumed_count": _q(
        ("fx_subscriptions",),
        """SELECT s.consumer, COUNT(*) AS consumed FROM fx_subscriptions s JOIN events e
ON s.stream_id = e.user_id AND e.ts >= s.start_ts AND (s.stop_ts IS NULL OR e.ts < s.stop_ts) GROUP BY s.consumer""",
    ),
    "stream_stale_keys": _q(
        ("fx_versions",),
        """, a AS (SELECT key, version, owner, epoch_us(scan_ts) AS us,
    lag(version) OVER (PARTITION BY key ORDER BY scan_ts) AS old, row_number() OVER (PARTITION BY key ORDER BY scan_ts) AS n FROM fx_versions),
c AS (SELECT key, us, n, owner, lead(us) OVER (PARTITION BY key ORDER BY n) AS next FROM a WHERE n = 1 OR version <> old),
f AS (SELECT MAX(epoch_us(scan_ts)) // 1000 AS final FROM fx_versions)
SELECT key, CASE WHEN n = 1 AND owner IS NULL THEN TIMESTAMP '1970-01-01' ELSE make_timestamp(us) END AS last_change
FROM c, f WHERE (n = 1 AND owner IS NULL) OR next > us + 259200000000
  OR (next IS NULL AND final > (us + 259200000000 + 999) // 1000)""",
    ),
    "resume_stream": "SELECT event_id, event_type FROM events",
    "process_batches": "SELECT event_id, user_id FROM events",
    "filter_stream": """SELECT conv_id AS entity_id, COUNT(*) AS n FROM conversations GROUP BY conv_id HAVING bool_or(role = 'system')""",
    "publish_stream": f"""SELECT user_id, event_id, {_queue("CAST(user_id AS VARCHAR)", 8)} AS queue_id FROM events""",
}

ORACLE["append_journal_versions"] = ORACLE["stream_journal_versions"]
ORACLE["commit_merge"] = ORACLE["versioned_merge"]
ORACLE["unpack_stream"] = ORACLE["unpack_envelopes"]
ORACLE["scan_records_at_sequence_number"] = ORACLE["start_position_at_sequence_number"]
ORACLE["scan_records_after_sequence_number"] = ORACLE["start_position_after_sequence_number"]
ORACLE["stream_observer"] = "SELECT 'rows' AS call, count(*) AS n FROM events UNION ALL SELECT 'completed', 1"
