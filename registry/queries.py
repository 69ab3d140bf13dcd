"""One registered query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.views import table, view
from tidemark.functions import hashing, sequence, text
from tidemark.operators import consume, delivery, envelopes, expand, journal, lineage, monitor, state
from tidemark.plans.durable import work_folder
from tidemark.session import ROCKSDB_STATE_STORE
from tidemark.sources import records, sinks, tables, versions
from tidemark.streaming import batches as stream_batches
from tidemark.streaming import delivery as stream_delivery
from tidemark.streaming import journal as stream_journals
from tidemark.streaming import positions as stream_positions
from tidemark.streaming import stale as stream_stale

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _filled(column: Column | str, value=-1) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(value))


# ---- journals


@query
def journal_fold(spark, sf):
    return journal.journal_fold(view(spark, sf, "fx_journal"))


@query
def journal_fold_events(spark, sf):
    return journal.journal_fold(table(spark, sf, "events"), "user_id", "event_id", "event_type")


@query
def journal_versions(spark, sf):
    return journal.journal_versions(view(spark, sf, "fx_journal")).drop("role", "message")


@query
def journal_versions_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return journal.journal_versions(events, "user_id", "event_id", "event_type").drop("event_type")


@query
def journal_as_of(spark, sf):
    return journal.journal_as_of(view(spark, sf, "fx_journal"), 3)


@query
def journal_as_of_events(spark, sf):
    return journal.journal_as_of(table(spark, sf, "events"), 20, "user_id", "event_id", "event_type")


@query
def last_message(spark, sf):
    return journal.last_message(view(spark, sf, "fx_journal"))


@query
def speak(spark, sf):
    return view(spark, sf, "fx_journal").select("entity_id", "seq", text.speak("message").alias("spoken"))


@query
def format_journal_line(spark, sf):
    line = text.format_journal_line("entity_id", F.col("seq") + 1, "message")
    return view(spark, sf, "fx_journal").select("entity_id", "seq", line.alias("line"))


# ---- sequence numbers and scans


def _long_numbers(spark, sf) -> DataFrame:
    """Sequence numbers of 1 to 60 digits, some with leading zeros, and the sentinels."""
    number = F.concat(
        F.when(F.col("event_id") % 3 == 0, "00").otherwise(""),
        (F.col("event_id") * 7 + 1).cast("string"),
        F.expr("repeat(cast(event_id % 10 as string), cast(user_id % 50 as int))"),
    )
    sentinel = (
        F.when(F.col("event_id") % 40 == 1, sequence.AT_TIMESTAMP)
        .when(F.col("event_id") % 40 == 2, sequence.TRIM_HORIZON)
        .when(F.col("event_id") % 40 == 3, sequence.LATEST)
        .when(F.col("event_id") % 40 == 4, sequence.SHARD_END)
    )
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.coalesce(sentinel, number).alias("seq"), (F.col("event_id") % 5).alias("sub")
    )


@query
def seq_key(spark, sf):
    key = sequence.seq_key("seq", "sub")
    return _long_numbers(spark, sf).select(
        "event_id",
        key["rank"].alias("seq_rank"),
        key["length"].alias("seq_length"),
        key["digits"].alias("seq_digits"),
        key["sub"].alias("seq_sub"),
    )


@query
def seq_key_max(spark, sf):
    greatest = F.max(F.struct(sequence.seq_key("seq", "sub").alias("key"), "seq", "event_id"))
    return _long_numbers(spark, sf).groupBy("user_id").agg(greatest.alias("g")).select("user_id", "g.seq", "g.event_id")


@query
def validate_sequence(spark, sf):
    seq = (
        F.when(F.col("event_id") % 6 == 0, F.lit("abc"))
        .when(F.col("event_id") % 6 == 1, F.lit(""))
        .when(F.col("event_id") % 6 == 2, F.lit(None).cast("string"))
        .when(F.col("event_id") % 6 == 3, F.concat(F.lit("-"), F.col("event_id").cast("string")))
        .otherwise(F.col("event_id").cast("string"))
    )
    return table(spark, sf, "events").select(
        "event_id", sequence.validate_sequence(seq, F.col("user_id") % 3 - 1).alias("valid")
    )


@query
def initial_checkpoint(spark, sf):
    position = F.element_at(F.array(*[F.lit(p) for p in sequence.INITIAL_POSITIONS]), (F.col("id") % 3 + 1).cast("int"))
    return view(spark, sf, "fx_nodes").select("id", sequence.initial_checkpoint(position).alias("checkpoint"))


def _records_columns(df: DataFrame) -> DataFrame:
    return df.select("shard_id", "sequence_number", "partition_key", "arrival_ts")


@query
def start_position_trim_horizon(spark, sf):
    return _records_columns(records.start_position(view(spark, sf, "fx_records"), sequence.TRIM_HORIZON))


@query
def start_position_latest(spark, sf):
    return _records_columns(records.start_position(view(spark, sf, "fx_records"), sequence.LATEST))


@query
def start_position_shard_end(spark, sf):
    return _records_columns(records.start_position(view(spark, sf, "fx_records"), sequence.SHARD_END))


@query
def start_position_at_timestamp(spark, sf):
    start = dt.datetime(2024, 1, 15)
    return _records_columns(records.start_position(view(spark, sf, "fx_records"), sequence.AT_TIMESTAMP, ts=start))


@query
def start_position_at_sequence_number(spark, sf):
    found = records.start_position(view(spark, sf, "fx_records"), sequence.AT_SEQUENCE_NUMBER, seq="5006")
    return _records_columns(found)


@query
def start_position_after_sequence_number(spark, sf):
    found = records.start_position(view(spark, sf, "fx_records"), sequence.AFTER_SEQUENCE_NUMBER, seq="5006")
    return _records_columns(found)


@query
def scan_records(spark, sf):
    path = work_folder(spark, "records")
    view(spark, sf, "fx_records").write.partitionBy("shard_id").parquet(path)
    scanned = records.scan_records(spark, path, sequence.AT_TIMESTAMP, ts=dt.datetime(2024, 1, 10))
    return _records_columns(scanned.withColumn("shard_id", F.col("shard_id").cast("long")))


def _scan_of_laid_out(spark, sf, position: str) -> DataFrame:
    path = work_folder(spark, "laid-out")
    records.write_records(view(spark, sf, "fx_records"), path)
    return _records_columns(records.scan_records(spark, path, position, seq="5006"))


@query
def scan_records_at_sequence_number(spark, sf):
    return _scan_of_laid_out(spark, sf, sequence.AT_SEQUENCE_NUMBER)


@query
def scan_records_after_sequence_number(spark, sf):
    return _scan_of_laid_out(spark, sf, sequence.AFTER_SEQUENCE_NUMBER)


@query
def bounded_batch(spark, sf):
    return _records_columns(records.bounded_batch(view(spark, sf, "fx_records"), 100))


@query
def union_queues(spark, sf):
    path = work_folder(spark, "queue-folders")
    view(spark, sf, "fx_records").write.partitionBy("shard_id").parquet(path)
    # one read per queue's folder
    queues = {q: spark.read.parquet(f"{path}/shard_id={q}") for q in range(8)}
    return records.union_queues(queues).select("queue_id", "sequence_number")


@query
def scan_shards(spark, sf):
    path = work_folder(spark, "shards")
    view(spark, sf, "fx_nodes").write.parquet(path)
    return tables.scan_shards(spark, path).select("id", "start_seq")


@query
def distinct_shard_ids(spark, sf):
    return tables.distinct_shard_ids(view(spark, sf, "fx_records"), "shard_id")


@query
def scan_state(spark, sf):
    path = work_folder(spark, "state")
    view(spark, sf, "fx_state").write.parquet(path)
    return tables.scan_state(spark, path).select("key", "version")


@query
def scan_state_limited(spark, sf):
    path = work_folder(spark, "state")
    view(spark, sf, "fx_state").write.parquet(path)
    # which rows a bounded listing returns is open; that they are rows of the state, each once, is not
    listed = tables.scan_state(spark, path, limit=100)
    return listed.join(view(spark, sf, "fx_state").select("key", "version"), ["key", "version"]).agg(F.count_distinct("key").alias("n"))


@query
def lookup_key(spark, sf):
    return tables.lookup_key(view(spark, sf, "fx_state"), 10).select("key", "version", "amount")


@query
def is_state_empty(spark, sf):
    state_now = view(spark, sf, "fx_state")
    parts = {"all": state_now, "negative": state_now.where("version < 0"), "owned": state_now.where("owner IS NOT NULL")}
    found = [(name, tables.is_state_empty(part)) for name, part in parts.items()]
    return spark.createDataFrame(found, "part string, empty boolean")


# ---- consuming


@query
def after_checkpoint(spark, sf):
    kept = consume.after_checkpoint(view(spark, sf, "fx_records"), view(spark, sf, "fx_checkpoints"))
    return _records_columns(kept)


@query
def high_water_mark(spark, sf):
    return consume.high_water_mark(
        view(spark, sf, "fx_records"), view(spark, sf, "fx_checkpoints"), view(spark, sf, "fx_prior")
    )


@query
def checkpoint_commit(spark, sf):
    outcome = consume.checkpoint_commit(view(spark, sf, "fx_requests"), view(spark, sf, "fx_commit_state"))
    return outcome.select(
        "shard_id",
        "request_order",
        "outcome",
        _filled("recorded_sequence", "").alias("recorded_sequence"),
        _filled("recorded_sub").alias("recorded_sub"),
    )


@query
def finished_shards(spark, sf):
    return consume.finished_shards(view(spark, sf, "fx_shards"), view(spark, sf, "fx_progress"))


@query
def shard_throughput(spark, sf):
    return consume.shard_throughput(view(spark, sf, "fx_records"))


@query
def shard_lag(spark, sf):
    lag = consume.shard_lag(view(spark, sf, "fx_records"), view(spark, sf, "fx_progress"))
    return lag.select("shard_id", "tip_ts", _filled("lag_ms").alias("lag_ms"))


@query
def queue_depth(spark, sf):
    return envelopes.queue_depth(view(spark, sf, "fx_pending"))


# ---- envelopes


def _envelopes(spark, sf, **options) -> DataFrame:
    return envelopes.pack_envelopes(
        view(spark, sf, "fx_journal"),
        ["entity_id"],
        ["entity_id"],
        "seq",
        ["role", "message"],
        {"opened_by": F.col("role"), "entity": F.col("entity_id")},
        **options,
    )


@query
def pack_envelopes(spark, sf):
    joined = F.array_join(F.transform("events", lambda e: F.concat(e["role"], F.lit(":"), e["message"])), "|")
    return _envelopes(spark, sf).select(
        "entity_id",
        F.size("events").cast("long").alias("n"),
        joined.alias("events_text"),
        F.element_at("request_context", "opened_by").alias("opened_by"),
    )


@query
def unpack_envelopes(spark, sf):
    unpacked = envelopes.unpack_envelopes(_envelopes(spark, sf), lambda e: e["role"] == "assistant")
    return unpacked.select("entity_id", "event_index", F.col("event.message").alias("message"))


@query
def unpack_envelopes_all(spark, sf):
    unpacked = envelopes.unpack_envelopes(_envelopes(spark, sf))
    return unpacked.select("entity_id", "event_index", F.col("event.role").alias("role"))


@query
def filter_any(spark, sf):
    kept = envelopes.filter_any(_envelopes(spark, sf), lambda e: e["role"] == "system")
    return kept.select("entity_id", F.size("events").cast("long").alias("n"))


@query
def apply_context(spark, sf):
    events = envelopes.apply_context(_envelopes(spark, sf), ["opened_by", "missing"])
    return events.select("entity_id", "event_index", "opened_by", F.col("missing").isNull().alias("no_entry"))


@query
def assign_sequence(spark, sf):
    messages = table(spark, sf, "events").select((F.col("user_id") % 8).alias("queue_id"), "event_id")
    return envelopes.assign_sequence(messages, "queue_id", "event_id")


@query
def route_to_queue(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        hashing.route_to_queue("user_id").alias("queue_id"),
        hashing.route_to_queue("user_id", "event_type", 5).alias("queue_of_namespace"),
    )


@query
def payload_adapter(spark, sf):
    packed = _envelopes(spark, sf)
    event_type = packed.schema["events"].dataType.elementType
    back = envelopes.message_to_envelope(envelopes.envelope_to_message(packed), event_type)
    unpacked = envelopes.unpack_envelopes(back)
    return unpacked.select("entity_id", "event_index", F.col("event.message").alias("message"))


@query
def publish(spark, sf):
    path = work_folder(spark, "queues")
    sinks.publish(_envelopes(spark, sf), path, "entity_id")
    back = spark.read.parquet(path)
    return back.select("entity_id", F.col("queue_id").cast("long").alias("queue_id"), F.size("events").cast("long").alias("n"))


@query
def write_snapshot(spark, sf):
    state_now = journal.journal_fold(table(spark, sf, "events"), "user_id", "event_id", "event_type")
    path = work_folder(spark, "snapshot")
    sinks.write_snapshot(state_now, path, 0)
    folder = sinks.write_snapshot(state_now, path, 0)
    return spark.read.schema(state_now.schema).json(folder)


# ---- hash ranges and aggregates


@query
def effective_hash_key(spark, sf):
    explicit = F.when(F.col("event_id") % 2 == 0, (F.col("event_id") * 1000003 * 7919).cast("string"))
    key = hashing.effective_hash_key(F.col("user_id").cast("string"), explicit)
    return table(spark, sf, "events").select("event_id", key.alias("hash_key"))


@query
def route_by_hash_range(spark, sf):
    routed = expand.route_by_hash_range(view(spark, sf, "fx_records"), view(spark, sf, "fx_hash_shards"))
    return routed.select("sequence_number", "shard_id")


def _aggregates(spark, sf) -> DataFrame:
    """Records of four events each: valid aggregates, ones with a damaged digest, and plain ones."""
    item = F.struct("place", F.col("user_id").cast("string").alias("pk"), "explicit_hash_key", "props")
    grouped = (
        view(spark, sf, "fx_batches")
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(item)).alias("rows"), F.max("ts").alias("arrival_ts"))
    )
    body = F.array_join(F.transform("rows", lambda r: r["props"]), "").cast("binary")
    digest = F.unhex(F.md5(F.when(F.col("batch") % 4 == 3, F.lit("other").cast("binary")).otherwise(body)))
    framed = F.concat(F.unhex(F.lit(expand.AGGREGATE_MAGIC)), body, digest)
    return grouped.select(
        F.when(F.col("batch") % 2 == 0, F.lit(100)).otherwise(F.col("batch") % 8).cast("long").alias("shard_id"),
        F.col("batch").cast("string").alias("sequence_number"),
        F.lit("outer").alias("partition_key"),
        F.when(F.col("batch") % 4 == 2, body).otherwise(framed).alias("data"),
        "arrival_ts",
        F.transform("rows", lambda r: r["pk"]).alias("partition_keys"),
        F.transform("rows", lambda r: r["explicit_hash_key"]).alias("explicit_hash_keys"),
        F.transform(
            "rows",
            lambda r, i: F.struct(
                i.alias("pk_index"),
                F.when(r["explicit_hash_key"].isNotNull(), i).alias("ehk_index"),
                r["props"].cast("binary").alias("data"),
            ),
        ).alias("items"),
    )


def _deaggregated_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "shard_id",
        "sequence_number",
        "sub_sequence",
        "partition_key",
        _filled("explicit_hash_key", "").alias("explicit_hash_key"),
        F.octet_length("data").cast("long").alias("n_bytes"),
        "arrival_ts",
        "aggregated",
    )


@query
def deaggregate(spark, sf):
    wide = view(spark, sf, "fx_hash_shards")
    wide = wide.withColumn("start_hash", F.when(F.col("shard_id") < 100, "0" * 32).otherwise(F.col("start_hash")))
    wide = wide.withColumn("end_hash", F.when(F.col("shard_id") < 100, "e" + "0" * 31).otherwise(F.col("end_hash")))
    return _deaggregated_columns(expand.deaggregate(_aggregates(spark, sf), wide))


@query
def deaggregate_any_range(spark, sf):
    return _deaggregated_columns(expand.deaggregate(_aggregates(spark, sf)))


# ---- delivery


def _stream_events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("stream_id"), "event_id", "ts")


@query
def deliver(spark, sf):
    delivered = delivery.deliver(_stream_events(spark, sf), view(spark, sf, "fx_subscriptions"))
    return delivered.select("consumer", "stream_id", "event_id")


@query
def consumed_count(spark, sf):
    return delivery.consumed_count(_stream_events(spark, sf), view(spark, sf, "fx_subscriptions"))


@query
def reset_counter(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    counted = delivery.reset_counter(events, "user_id", "event_id", F.col("event_type") == "signup")
    return counted.select("event_id", "counter", _filled("emitted").alias("emitted"))


@query
def produced_count(spark, sf):
    events = table(spark, sf, "events")
    return delivery.produced_count(events, "user_id", "event_id", F.col("event_type") == "signup")


@query
def reconcile_acks(spark, sf):
    return delivery.reconcile_acks(view(spark, sf, "fx_pending"), view(spark, sf, "fx_delivered"))


# ---- lineage


@query
def children_of(spark, sf):
    return lineage.children_of(view(spark, sf, "fx_torn_nodes"))


@query
def open_shards(spark, sf):
    return lineage.open_shards(view(spark, sf, "fx_nodes")).select("id", "start_seq")


@query
def unclosed_parents(spark, sf):
    return lineage.unclosed_parents(view(spark, sf, "fx_torn_nodes"))


@query
def hash_coverage(spark, sf):
    return lineage.hash_coverage(view(spark, sf, "fx_torn_nodes"), view(spark, sf, "fx_closed_ids"))


def _tracked_state(spark, sf) -> DataFrame:
    return view(spark, sf, "fx_tracked").withColumnRenamed("id", "key")


@query
def dependency_gate(spark, sf):
    return lineage.dependency_gate(view(spark, sf, "fx_nodes"), _tracked_state(spark, sf))


@query
def garbage_keys(spark, sf):
    rows = view(spark, sf, "fx_key_rows")
    rows = rows.select("key", F.array_compact(F.array("parent_a", "parent_b")).alias("parents"))
    return lineage.garbage_keys(rows, view(spark, sf, "fx_torn_nodes"))


@query
def finished_keys(spark, sf):
    return lineage.finished_keys(_tracked_state(spark, sf), lineage.children_of(view(spark, sf, "fx_nodes")))


@query
def order_keys(spark, sf):
    return lineage.order_keys(_tracked_state(spark, sf).select("key"), view(spark, sf, "fx_torn_nodes"))


@query
def order_keys_positions(spark, sf):
    return lineage.order_keys(_tracked_state(spark, sf).select("key"), view(spark, sf, "fx_torn_nodes"), position="position")


@query
def lineage_descendants(spark, sf):
    return lineage.lineage_closure(view(spark, sf, "fx_nodes"), view(spark, sf, "fx_some_tracked"), "descendants")


@query
def lineage_ancestors(spark, sf):
    return lineage.lineage_closure(view(spark, sf, "fx_nodes"), view(spark, sf, "fx_some_tracked"), "ancestors")


def _backfill(spark, sf, position: str) -> DataFrame:
    return lineage.lineage_backfill_plan(view(spark, sf, "fx_nodes"), view(spark, sf, "fx_some_tracked"), position)


@query
def lineage_backfill_latest(spark, sf):
    return _backfill(spark, sf, sequence.LATEST)


@query
def lineage_backfill_trim_horizon(spark, sf):
    return _backfill(spark, sf, sequence.TRIM_HORIZON)


@query
def lineage_backfill_at_timestamp(spark, sf):
    return _backfill(spark, sf, sequence.AT_TIMESTAMP)


@query
def consume_by_position(spark, sf):
    """Two runs of one consumer with limits per shard; the second finds more records of old shards and a new shard."""
    folder, records_of = work_folder(spark, "consumer"), view(spark, sf, "fx_records")
    consumer = stream_positions.ShardConsumer(spark, f"{folder}/records", f"{folder}/consumer", limit=1_000_000)
    take = lambda batch, number: batch.drop("data").write.mode("overwrite").parquet(f"{folder}/out/batch_id={number}")
    # a shard's first records by number, as they would arrive; nothing is left out over both writes
    early = F.col("arrival_ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    records.write_records(records_of.where(early & (F.col("shard_id") < 7)), f"{folder}/records")
    consumer.run(take)
    records.write_records(records_of.where(~(early & (F.col("shard_id") < 7))), f"{folder}/records")
    consumer.run(take)
    return spark.read.parquet(f"{folder}/out").select("shard_id", "sequence_number", "sub_sequence", "partition_key")


# ---- keyed state


@query
def snapshot_diff(spark, sf):
    diff = state.snapshot_diff(view(spark, sf, "fx_snapshot_old"), view(spark, sf, "fx_snapshot_new"))
    return diff.select(
        "key", _filled("old_version").alias("old_version"), _filled("new_version").alias("new_version"), "status"
    )


@query
def shard_list_diff(spark, sf):
    keys = view(spark, sf, "fx_nodes").select(F.col("id").alias("key"))
    listing = view(spark, sf, "fx_torn_nodes").select(F.col("id").alias("key"))
    fresh = view(spark, sf, "fx_some_tracked").select(F.col("id").alias("key"))
    return state.shard_list_diff(keys, listing, fresh)


@query
def tracked_keys(spark, sf):
    return state.tracked_keys(view(spark, sf, "fx_state").select("key", "version"), view(spark, sf, "fx_new_state"))


@query
def order_desc(spark, sf):
    return state.order_desc(view(spark, sf, "fx_state").select("key", "version"))


@query
def order_desc_positions(spark, sf):
    return state.order_desc(view(spark, sf, "fx_state").select("key", "version"), position="position")


def _merge(spark, sf) -> tuple[DataFrame, DataFrame]:
    return state.versioned_merge(view(spark, sf, "fx_target"), view(spark, sf, "fx_changes"), ["amount"])


@query
def versioned_merge(spark, sf):
    merged = _merge(spark, sf)[0]
    return merged.select("key", "version", _filled("owner", "").alias("owner"), "amount")


@query
def versioned_merge_outcomes(spark, sf):
    return _merge(spark, sf)[1]


def _committed(spark, sf) -> tuple[str, DataFrame]:
    """A table of versions after the changes' commit and that of a second writer on the same version, and the first one's outcomes."""
    folder, changes = work_folder(spark, "versions"), view(spark, sf, "fx_changes")
    versions.create_versions(view(spark, sf, "fx_target"), folder)
    outcomes = versions.commit_merge(changes, folder, ["amount"], base=0)
    late = versions.commit_merge(changes, folder, ["amount"], base=0)
    return folder, outcomes.withColumnRenamed("applied", "first_applied").join(late.withColumnRenamed("applied", "late_applied"), ["key", "op"])


@query
def commit_merge(spark, sf):
    return versions.read_version(spark, _committed(spark, sf)[0]).select("key", "version", _filled("owner", "").alias("owner"), "amount")


@query
def commit_merge_outcomes(spark, sf):
    return _committed(spark, sf)[1]


@query
def diff_versions(spark, sf):
    folder = work_folder(spark, "versions")
    versions.create_versions(view(spark, sf, "fx_snapshot_old"), f"{folder}/old")
    versions.create_versions(view(spark, sf, "fx_snapshot_new"), f"{folder}/new")
    diff = versions.diff_versions(spark, (f"{folder}/old", None), (f"{folder}/new", None))
    return diff.select("key", _filled("old_version").alias("old_version"), _filled("new_version").alias("new_version"), "status")


def _merge_ordered(spark, sf) -> tuple[DataFrame, DataFrame]:
    return state.versioned_merge_ordered(
        view(spark, sf, "fx_user_target"), view(spark, sf, "fx_user_changes"), "seq", ["amount"]
    )


@query
def versioned_merge_ordered(spark, sf):
    merged = _merge_ordered(spark, sf)[0]
    return merged.select("key", "version", _filled("owner", "").alias("owner"), "amount")


@query
def versioned_merge_ordered_outcomes(spark, sf):
    return _merge_ordered(spark, sf)[1]


@query
def stale_keys(spark, sf):
    scanned = state.stale_keys(view(spark, sf, "fx_scans"), 2 * 86_400)
    never = F.lit("1970-01-01").cast(scanned.schema["last_change"].dataType)
    return scanned.select("key", "scan_order", F.coalesce("last_change", never).alias("last_change"), "stale")


@query
def owner_switches(spark, sf):
    counted = state.owner_switches(view(spark, sf, "fx_history"), is_checkpoint=F.col("is_checkpoint"))
    return counted.select("key", "scan_order", "owner_switches")


@query
def load_report(spark, sf):
    return state.load_report(view(spark, sf, "fx_assignments"), view(spark, sf, "fx_owners"))


@query
def load_report_capped(spark, sf):
    return state.load_report(view(spark, sf, "fx_assignments"), view(spark, sf, "fx_owners"), max_per_owner=90)


@query
def rebalance_expired(spark, sf):
    rows = view(spark, sf, "fx_assignments")
    report = state.load_report(rows, view(spark, sf, "fx_owners"))
    expired = rows.where("expired").agg(F.count(F.lit(1))).scalar()
    counts = state.rebalance_count(report, expired)
    return counts.select("owner", "needed", "take_expired", "take_moved")


@query
def rebalance_moved(spark, sf):
    rows = view(spark, sf, "fx_assignments").withColumn("expired", F.lit(False))
    counts = state.rebalance_count(state.load_report(rows, view(spark, sf, "fx_owners")), 0, 25)
    return counts.select("owner", "needed", "take_moved", _filled("moved_from", "").alias("moved_from"))


# ---- monitoring


@query
def slow_operations(spark, sf):
    return monitor.slow_operations(view(spark, sf, "fx_op_log"))


@query
def failure_streaks(spark, sf):
    events = table(spark, sf, "events").select((F.col("user_id") % 8).alias("shard_id"), "event_id", "event_type")
    failed = F.col("event_type").isin("error", "view", "click")
    counted = monitor.failure_streaks(events, "shard_id", "event_id", failed)
    return counted.select("event_id", "streak", _filled("severity", "").alias("severity"))


# ---- streams: each runs over all files of its table and returns what it wrote


def _read_stream(spark, sf, name: str) -> DataFrame:
    """A table, one file or a folder of many, as a stream."""
    schema = table(spark, sf, name).schema
    # a stream takes a file by a pattern only; this one fits just the table, and of a folder all files below it
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def _stream_of_files(df: DataFrame, label: str, files: int = 4) -> DataFrame:
    """All rows of ``df`` as a stream of several files, a micro-batch each."""
    path = work_folder(df.sparkSession, label)
    df.repartition(files).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _appended(stream: DataFrame, label: str, runs: int = 1) -> DataFrame:
    spark = stream.sparkSession
    path, checkpoint = work_folder(spark, label), work_folder(spark, "checkpoint")
    for _ in range(runs):
        stream_batches.resume_stream(stream, path, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _journal_stream(spark, sf) -> DataFrame:
    columns = {"conv_id": "entity_id", "turn": "seq", "text": "message"}
    return _read_stream(spark, sf, "conversations").withColumnsRenamed(columns)


@query
def stream_journal(spark, sf):
    path = work_folder(spark, "journal")
    stream = stream_journals.stream_journal(_journal_stream(spark, sf))
    stream_batches.write_snapshots(stream, path, work_folder(spark, "checkpoint"), "parquet").awaitTermination()
    written = spark.read.schema(stream.schema).parquet(path)
    # a later batch's row of an entity replaces the earlier one
    latest = F.max_by(F.struct("message_count", "last_message"), "version")
    return (
        written.groupBy("entity_id")
        .agg(F.max("version").alias("version"), latest.alias("s"))
        .select("entity_id", "version", "s.*")
    )


@query
def stream_journal_versions(spark, sf):
    with_state_store(spark)
    versions = stream_journals.stream_journal_versions(_journal_stream(spark, sf))
    return _appended(versions, "versions").drop("message")


@query
def append_journal_versions(spark, sf):
    folder, checkpoint = work_folder(spark, "versions"), work_folder(spark, "checkpoint")
    stream = _journal_stream(spark, sf)
    stream_journals.append_journal_versions(stream, folder, checkpoint).awaitTermination()
    return spark.read.parquet(f"{folder}/versions").select("entity_id", "seq", "version", "line")


@query
def stream_consumed_count(spark, sf):
    events = _stream_of_files(table(spark, sf, "events").selectExpr("user_id AS stream_id", "event_id", "ts"), "events")
    folder, checkpoint = work_folder(spark, "consumed"), work_folder(spark, "checkpoint")
    stream_delivery.stream_consumed_count(events, view(spark, sf, "fx_subscriptions"), folder, checkpoint).awaitTermination()
    return stream_delivery.consumed_so_far(spark, folder)


@query
def stream_stale_keys(spark, sf):
    with_state_store(spark)
    path = work_folder(spark, "versions")
    view(spark, sf, "fx_versions").write.parquet(path)
    scans = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    stale = _appended(stream_stale.stream_stale_keys(scans, dt.timedelta(days=3), delay="0 seconds"), "stale")
    never = F.lit("1970-01-01").cast("timestamp_ntz")
    return stale.select("key", F.coalesce(F.col("last_change").cast("timestamp_ntz"), never).alias("last_change"))


@query
def resume_stream(spark, sf):
    events = _read_stream(spark, sf, "events").select("event_id", "event_type")
    return _appended(events, "resumed", runs=2)


@query
def process_batches(spark, sf):
    done, refused = work_folder(spark, "done"), work_folder(spark, "refused")
    stream_batches.process_batches(
        _read_stream(spark, sf, "events").select("event_id", "user_id"),
        work_folder(spark, "checkpoint"),
        refused,
        lambda batch, n: batch.write.mode("overwrite").parquet(f"{done}/batch_id={n}"),
    )
    return spark.read.schema("event_id bigint, user_id bigint").parquet(done).select("event_id", "user_id")


def _envelope_stream(spark, sf) -> DataFrame:
    """Envelopes of two events each as a stream of four files, so that the parts of a batch come in different micro-batches."""
    with_state_store(spark)
    packed = _envelopes(spark, sf, max_events=2)
    return _stream_of_files(packed, "envelopes")


@query
def filter_stream(spark, sf):
    kept = stream_delivery.filter_stream(_envelope_stream(spark, sf), lambda e: e["role"] == "system")
    written = _appended(kept.select("entity_id", F.size("events").cast("long").alias("n")), "kept")
    return written.groupBy("entity_id").agg(F.sum("n").alias("n"))


@query
def unpack_stream(spark, sf):
    unpacked = stream_delivery.unpack_stream(_envelope_stream(spark, sf), lambda e: e["role"] == "assistant")
    return _appended(unpacked.select("entity_id", "event_index", F.col("event.message").alias("message")), "unpacked")


@query
def stream_observer(spark, sf):
    """What an observer hears of a stream of four files: rows, and one end."""
    stream = _stream_of_files(table(spark, sf, "events").select("event_id", "event_type"), "events")
    heard = []
    observer = stream_batches.StreamObserver(
        on_next=lambda n, rows: heard.append(("rows", rows)), on_completed=lambda: heard.append(("completed", 1))
    )
    spark.streams.addListener(observer)
    try:
        _appended(stream, "observed")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(observer)
    return spark.createDataFrame(heard, "call string, n long").groupBy("call").agg(F.sum("n").alias("n"))


@query
def publish_stream(spark, sf):
    path, checkpoint = work_folder(spark, "queues"), work_folder(spark, "checkpoint")
    events = _read_stream(spark, sf, "events").select("user_id", "event_id")
    sinks.publish_stream(events, path, checkpoint, "user_id").awaitTermination()
    return spark.read.schema("user_id bigint, event_id bigint, queue_id bigint").parquet(path)


def with_state_store(spark: SparkSession) -> None:
    """Keyed state handlers need the RocksDB store; set it where the session names no provider."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(name):
        spark.conf.set(name, ROCKSDB_STATE_STORE)
