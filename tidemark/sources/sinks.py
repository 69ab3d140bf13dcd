"""Writing envelopes and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.hashing import DEFAULT_QUEUES, route_to_queue
from tidemark.operators.envelopes import require_events

SNAPSHOT_FORMATS = ("json", "parquet")
ALL_AVAILABLE = {"availableNow": True}


def with_queue(
    envelopes: DataFrame, stream: str = "stream_id", namespace: str | None = None, n: int = DEFAULT_QUEUES
) -> DataFrame:
    """Envelopes with their queue. A sequence token set by the caller raises an error (queues number on read), as do null events."""
    if "events" in envelopes.columns:
        envelopes = require_events(envelopes)
    if "seq" in envelopes.columns:
        refuse = F.raise_error(F.lit("a sequence token cannot be chosen by the writer"))
        kind = envelopes.schema["seq"].dataType
        envelopes = envelopes.withColumn("seq", F.when(F.col("seq").isNull(), F.col("seq")).otherwise(refuse.cast(kind)))
    return envelopes.withColumn("queue_id", route_to_queue(stream, namespace, n))


def publish(
    envelopes: DataFrame,
    path: str,
    stream: str = "stream_id",
    namespace: str | None = None,
    n: int = DEFAULT_QUEUES,
) -> None:
    """Append envelopes below ``path``, one folder per queue.

    The rebalance hint gives each queue few files and splits a queue that is far
    larger than the rest over several tasks.
    """
    routed = with_queue(envelopes, stream, namespace, n)
    routed.hint("rebalance", F.col("queue_id")).write.partitionBy("queue_id").mode("append").parquet(path)


def publish_stream(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    stream: str = "stream_id",
    namespace: str | None = None,
    n: int = DEFAULT_QUEUES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream of envelopes below ``path``; the file sink writes each batch exactly once.

    ``trigger`` is as for ``DataStreamWriter.trigger``, by default all that is available now.
    """
    return (
        with_queue(envelopes, stream, namespace, n)
        .writeStream.format("parquet")
        .partitionBy("queue_id")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AVAILABLE))
        .start(path)
    )


def snapshot_writer(state: DataFrame, fmt: str = "json") -> DataFrameWriter:
    if fmt not in SNAPSHOT_FORMATS:
        raise ValueError(f"snapshot format must be one of {SNAPSHOT_FORMATS}, got {fmt!r}")
    return state.write.format(fmt).mode("overwrite")


def write_snapshot(state: DataFrame, path: str, batch_id: int, fmt: str = "json") -> str:
    """Write the state of one batch to its own folder; writing the same batch again replaces it."""
    folder = f"{path}/batch_id={batch_id}"
    snapshot_writer(state, fmt).save(folder)
    return folder


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, batch: int = 1_000) -> dict:
    options = {"url": url, "dbtable": table, "batchsize": str(batch)}
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def write_jdbc(state: DataFrame, url: str, table: str, mode: str = "append", writers: int = 16, **options: str) -> None:
    """Write state rows to a relational table over at most ``writers`` connections."""
    state.repartition(writers).write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()
