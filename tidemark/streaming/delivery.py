"""Running consumer counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.delivery import consumed_count
from tidemark.sources.sinks import ALL_AVAILABLE
from tidemark.streaming.parts import filter_stream, unpack_stream

__all__ = ["consumed_so_far", "filter_stream", "stream_consumed_count", "unpack_stream"]


def stream_consumed_count(
    stream: DataFrame,
    subscriptions: DataFrame,
    folder: str,
    checkpoint: str,
    keys: Sequence[str] = ("stream_id",),
    ts: str = "ts",
    rows_per_range: float | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count per micro-batch what each consumer received of it; :func:`consumed_so_far` adds the batches up.

    A batch is counted by ``consumed_count``, so no event meets its subscriptions in pairs. Its counts go to a folder named
    by the batch below ``folder``, so a repeated batch replaces itself. ``subscriptions`` is a static table, read anew per
    batch. Returns once started; by default it takes what has arrived and stops.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = consumed_count(batch.select(*keys, ts), subscriptions, keys, ts, rows_per_range)
        counts.where("consumed > 0").write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start()


def consumed_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """Events per consumer over all batches below ``folder``; consumers that received nothing have no row."""
    return spark.read.parquet(folder).groupBy("consumer").agg(F.sum("consumed").alias("consumed"))
