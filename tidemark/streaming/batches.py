"""Running streams: resuming, user callbacks per batch, observers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.sources.sinks import ALL_AVAILABLE, write_snapshot


def resume_stream(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append what has arrived to ``path``; the next start goes on after the last committed position."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AVAILABLE))
        .start(path)
    )


def write_snapshots(
    state: DataFrame, path: str, checkpoint: str, fmt: str = "json", trigger: dict | None = None
) -> StreamingQuery:
    """Write the rows each batch updates to a folder of that batch; a repeated batch replaces its own."""
    return (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, n: write_snapshot(batch, path, n, fmt) and None)
        .trigger(**(trigger or ALL_AVAILABLE))
        .start()
    )


def process_batches(
    stream: DataFrame,
    checkpoint: str,
    quarantine: str,
    process: Callable[[DataFrame, int], None],
    initialize: Callable[[], None] | None = None,
    shutdown: Callable[[str], None] | None = None,
    on_error: Callable[[int, Exception], None] | None = None,
    call_on_empty: bool = False,
    output_mode: str = "append",
    trigger: dict | None = None,
    on_start: Callable[[StreamingQuery], None] | None = None,
) -> None:
    """Run ``process(batch, batch_id)`` for everything that has arrived, then return; with a continuing ``trigger``, until the query stops.

    ``on_start`` gets the running query, to stop it.

    A batch whose processing raises is written below ``quarantine`` and skipped; consumption
    goes on. ``shutdown`` gets "finished", or "failed" if the stream itself broke. A
    batch may come again after a crash, with the same number.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not call_on_empty and batch.isEmpty():
            return
        try:
            process(batch, batch_id)
        except Exception as problem:  # noqa: BLE001 - whatever user code raises
            batch.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
            if on_error:
                on_error(batch_id, problem)

    if initialize:
        initialize()
    reason = "failed"
    try:
        query = (
            stream.writeStream.outputMode(output_mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(handle)
            .trigger(**(trigger or ALL_AVAILABLE))
            .start()
        )
        if on_start:
            on_start(query)
        query.awaitTermination()
        reason = "finished"
    finally:
        if shutdown:
            shutdown(reason)


class StreamObserver(StreamingQueryListener):
    """Calls back for every batch of a query, for its failure and for its end."""

    def __init__(
        self,
        on_next: Callable[[int, int], None] | None = None,
        on_error: Callable[[str], None] | None = None,
        on_completed: Callable[[], None] | None = None,
    ):
        self.on_next, self.on_error, self.on_completed = on_next, on_error, on_completed

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.on_next:
            self.on_next(event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            if self.on_error:
                self.on_error(event.exception)
        elif self.on_completed:
            self.on_completed()
