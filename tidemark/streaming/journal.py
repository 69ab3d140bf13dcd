"""Journals as streams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.text import format_journal_line
from tidemark.operators.journal import journal_fold
from tidemark.plans.durable import cut_lineage, file_names, remove
from tidemark.plans.hot_ranges import find_hot_ranges
from tidemark.plans.lookup import join_one_per_key
from tidemark.plans.running import row_count, running
from tidemark.sources.sinks import ALL_AVAILABLE

# of entities in a base of positions
BUCKET, BUCKETS = "__bucket", 64


def stream_journal(
    stream: DataFrame, entity: str = "entity_id", order: str = "seq", message: str = "message"
) -> DataFrame:
    """The journal fold kept up to date; write it in update mode for one row per entity and batch."""
    return journal_fold(stream, entity, order, message)


class _Versions(StatefulProcessor):
    """Numbers an entity's events; remembers the version and the last sequence number."""

    def __init__(self, entity: str, order: str, message: str):
        self.entity, self.order, self.message = entity, order, message

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = T.StructType([T.StructField("version", T.LongType()), T.StructField("last", T.LongType())])
        self.state = handle.getValueState("position", kind)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        version, last = known = self.state.get() or (0, None)
        # an entity's share of one micro-batch; the trigger's size limit bounds it
        for row in sorted(rows, key=lambda r: r[self.order]):
            if last is None or row[self.order] > last:
                version, last = version + 1, row[self.order]
                yield Row(**{self.entity: row[self.entity], self.order: last, self.message: row[self.message], "version": version})
        if (version, last) != tuple(known):
            self.state.update((version, last))

    def close(self) -> None:
        pass


def stream_journal_versions(
    stream: DataFrame, entity: str = "entity_id", order: str = "seq", message: str = "message"
) -> DataFrame:
    """Every event with the version it led to; events at or below the entity's last sequence are replays and dropped."""
    names = [entity, order, message]
    slim = stream.select(*names)
    schema = T.StructType([*[slim.schema[n] for n in names], T.StructField("version", T.LongType())])
    numbered = slim.groupBy(entity).transformWithState(
        statefulProcessor=_Versions(entity, order, message),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )
    return numbered.withColumn("line", format_journal_line(entity, "version", message))


def _positions(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType, buckets: set[int]) -> DataFrame:
    """Positions as they were before a batch: the last base's rows of ``buckets`` and what the batches since it have changed."""
    ids = {kind: [int(n.split("=")[1]) for n in file_names(spark, f"{folder}/state") if n.startswith(kind)] for kind in ("base_id=", "batch_id=")}
    base = max((i for i in ids["base_id="] if i < batch_id), default=-1)
    parts = [spark.createDataFrame([], schema)]
    if base >= 0:
        # buckets are the base's partitions, so others are not read
        kept = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{folder}/state/base_id={base}")
        parts.append(kept.where(F.col(BUCKET).isin(sorted(buckets))).drop(BUCKET))
    since = [f"{folder}/state/batch_id={i}" for i in sorted(ids["batch_id="]) if base < i < batch_id]
    if since:
        parts.append(spark.read.schema(schema).parquet(*since))
    entity = schema.fieldNames()[0]
    # versions and sequence numbers only grow
    return reduce(DataFrame.unionByName, parts).groupBy(entity).agg(F.max("version").alias("version"), F.max("last").alias("last"))


def _compact(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType) -> None:
    """Write all positions after a batch as a new base; remove what no repetition of this batch would read."""
    entity = schema.fieldNames()[0]
    everything = _positions(spark, folder, batch_id + 1, schema, set(range(BUCKETS)))
    everything.withColumn(BUCKET, _bucket(entity)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{folder}/state/base_id={batch_id}")
    names = [(n, int(n.split("=")[1])) for n in file_names(spark, f"{folder}/state") if "_id=" in n]
    before = max((i for n, i in names if n.startswith("base_id=") and i < batch_id), default=-1)
    for name, i in names:
        if i < before or (i == before and name.startswith("batch_id=")):
            remove(spark, f"{folder}/state/{name}")


def _bucket(entity: str) -> Column:
    return F.pmod(F.xxhash64(F.col(entity)), F.lit(BUCKETS)).cast("int")


def append_journal_versions(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    entity: str = "entity_id",
    order: str = "seq",
    message: str = "message",
    rows_per_range: float | None = None,
    trigger: dict | None = None,
    compact_every: int = 10,
) -> StreamingQuery:
    """As :func:`stream_journal_versions`, also where one entity is a large share of a batch.

    Each micro-batch is numbered with the batch operators, which split hot entities, and
    written below ``folder/versions``. Versions and last sequence numbers of the entities of a batch go to
    ``folder/state/batch_id=...``; after every ``compact_every`` batches all are written as a new base, by bucket of entity, and
    what went before the last base is removed. A batch reads the base's buckets that its entities are in and the batches since,
    and writes in proportion to its own rows. All folders are named by the batch, so a repeated batch replaces itself.
    Returns once started; it takes what has arrived and stops.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slim = cut_lineage(batch.select(entity, order, message).dropDuplicates([entity, order]), "batch")
        position = T.StructType(
            [slim.schema[entity], T.StructField("version", T.LongType()), T.StructField("last", slim.schema[order].dataType)]
        )
        # at most BUCKETS rows
        buckets = {r[0] for r in slim.select(_bucket(entity)).distinct().toLocalIterator()}
        known = _positions(spark, folder, batch_id, position, buckets).join(slim.select(entity).distinct(), entity, "left_semi")
        placed = join_one_per_key(slim, known, [entity], rows_per_range)
        fresh = cut_lineage(placed.where(F.col("last").isNull() | (F.col(order) > F.col("last"))), "fresh")
        ranges = find_hot_ranges(fresh, [entity], [order], rows_per_range)
        numbered = running(fresh, [entity], [order], {"__n": row_count()}, ranges)
        version = F.coalesce("version", F.lit(0)) + F.col("__n")
        numbered.select(entity, order, message, version.alias("version")).select(
            "*", format_journal_line(entity, "version", message).alias("line")
        ).write.mode("overwrite").parquet(f"{folder}/versions/batch_id={batch_id}")
        reached = F.coalesce(F.max("version"), F.lit(0)) + F.count(F.lit(1))
        after = fresh.groupBy(entity).agg(reached.alias("version"), F.max(order).alias("last"))
        after.write.mode("overwrite").parquet(f"{folder}/state/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            _compact(spark, folder, batch_id, position)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start()
