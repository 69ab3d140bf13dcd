"""Consuming laid-out records by a position per shard, kept in a table of versions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.sequence import TRIM_HORIZON, seq_key
from tidemark.operators.consume import after_checkpoint
from tidemark.operators.transitions import CREATE, UPDATE
from tidemark.plans.durable import cut_lineage
from tidemark.sources import versions
from tidemark.sources.records import SEQ_DIGITS, SEQ_LENGTH, bounded_batch, files_beyond, start_position

POSITION = ["sequence_number", "sub_sequence"]


@dataclass(frozen=True)
class ShardConsumer:
    """Reads the records that ``write_records`` put below ``path`` on from a position per shard.

    ``folder`` holds the positions, one row per shard in a table of versions, and the batch in work. A batch has at most
    ``limit`` records of a shard, the first ones beyond its position. It is written, processed, and then the positions are committed;
    so after a crash the same batch comes again under the same number, and of two consumers of one folder one
    fails at its commit. ``position`` and what goes with it (as for ``start_position``) count once, for the shards there are at the
    first start. A shard that appears later is read from its first record. Records must come in rising order within a shard.
    """

    spark: SparkSession
    path: str
    folder: str
    position: str = TRIM_HORIZON
    limit: int = -1
    ts: str | None = None
    seq: str | None = None
    sub: int = 0

    def positions(self) -> DataFrame:
        """key (the shard), version, owner, sequence_number and sub_sequence; the version counts a shard's commits."""
        return versions.read_version(self.spark, f"{self.folder}/positions")

    def _begin(self) -> None:
        """Positions of the first start: the last record before those that the start position asks for."""
        records = self.spark.read.parquet(self.path)
        columns = ["shard_id", *POSITION]
        wanted = start_position(records, self.position, self.ts, self.seq, self.sub).select(*columns)
        first = wanted.groupBy("shard_id").agg(F.min(seq_key(*POSITION)).alias("__first"))
        key = seq_key(*POSITION)
        # one row per shard, so it can be broadcast or met by a merge without moving the records by more than their shard
        before = records.select(*columns).join(first, "shard_id", "left").where(F.col("__first").isNull() | (key < F.col("__first")))
        last = before.groupBy("shard_id").agg(F.max_by(F.struct(*POSITION), seq_key(*POSITION)).alias("m")).select("shard_id", "m.*")
        shards = records.select("shard_id").distinct().join(last, "shard_id", "left")
        start = shards.select(
            F.col("shard_id").alias("key"),
            F.lit(0).cast("long").alias("version"),
            F.lit(None).cast("string").alias("owner"),
            F.coalesce("sequence_number", F.lit(TRIM_HORIZON)).alias("sequence_number"),
            F.coalesce(F.col("sub_sequence").cast("long"), F.lit(0)).alias("sub_sequence"),
        )
        versions.create_versions(start, f"{self.folder}/positions")

    def _next(self, known: DataFrame, schema: T.StructType) -> DataFrame:
        """The first ``limit`` records of every shard beyond its position; only files with such records are read."""
        marks = known.withColumnRenamed("key", "shard_id")
        files = files_beyond(self.spark, self.path, marks)
        if not files:
            return self.spark.createDataFrame([], schema)
        records = self.spark.read.schema(schema).option("basePath", self.path).parquet(*files)
        return bounded_batch(after_checkpoint(records, marks), self.limit)

    def run(self, process: Callable[[DataFrame, int], None], most_batches: int | None = None) -> int:
        """``process(batch, number)`` until nothing is left, or for ``most_batches``; how many there were.

        ``process`` may see a batch again after a crash, with the same rows and number. An error of it ends the run before the commit.
        """
        done = 0
        if not versions.versions(self.spark, f"{self.folder}/positions"):
            self._begin()
        while most_batches is None or done < most_batches:
            number = versions.versions(self.spark, f"{self.folder}/positions")[-1]
            known = versions.read_version(self.spark, f"{self.folder}/positions", number)
            schema = T.StructType([f for f in self.spark.read.parquet(self.path).schema.fields if f.name != "written"])
            place = f"{self.folder}/batches/batch_id={number}"
            try:
                # only a whole batch has been marked as done by Spark
                self.spark.read.text(f"{place}/whole").count()
            except AnalysisException:
                self._next(known, schema).write.mode("overwrite").parquet(f"{place}/rows")
                self.spark.range(1, numPartitions=1).select(F.lit("whole").alias("value")).write.mode("overwrite").text(f"{place}/whole")
            batch = self.spark.read.schema(schema).parquet(f"{place}/rows")
            moved = batch.groupBy("shard_id").agg(F.max_by(F.struct(*POSITION), seq_key(*POSITION)).alias("m"))
            moved = cut_lineage(moved.select(F.col("shard_id").alias("key"), "m.*"), "moved")
            if moved.isEmpty():
                versions.remove(self.spark, place)
                break
            process(batch.drop(SEQ_LENGTH, SEQ_DIGITS), number)
            op = F.when(F.col("version").isNull(), CREATE).otherwise(UPDATE)
            changes = moved.join(known.select("key", "version"), "key", "left").select(
                "key",
                op.alias("op"),
                F.col("version").alias("expected_version"),
                F.lit(None).cast("string").alias("expected_owner"),
                F.lit(None).cast("string").alias("new_owner"),
                "sequence_number",
                F.coalesce(F.col("sub_sequence").cast("long"), F.lit(0)).alias("sub_sequence"),
            )
            outcomes = versions.commit_merge(changes, f"{self.folder}/positions", POSITION, base=number)
            if not outcomes.where("not applied").isEmpty():
                raise RuntimeError(f"another consumer of {self.folder} has committed batch {number}")
            versions.remove(self.spark, place)
            done += 1
        return done
