"""Reading shard records from a position."""

from __future__ import annotations

import datetime as dt
import urllib.parse
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import sequence as s
from tidemark.plans.running import first_rows

# Used where a read asks for a negative number of records, that is, no limit of its own.
MAX_RECORDS_PER_READ = 10_000

# The plain columns that laid-out records carry: a number's count of digits, and its digits, without leading zeros.
SEQ_LENGTH, SEQ_DIGITS = "seq_length", "seq_digits"
# Beside the records; Spark's readers skip folders that begin so.
INDEX = "_sequence_index"
SHARD_INDEX = "_shard_index"
INDEX_SCHEMA = "file string, least_length int, least_digits string, most_length int, most_digits string"


def write_records(
    records: DataFrame,
    path: str,
    shard: str = "shard_id",
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
) -> None:
    """Append ``records`` to the parquet folder ``path``, laid out so that a read from a sequence number finds its files.

    Files are ranges of shard and sequence (a large shard is several files), sorted, and each carries its number as plain columns whose bounds Parquet
    keeps per row group. The bounds of each file go to an index beside them. Each call writes a folder of its own, first the
    records and then their index, so a file that an interrupted call left without one is read, not missed.
    Sequence numbers must be digits.
    """
    spark = records.sparkSession
    key = s.seq_key(sequence_number, sub_sequence)
    refuse = F.raise_error(F.concat(F.lit("a record needs a sequence number of digits, got "), F.col(sequence_number))).cast("int")
    length = F.when(key["rank"] == 0, key["length"]).otherwise(refuse)
    laid = records.withColumns({SEQ_LENGTH: length, SEQ_DIGITS: key["digits"]})
    order = [shard, SEQ_LENGTH, SEQ_DIGITS]
    batch = f"{path.rstrip('/')}/written={uuid.uuid4().hex}"
    laid.repartitionByRange(*order).sortWithinPartitions(*order, sub_sequence).write.parquet(batch)
    number = F.struct(SEQ_LENGTH, SEQ_DIGITS)
    # reads two columns of what was just written
    bounds = (
        spark.read.parquet(batch)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(number).alias("least"), F.max(number).alias("most"))
        .select("file", *[F.col(f"{side}.seq_{part}").alias(f"{side}_{part}") for side in ("least", "most") for part in ("length", "digits")])
    )
    bounds.write.mode("append").parquet(f"{path.rstrip('/')}/{INDEX}")
    # the last record of each shard in each file, for reads from a position per shard
    of_shard = spark.read.parquet(batch).groupBy(F.col("_metadata.file_path").alias("file"), F.col(shard).alias("shard"))
    last = F.max_by(F.struct(F.col(sequence_number).alias("sequence_number"), F.col(sub_sequence).alias("sub_sequence")), key)
    of_shard.agg(last.alias("m")).select("file", "shard", "m.*").write.mode("append").parquet(f"{path.rstrip('/')}/{SHARD_INDEX}")


def _from_plain_columns(position: str, seq: str, sub: int, sub_sequence: str) -> Column:
    """The condition of a read from a sequence number, on plain columns, so that it reaches the parquet scan."""
    digits = seq.lstrip("0")
    length, own = F.col(SEQ_LENGTH), F.col(SEQ_DIGITS)
    not_before = (length > len(digits)) | ((length == len(digits)) & (own >= digits))
    same = (length == len(digits)) & (own == digits)
    sub_value = F.coalesce(F.col(sub_sequence).cast("long"), F.lit(0))
    later = sub_value >= sub if position == s.AT_SEQUENCE_NUMBER else sub_value > sub
    return (length >= len(digits)) & not_before & (~same | later)


def _files_from(spark: SparkSession, records: DataFrame, path: str, seq: str) -> list[str] | None:
    """Files of the folder that may hold ``seq`` or later numbers; None if no index says so."""
    try:
        index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path.rstrip('/')}/{INDEX}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    digits = seq.lstrip("0")
    before = (F.col("most_length") < len(digits)) | ((F.col("most_length") == len(digits)) & (F.col("most_digits") < digits))
    # names of files, of which the reader's own listing holds as many
    passed = {urllib.parse.urlsplit(row["file"]).path for row in index.where(before).select("file").toLocalIterator()}
    return [file for file in records.inputFiles() if urllib.parse.urlsplit(file).path not in passed]


def _place(file: str) -> str:
    return urllib.parse.urlsplit(file).path


def files_beyond(spark: SparkSession, path: str, marks: DataFrame) -> list[str]:
    """Files that :func:`write_records` wrote below ``path`` and that hold records beyond ``marks`` (shard_id, sequence_number, sub_sequence).

    A shard without a mark is read from its first record. A file that no index names is among them.
    """
    there = spark.read.parquet(path).inputFiles()
    try:
        index = spark.read.parquet(f"{path.rstrip('/')}/{SHARD_INDEX}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return list(there)
    mark = marks.select(F.col("shard_id").alias("shard"), s.seq_key("sequence_number", "sub_sequence").alias("__mark"))
    beyond = F.col("__mark").isNull() | (s.seq_key("sequence_number", "sub_sequence") > F.col("__mark"))
    # names of files, of which the reader's own listing holds as many
    wanted = {_place(r["file"]) for r in index.join(mark, "shard", "left").where(beyond).select("file").distinct().toLocalIterator()}
    named = {_place(r["file"]) for r in index.select("file").distinct().toLocalIterator()}
    return [file for file in there if _place(file) in wanted or _place(file) not in named]


def start_position(
    records: DataFrame,
    position: str,
    ts: dt.datetime | str | None = None,
    seq: str | None = None,
    sub: int = 0,
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
    arrival_ts: str = "arrival_ts",
) -> DataFrame:
    """Records from ``position`` on. LATEST and SHARD_END keep none of the rows that are already there."""
    if position is None:
        raise ValueError("a read position is required")
    if position == s.TRIM_HORIZON:
        return records
    if position in (s.LATEST, s.SHARD_END):
        return records.where(F.lit(False))
    if position == s.AT_TIMESTAMP:
        if ts is None:
            raise ValueError("AT_TIMESTAMP needs ts")
        # a text literal of the column's own type: no time zone comes in, and the filter reaches the parquet scan
        text = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else ts
        return records.where(F.col(arrival_ts) >= F.lit(text).cast(records.schema[arrival_ts].dataType))
    if position in (s.AT_SEQUENCE_NUMBER, s.AFTER_SEQUENCE_NUMBER):
        if seq is None or not (seq.isascii() and seq.isdigit()):
            raise ValueError(f"{position} needs a sequence number of digits, got {seq!r}")
        if SEQ_LENGTH in records.columns:
            return records.where(_from_plain_columns(position, seq, sub, sub_sequence))
        key = s.seq_key(sequence_number, sub_sequence)
        bound = s.seq_key(F.lit(seq), F.lit(sub))
        return records.where(key >= bound if position == s.AT_SEQUENCE_NUMBER else key > bound)
    raise ValueError(f"unknown read position {position!r}")


def scan_records(
    spark: SparkSession,
    path: str,
    position: str,
    ts: dt.datetime | str | None = None,
    seq: str | None = None,
    schema: T.StructType | None = None,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Records of a parquet folder from ``position`` on, as a table or (``streaming``) as a stream.

    Of a folder that :func:`write_records` laid out, a read from a sequence number opens only the files whose bounds in the index
    reach it, and only their row groups that do.

    A stream at LATEST reads the files written after ``ts``, by default after its first start, which is
    kept beside ``checkpoint``, the query's own, so that a restart leaves out no file that came in between.
    """
    if streaming:
        if schema is None:
            raise ValueError("a stream needs a schema")
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        records = reader.parquet(path)
        if position == s.LATEST:
            if ts is None and checkpoint is None:
                raise ValueError("a stream at LATEST needs ts or the checkpoint of its query")
            since = ts or _first_start(spark, checkpoint)
            text = since.isoformat(sep=" ") if isinstance(since, dt.datetime) else since
            return records.where(F.col("_metadata.file_modification_time") > F.lit(text).cast("timestamp"))
    else:
        reader = spark.read.schema(schema) if schema else spark.read
        records = reader.parquet(path)
        if SEQ_LENGTH in records.columns and position in (s.AT_SEQUENCE_NUMBER, s.AFTER_SEQUENCE_NUMBER) and seq and seq.isdigit():
            files = _files_from(spark, records, path, seq)
            if files is not None:
                found = spark.read.schema(records.schema).option("basePath", path).parquet(*files) if files else records.where("false")
                records = found
    kept = start_position(records, position, ts, seq)
    return kept.drop(SEQ_LENGTH, SEQ_DIGITS, "written") if SEQ_LENGTH in records.columns else kept


def _first_start(spark: SparkSession, checkpoint: str) -> str:
    """When a stream with this checkpoint was first started: written once, then read."""
    path = f"{checkpoint.rstrip('/')}-first-start"
    spark.range(1, numPartitions=1).select(F.current_timestamp().alias("started")).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).select(F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")).first()[0]


def bounded_batch(
    records: DataFrame,
    limit: int,
    shard: str = "shard_id",
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
    configured_max: int = MAX_RECORDS_PER_READ,
    rows_per_range: float | None = None,
) -> DataFrame:
    """What one read returns: at most ``limit`` records per shard, in sequence order.

    A negative limit means the configured maximum; any other limit is taken as it is.
    """
    n = configured_max if limit < 0 else limit
    keyed = records.withColumn("__seq", s.seq_key(sequence_number, sub_sequence))
    return first_rows(keyed, [shard], ["__seq"], n, rows_per_range).drop("__seq")


def union_queues(queues: dict[int, DataFrame]) -> DataFrame:
    """Several queues as one feed, each row tagged with its queue."""
    if not queues:
        raise ValueError("no queues")
    tagged = [df.withColumn("queue_id", F.lit(q).cast("long")) for q, df in queues.items()]
    feed = tagged[0]
    for df in tagged[1:]:
        feed = feed.unionByName(df)
    return feed
