"""Reading on from checkpoints: filtering, marks, commits, lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sequence import SHARD_END, seq_key, validate_sequence
from tidemark.plans.hot_ranges import find_hot_ranges
from tidemark.plans.running import greatest_before, running

ACCEPTED, REJECTED, NO_OP = "accepted", "rejected", "no-op"


def after_checkpoint(
    records: DataFrame,
    checkpoints: DataFrame,
    shard: str = "shard_id",
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
) -> DataFrame:
    """Records beyond their shard's checkpoint; a shard without one keeps all its records.

    An anti join with the comparison in its condition. Spark broadcasts the checkpoints
    if they are small; otherwise adaptive execution splits a hot shard's partition.
    """
    marks = checkpoints.select(F.col(shard).alias("__shard"), seq_key(sequence_number, sub_sequence).alias("__mark"))
    passed = (F.col(shard) == F.col("__shard")) & (seq_key(sequence_number, sub_sequence) <= F.col("__mark"))
    return records.join(marks, passed, "left_anti")


def high_water_mark(
    records: DataFrame,
    checkpoints: DataFrame | None = None,
    prior: DataFrame | None = None,
    shard: str = "shard_id",
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
) -> DataFrame:
    """Per shard the greatest sequence number beyond the checkpoint, never below ``prior``.

    The greatest record survives the checkpoint if any record does, so the maximum is
    taken first and only one row per shard meets the checkpoints.
    """

    def marked(df: DataFrame) -> DataFrame:
        value = F.struct(seq_key(sequence_number, sub_sequence).alias("key"), sequence_number, sub_sequence)
        return df.groupBy(shard).agg(F.max(value).alias("m"))

    top = marked(records).select(shard, "m.*").drop("key")
    if checkpoints is not None:
        top = after_checkpoint(top, checkpoints, shard, sequence_number, sub_sequence)
    if prior is not None:
        columns = [shard, sequence_number, sub_sequence]
        top = marked(top.select(*columns).unionByName(prior.select(*columns))).select(shard, "m.*").drop("key")
    return top


def checkpoint_commit(
    requests: DataFrame,
    state: DataFrame,
    shard: str = "shard_id",
    order: str = "request_order",
    rows_per_range: float | None = None,
) -> DataFrame:
    """Outcome of each checkpoint request, taken in order per shard.

    ``requests``: shard, order, sequence_number, sub_sequence. ``state``, one row per shard:
    last_sequence, last_sub, mark_sequence, mark_sub, end_sequence (null while the shard
    is open); the mark is not below the last checkpoint. A request is accepted between
    the last checkpoint and the mark and then is the last checkpoint; one equal to it is
    a no-op; one at the shard's end is recorded as SHARD_END. A request without a number
    commits the mark. A malformed number raises an error.

    A request below the last checkpoint never raises the maximum and one above the mark
    is left out of it, so the last checkpoint is the running maximum of earlier requests.
    """
    known = state.select(
        F.col(shard).alias("__shard"),
        seq_key("last_sequence", "last_sub").alias("__start"),
        F.struct(
            seq_key("mark_sequence", "mark_sub").alias("key"),
            F.col("mark_sequence").alias("seq"),
            F.col("mark_sub").cast("long").alias("sub"),
        ).alias("__top"),
        F.when(F.col("end_sequence").isNotNull(), seq_key("end_sequence", F.lit(0))).alias("__end"),
    )
    text, sub = F.col("sequence_number"), F.coalesce(F.col("sub_sequence").cast("long"), F.lit(0))
    refuse = F.raise_error(F.concat(F.lit("invalid checkpoint "), text, F.lit("/"), sub.cast("string")))
    checked = F.when(text.isNull() | validate_sequence(text, sub), text).otherwise(refuse.cast("string"))
    joined = requests.withColumn("__text", checked).join(known, F.col(shard) == F.col("__shard"), "left")
    end = F.struct(seq_key(F.lit(SHARD_END)).alias("key"), F.lit(SHARD_END).alias("seq"), F.lit(0).cast("long").alias("sub"))
    asked = F.when(
        F.col("__text").isNotNull(),
        F.struct(seq_key("__text", sub).alias("key"), F.col("__text").alias("seq"), sub.alias("sub")),
    ).otherwise(F.col("__top"))
    new = F.col("__new")
    valued = (
        joined.withColumn("__new", asked)
        .withColumn("__unchecked", F.col("__text").isNull() & F.col("__top").isNotNull())
        .withColumn(
            "__in_range",
            F.coalesce((new["key"] >= F.col("__start")) & (new["key"] <= F.col("__top.key")), F.lit(False)),
        )
        .withColumn(
            "__recorded",
            F.when((new["key"] == F.col("__end")) & (new["key"] != F.col("__start")), end).otherwise(new),
        )
    )
    candidate = F.when(F.col("__in_range"), F.col("__recorded.key"))
    # ranges depend on the requests alone, not on the state
    ranges = find_hot_ranges(requests, [shard], [order], rows_per_range)
    walked = running(valued, [shard], [order], {"__earlier": greatest_before(candidate)}, ranges)
    last = F.greatest(F.col("__earlier"), F.col("__start"))
    outcome = (
        F.when(F.col("__shard").isNull(), REJECTED)
        .when(new["key"] == last, NO_OP)
        .when(F.col("__unchecked"), ACCEPTED)
        .when(F.col("__in_range") & (last <= new["key"]), ACCEPTED)
        .otherwise(REJECTED)
    )
    accepted = F.col("outcome") == ACCEPTED
    return walked.withColumn("outcome", outcome).select(
        *requests.columns,
        "outcome",
        F.when(accepted, F.col("__recorded.seq")).alias("recorded_sequence"),
        F.when(accepted, F.col("__recorded.sub")).alias("recorded_sub"),
    )


def finished_shards(
    shards: DataFrame,
    progress: DataFrame,
    shard: str = "shard_id",
    end_sequence: str = "end_seq",
    sequence_number: str = "sequence_number",
    sub_sequence: str = "sub_sequence",
) -> DataFrame:
    """Closed shards whose last processed record is at or past the shard's ending sequence number."""
    done = progress.select(F.col(shard).alias("__shard"), seq_key(sequence_number, sub_sequence).alias("__done"))
    closed = shards.where(F.col(end_sequence).isNotNull())
    reached = (F.col(shard) == F.col("__shard")) & (F.col("__done") >= seq_key(end_sequence))
    return closed.join(done, reached, "left_semi")


def shard_throughput(records: DataFrame, shard: str = "shard_id", data: str = "data") -> DataFrame:
    """Records and payload bytes per shard."""
    return records.groupBy(shard).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.octet_length(data).cast("long")), F.lit(0)).alias("bytes"),
    )


def shard_lag(
    records: DataFrame,
    progress: DataFrame,
    shard: str = "shard_id",
    arrival_ts: str = "arrival_ts",
    processed_ts: str = "processed_ts",
) -> DataFrame:
    """Whole milliseconds from the last processed record's arrival to the shard tip's.

    A shard that was never processed has a null lag.
    """
    tip = records.groupBy(shard).agg(F.max(arrival_ts).alias("tip_ts"))
    micros = F.timestamp_diff("MICROSECOND", F.col(processed_ts), F.col("tip_ts"))
    return tip.join(progress.select(shard, processed_ts), shard, "left").select(
        shard, "tip_ts", processed_ts, F.floor(micros / F.lit(1000)).cast("long").alias("lag_ms")
    )

