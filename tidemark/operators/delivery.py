"""Producers, consumers and acknowledgements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.hot_ranges import RANGE, find_hot_ranges
from tidemark.plans.lookup import join_one_per_key
from tidemark.plans.running import running, running_since, total

ACKED, REDELIVER, PENDING = "acked", "redeliver", "pending"


def deliver(
    events: DataFrame,
    subscriptions: DataFrame,
    stream: Sequence[str] = ("stream_id",),
    ts: str = "ts",
    rows_per_range: float | None = None,
) -> DataFrame:
    """One row per event and subscription that was live at the event's time, start included, stop excluded.

    Two live subscriptions of a consumer to a stream deliver an event twice. The timeline of a stream with more than
    ``rows_per_range`` events is cut into ranges, and a subscription meets the ranges it was live in: no task holds all
    events of a hot stream, and events are not compared with subscriptions of other times. ``math.inf`` saves the count of events.
    """
    live = subscriptions.select(
        *[F.col(s).alias(f"__{s}") for s in stream],
        "consumer",
        F.col("start_ts").cast(events.schema[ts].dataType).alias("__start"),
        F.col("stop_ts").cast(events.schema[ts].dataType).alias("__stop"),
    ).where(F.col("__stop").isNull() | (F.col("__start") < F.col("__stop")))
    match = (F.col(ts) >= F.col("__start")) & (F.col("__stop").isNull() | (F.col(ts) < F.col("__stop")))
    for s in stream:
        match = match & (F.col(s) == F.col(f"__{s}"))
    ranges = find_hot_ranges(events, list(stream), [ts], rows_per_range)
    if ranges is None:
        return events.join(live, match).select("consumer", *events.columns)
    spread = ranges.tag_spans(live, [f"__{s}" for s in stream], {ts: "__start"}, {ts: "__stop"}, "__live_in")
    # null for streams that are not cut
    match = match & F.col(RANGE).eqNullSafe(F.col("__live_in"))
    return ranges.tag(events).join(spread, match).select("consumer", *events.columns)


def consumed_count(
    events: DataFrame,
    subscriptions: DataFrame,
    stream: Sequence[str] = ("stream_id",),
    ts: str = "ts",
    rows_per_range: float | None = None,
) -> DataFrame:
    """Events received per consumer over all its subscriptions; 0 if none.

    No delivery is materialised: subscription starts and stops are merged into each
    stream's timeline, and a subscription received the events counted up to its stop
    less those counted up to its start. The cost is that of one scan of the timeline,
    whatever the number of subscriptions per stream.
    """
    stream = list(stream)
    no_consumer = F.lit(None).cast(subscriptions.schema["consumer"].dataType)
    marked = events.select(
        *stream,
        F.lit(0).alias("__open"),
        F.col(ts).alias("__ts"),
        F.lit(1).alias("__event"),
        no_consumer.alias("consumer"),
        F.lit(0).alias("__sign"),
    )
    # a subscription that stops before it starts receives nothing
    sign = F.when(F.col("stop_ts").isNull() | (F.col("stop_ts") > F.col("start_ts")), 1).otherwise(0)
    edges = F.explode(
        F.array(
            F.struct(F.lit(0).alias("open"), F.col("start_ts").alias("ts"), (-sign).alias("sign")),
            F.struct(
                F.when(F.col("stop_ts").isNull(), 1).otherwise(0).alias("open"),
                F.col("stop_ts").alias("ts"),
                sign.alias("sign"),
            ),
        )
    )
    bounds = subscriptions.select(*stream, "consumer", edges.alias("e")).select(
        *stream,
        F.col("e.open").alias("__open"),
        F.col("e.ts").alias("__ts"),
        F.lit(0).alias("__event"),
        "consumer",
        F.col("e.sign").alias("__sign"),
    )
    # a bound sorts before the events of its own time, an open stop after all events
    order = ["__open", "__ts", "__event"]
    # any ranges will do, so they are looked for before the join
    ranges = find_hot_ranges(marked.unionByName(bounds), stream, order, rows_per_range)
    heard = marked.join(subscriptions.select(*stream).distinct(), stream, "left_semi")
    timeline = heard.unionByName(bounds)
    counted = running(timeline, stream, order, {"__seen": total(F.col("__event"))}, ranges)
    return (
        counted.where(F.col("__event") == 0)
        .groupBy("consumer")
        .agg(F.sum(F.col("__sign") * F.col("__seen")).alias("consumed"))
    )


def reset_counter(
    events: DataFrame, key: str, order: str, is_reset: Column, rows_per_range: float | None = None
) -> DataFrame:
    """Per row the counter after it, and the value it emitted: the count before it, null on a reset."""
    ranges = find_hot_ranges(events, [key], [order], rows_per_range)
    counted = running_since(events, [key], [order], F.lit(True), is_reset, "counter", ranges)
    emitted = F.when(~F.coalesce(is_reset, F.lit(False)), F.col("counter") - 1)
    return counted.withColumn("emitted", emitted)


def produced_count(
    events: DataFrame, key: str, order: str, is_reset: Column, rows_per_range: float | None = None
) -> DataFrame:
    """Items produced per producer since its last reset.

    Needs no order among the rows, only whether each lies behind the last reset, so this
    is two aggregates and a join instead of the running counter's sort.
    """
    slim = events.select(key, F.col(order).alias("__order"), F.coalesce(is_reset, F.lit(False)).alias("__reset"))
    last_reset = slim.where("__reset").groupBy(key).agg(F.max("__order").alias("__last"))
    placed = join_one_per_key(slim, last_reset, [key], rows_per_range)
    behind = F.col("__last").isNull() | (F.col("__order") > F.col("__last"))
    return placed.groupBy(key).agg(F.count_if(behind & ~F.col("__reset")).alias("produced"))


def reconcile_acks(
    pending: DataFrame, delivered: DataFrame, queue: str = "queue_id", token: str = "token"
) -> DataFrame:
    """Status of every pending message. Up to the queue's greatest delivered token a message is
    ``acked`` if it was delivered and ``redeliver`` if not; beyond it, it stays ``pending``."""
    high = delivered.groupBy(queue).agg(F.max(token).alias("__high"))
    seen = delivered.select(queue, token).distinct().withColumn("__seen", F.lit(True))
    status = (
        F.when(F.col("__seen"), ACKED).when(F.col(token) <= F.col("__high"), REDELIVER).otherwise(PENDING)
    )
    return (
        pending.join(seen, [queue, token], "left")
        .join(high, queue, "left")
        .select(*pending.columns, status.alias("status"))
    )
