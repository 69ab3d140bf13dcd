"""Event sourcing: journals of messages folded into versioned per-entity state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import format_journal_line, speak
from tidemark.plans.hot_ranges import find_hot_ranges
from tidemark.plans.running import first_rows, row_count, running


def journal_fold(events: DataFrame, entity: str = "entity_id", order: str = "seq", message: str = "message") -> DataFrame:
    """State per entity: version and message count are the number of events, plus the last message.

    Only partial aggregates are shuffled, so a hot entity costs no more than others.
    """
    return events.groupBy(entity).agg(
        F.count(F.lit(1)).alias("version"),
        F.count(F.lit(1)).alias("message_count"),
        F.max_by(message, order).alias("last_message"),
    )


def journal_versions(
    events: DataFrame,
    entity: str = "entity_id",
    order: str = "seq",
    message: str = "message",
    rows_per_range: float | None = None,
) -> DataFrame:
    """Every event with the version it led to, the running count and the formatted line."""
    ranges = find_hot_ranges(events, [entity], [order], rows_per_range)
    numbered = running(events, [entity], [order], {"version": row_count()}, ranges)
    return numbered.select(
        "*",
        F.col("version").alias("message_count"),
        format_journal_line(entity, "version", message).alias("line"),
    )


def journal_as_of(
    events: DataFrame,
    version: int,
    entity: str = "entity_id",
    order: str = "seq",
    message: str = "message",
    rows_per_range: float | None = None,
) -> DataFrame:
    """State of every entity when it had at most ``version`` events."""
    if version < 1:
        raise ValueError("version counts from 1; an entity without events has no state row")
    early = first_rows(events.select(entity, order, message), [entity], [order], version, rows_per_range)
    return journal_fold(early, entity, order, message)


def last_message(events: DataFrame, entity: str = "entity_id", order: str = "seq", message: str = "message") -> DataFrame:
    """What each entity said last; the last write wins."""
    return events.groupBy(entity).agg(speak(F.max_by(message, order)).alias("last_message"))
