"""Watching operations: slow ones and streaks of failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.hot_ranges import find_hot_ranges
from tidemark.plans.running import running_since

# 100 ms x 5 x 6, and the number of failures in a row that is still a warning.
SLOW_MS = 3_000
MAX_FAILURES = 5

WARN, ERROR = "warn", "error"


def slow_operations(op_log: DataFrame, threshold_ms: float = SLOW_MS, duration_ms: str = "duration_ms") -> DataFrame:
    """Operations that took longer than the threshold; exactly the threshold is not slow."""
    return op_log.where(F.col(duration_ms) > threshold_ms)


def with_duration(op_log: DataFrame, started: str = "started", ended: str = "ended") -> DataFrame:
    """Add ``duration_ms`` from start and end timestamps."""
    micros = F.timestamp_diff("MICROSECOND", F.col(started), F.col(ended))
    return op_log.withColumn("duration_ms", micros / F.lit(1000))


def failure_streaks(
    events: DataFrame,
    key: str,
    order: str,
    is_failure: Column,
    max_failures: int = MAX_FAILURES,
    rows_per_range: float | None = None,
) -> DataFrame:
    """Per row the failures in a row up to it (0 on a success) and the severity of a failure."""
    failed = F.coalesce(is_failure, F.lit(False))
    ranges = find_hot_ranges(events, [key], [order], rows_per_range)
    counted = running_since(events, [key], [order], failed, ~failed, "streak", ranges)
    severity = F.when(F.col("streak") > max_failures, ERROR).when(F.col("streak") > 0, WARN)
    return counted.withColumn("severity", severity)
