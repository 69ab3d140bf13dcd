"""Scans of shard listings and keyed state."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_shards(spark: SparkSession, path: str) -> DataFrame:
    """The full shard listing of a parquet folder; a missing listing is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no shard listing at {path}") from problem


def distinct_shard_ids(shards: DataFrame, id_column: str = "id") -> DataFrame:
    return shards.select(id_column).distinct()


def scan_state(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """The keyed table of a parquet folder; limit 0 means all rows."""
    return limit_rows(spark.read.parquet(path), limit)


def limit_rows(state: DataFrame, limit: int = 0) -> DataFrame:
    """At most ``limit`` rows of a listing, any of them; 0 means all rows."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    return state.limit(limit) if limit else state


def lookup_key(state: DataFrame, key: Any, key_column: str = "key") -> DataFrame:
    """The row of one key, or no row. The filter reaches the parquet scan."""
    return state.where(F.col(key_column) == F.lit(key).cast(state.schema[key_column].dataType))


def is_state_empty(state: DataFrame) -> bool:
    return state.isEmpty()
