"""A session with the settings the operators are tuned for."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return a session: UTC, adaptive execution with skew handling, RocksDB state store.

    On a cluster leave ``shuffle_partitions`` unset and size it for the job: with
    adaptive execution a high initial number is merged down at run time.
    """
    builder = (
        SparkSession.builder.appName("tidemark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers find it from any working directory."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # executors fetch the archive from the driver as long as the application runs
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tidemark-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/tidemark", "zip", os.path.dirname(package), os.path.basename(package)))
    context._tidemark_shipped = True
