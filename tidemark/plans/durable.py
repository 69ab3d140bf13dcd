"""Results that outlive an executor: tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    The written table has a known size, so Spark can decide on a broadcast by it, and
    a lost executor costs a re-read, not a recomputation of earlier rounds.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that ``path`` is on, as Spark itself reaches it."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``, sorted; none if it does not exist."""
    files, place = file_system(spark, folder), hadoop_path(spark, folder)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)
