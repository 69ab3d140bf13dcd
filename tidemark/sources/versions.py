"""Keyed tables kept in versions: writers commit optimistically, readers always see one whole version.

A version is a small manifest, numbered from 0: for each bucket of keys the folder with its rows, their number and a
digest. Rows never change once written. A manifest is made only where none of its number exists, so of two writers of
one version exactly one wins. A manifest has one entry per bucket; their number is fixed when the table is made.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.state import UNCHANGED, snapshot_diff, versioned_merge
from tidemark.plans.durable import cut_lineage, file_names, file_system, hadoop_path, remove

BUCKET = "__bucket"


def _manifest_path(folder: str, version: int) -> str:
    return f"{folder}/manifests/{version:020d}.json"


def _create_if_absent(spark: SparkSession, path: str, body: str) -> bool:
    """Make the file with all of its content; False if there is one already.

    The content is written beside it and moved: by a hard link on a local or mounted folder, else by a rename that does not
    overwrite, which is atomic on HDFS. A store without such a rename needs another way.
    """
    files = file_system(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    out = files.create(hadoop_path(spark, draft), False)
    out.write(bytearray(body.encode()))
    out.close()
    try:
        if files.getScheme() == "file":
            os.link(hadoop_path(spark, draft).toUri().getPath(), hadoop_path(spark, path).toUri().getPath())
            return True
        return not files.exists(hadoop_path(spark, path)) and files.rename(hadoop_path(spark, draft), hadoop_path(spark, path))
    except FileExistsError:
        return False
    finally:
        files.delete(hadoop_path(spark, draft), False)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions there are, ascending; empty if there is no table."""
    return sorted(int(name[: -len(".json")]) for name in file_names(spark, f"{folder}/manifests") if name.endswith(".json"))


def _manifest(spark: SparkSession, folder: str, version: int | None) -> tuple[int, dict]:
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {'at all' if version is None else version} in {folder}")
    version = known[-1] if version is None else version
    return version, json.loads(spark.read.text(_manifest_path(folder, version), wholetext=True).first()[0])


def _bucketed(df: DataFrame, buckets: int, key: str = "key") -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, folder: str, buckets: int) -> tuple[str, dict[str, dict]]:
    """Write ``rows`` by bucket; the new folder's name and an entry for every bucket with rows."""
    name = f"rows-{uuid.uuid4().hex}"
    spark = rows.sparkSession
    names = [F.col(f"`{c}`") for c in rows.columns]
    # a null adds nothing to a hash, so that it is null is hashed too
    said = [*names, *[c.isNull() for c in names]]
    digest = [F.sum(F.xxhash64(F.lit(seed), *said).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    _bucketed(rows, buckets).repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{folder}/{name}")
    kept = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{folder}/{name}")
    found = kept.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.array(*digest).alias("digest"))
    # one row per bucket
    return name, {str(r[BUCKET]): {"folder": f"{name}/{BUCKET}={r[BUCKET]}", "rows": r["n"], "digest": r["digest"]} for r in found.toLocalIterator()}


def create_versions(state: DataFrame, folder: str, buckets: int = 64) -> bool:
    """Write ``state`` (key and more) as version 0 of a table in ``folder``; False if another writer made it first.

    Keys must be unique and not null. ``buckets`` should keep a bucket at a few hundred megabytes.
    """
    spark = state.sparkSession
    if versions(spark, folder):
        return False
    refuse = F.raise_error(F.lit("a row without a key")).cast(state.schema["key"].dataType)
    name, entries = _write(state.withColumn("key", F.coalesce("key", refuse)), folder, buckets)
    body = {"buckets": buckets, "schema": state.schema.jsonValue(), "entries": entries}
    return _settle(spark, folder, 0, body, name)


def _settle(spark: SparkSession, folder: str, version: int, body: dict, name: str) -> bool:
    """Publish a manifest; rows of a writer that came too late are removed, as nobody can have seen them."""
    made = _create_if_absent(spark, _manifest_path(folder, version), json.dumps(body))
    if not made:
        remove(spark, f"{folder}/{name}")
    return made


def _rows(spark: SparkSession, folder: str, manifest: dict, chosen: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    paths = [f"{folder}/{e['folder']}" for bucket, e in sorted(manifest["entries"].items()) if chosen is None or bucket in chosen]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Rows of a version, of the latest by default. Commits after this call change nothing in what it returns."""
    return _rows(spark, folder, _manifest(spark, folder, version)[1])


def commit_merge(changes: DataFrame, folder: str, payload: Sequence[str] = (), base: int | None = None, attempts: int = 5) -> DataFrame:
    """Apply ``changes`` to a table of versions as :func:`versioned_merge` does, and commit; the outcomes: key, op, applied.

    Only buckets with a changed key are read and written. If another writer commits first, but to other buckets, this commit
    follows it as it is. If it changed the same buckets, the changes are judged anew against its rows, so that a conditional
    change which lost is reported as any other that does not hold; with a ``base`` version, or after ``attempts``, they are
    all given up and ``applied`` is false throughout. No changes make no version.
    """
    spark = changes.sparkSession
    pinned = base is not None
    version, manifest = _manifest(spark, folder, base)
    asked = cut_lineage(changes, "changes")
    touched = {str(r[0]) for r in _bucketed(asked, manifest["buckets"]).select(BUCKET).distinct().toLocalIterator()}
    for _ in range(1 if pinned else attempts):
        columns = T.StructType.fromJson(manifest["schema"]).names
        merged, outcomes = versioned_merge(_rows(spark, folder, manifest, touched), asked, payload)
        outcomes = cut_lineage(outcomes, "outcomes")
        if not touched:
            return outcomes
        # the merge adds up versions as long; the table keeps its own types
        types = T.StructType.fromJson(manifest["schema"])
        name, fresh = _write(merged.select(*[F.col(c).cast(types[c].dataType).alias(c) for c in columns]), folder, manifest["buckets"])
        seen = {bucket: manifest["entries"].get(bucket) for bucket in touched}
        while True:
            newest, current = _manifest(spark, folder, None)
            if any(current["entries"].get(bucket) != entry for bucket, entry in seen.items()):
                remove(spark, f"{folder}/{name}")
                break
            others = {bucket: entry for bucket, entry in current["entries"].items() if bucket not in touched}
            body = {**current, "entries": others | fresh}
            if _create_if_absent(spark, _manifest_path(folder, newest + 1), json.dumps(body)):
                return outcomes
        version, manifest = newest, current
    return outcomes.withColumn("applied", F.lit(False))


def differing_buckets(old: dict, new: dict) -> set[str]:
    """Buckets whose rows differ by number or digest, those of one side only included."""
    said = [{bucket: (e["rows"], e["digest"]) for bucket, e in m["entries"].items()} for m in (old, new)]
    return {bucket for bucket in said[0].keys() | said[1].keys() if said[0].get(bucket) != said[1].get(bucket)}


def diff_versions(spark: SparkSession, old: tuple[str, int | None], new: tuple[str, int | None], version: str = "version") -> DataFrame:
    """Keys added, removed or changed from one (folder, version) to another, as :func:`snapshot_diff` without unchanged keys.

    Buckets with the same number of rows and the same digest on both sides are not read. Tables of different
    numbers of buckets are compared whole.
    """
    sides = [_manifest(spark, *side)[1] for side in (old, new)]
    chosen = differing_buckets(*sides) if sides[0]["buckets"] == sides[1]["buckets"] else None
    before, after = (_rows(spark, folder, m, chosen) for (folder, _), m in zip((old, new), sides, strict=True))
    return snapshot_diff(before, after, "key", version).where(F.col("status") != UNCHANGED)


def expire_versions(spark: SparkSession, folder: str, keep: int = 10) -> int:
    """Remove all but the last ``keep`` versions and the rows that no kept one names; the number of versions removed.

    Rows of commits under way are named by no old version, so they stay.
    """
    if keep < 1:
        raise ValueError(f"keep must be at least 1, got {keep}")
    known = versions(spark, folder)
    named = [{e["folder"] for e in _manifest(spark, folder, v)[1]["entries"].values()} for v in known]
    old, kept = named[:-keep], reduce(set.union, named[-keep:], set())
    for v in known[:-keep]:
        remove(spark, _manifest_path(folder, v))
    for place in reduce(set.union, old, set()) - kept:
        remove(spark, f"{folder}/{place}")
    return len(old)
