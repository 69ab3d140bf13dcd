"""Tables in versions: commits, conflicts, differences by digest, old versions removed."""

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources import versions as vs

CHANGES = "key string, op string, expected_version long, expected_owner string, new_owner string, amount long"


@pytest.fixture
def folder(spark, tmp_path):
    place = str(tmp_path / "table")
    state = spark.range(200).select(
        F.concat(F.lit("k"), "id").alias("key"), F.lit(0).cast("long").alias("version"), F.lit(None).cast("string").alias("owner"), F.col("id").alias("amount")
    )
    assert vs.create_versions(state, place, buckets=8)
    assert not vs.create_versions(state, place, buckets=8)
    return place


def change(spark, *rows):
    return spark.createDataFrame([(*r, None, None, None, None)[:6] if len(r) < 6 else r for r in rows], CHANGES)


def take(spark, key, owner, version=0):
    return change(spark, (key, "take", version, None, owner, None))


def test_commit_and_read(spark, folder, rows):
    asked = change(spark, ("k1", "update", 0, None, None, 77), ("k2", "delete"), ("new", "create", None, None, "me", 5), ("k3", "update", 4, None, None, 9))
    assert rows(vs.commit_merge(asked, folder, ["amount"])) == [("k1", "update", True), ("k2", "delete", True), ("k3", "update", False), ("new", "create", True)]
    now = {r["key"]: (r["version"], r["owner"], r["amount"]) for r in vs.read_version(spark, folder).collect()}
    assert len(now) == 200 and now["k1"] == (1, None, 77) and now["new"] == (0, "me", 5) and "k2" not in now and now["k3"] == (0, None, 3)
    assert vs.read_version(spark, folder, 0).count() == 200 and vs.versions(spark, folder) == [0, 1]


def test_two_writers_of_one_version(spark, folder, rows):
    assert rows(vs.commit_merge(take(spark, "k1", "a"), folder, ["amount"], base=0)) == [("k1", "take", True)]
    assert rows(vs.commit_merge(take(spark, "k1", "b"), folder, ["amount"], base=0)) == [("k1", "take", False)]
    # without a base the change is judged anew, and its expected version has passed
    assert rows(vs.commit_merge(take(spark, "k1", "b"), folder, ["amount"])) == [("k1", "take", False)]
    assert rows(vs.commit_merge(take(spark, "k1", "b", 1), folder, ["amount"])) == [("k1", "take", True)]
    assert vs.read_version(spark, folder).where("key = 'k1'").first()["owner"] == "b"


def test_writers_of_other_buckets_follow_each_other(spark, folder):
    place = {r["key"]: r[vs.BUCKET] for r in vs._bucketed(vs.read_version(spark, folder), 8).collect()}
    other = next(k for k in sorted(place) if place[k] != place["k1"])
    for key in ("k1", other):
        assert vs.commit_merge(take(spark, key, "a"), folder, ["amount"], base=0).first()["applied"]
    assert vs.read_version(spark, folder).where("owner = 'a'").count() == 2


def test_racing_writers_lose_nothing(spark, folder):
    won = {}

    def write(owner):
        asked = change(spark, ("k7", "take", 0, None, owner, None), (f"by-{owner}", "create", None, None, owner, 1))
        won[owner] = {r["key"]: r["applied"] for r in vs.commit_merge(asked, folder, ["amount"], attempts=20).collect()}

    writers = [threading.Thread(target=write, args=(o,)) for o in "abcd"]
    [w.start() for w in writers]
    [w.join() for w in writers]
    winner = [o for o in "abcd" if won[o]["k7"]]
    now = {r["key"]: (r["version"], r["owner"]) for r in vs.read_version(spark, folder).collect()}
    assert len(winner) == 1 and now["k7"] == (1, winner[0])
    assert all(won[o][f"by-{o}"] and now[f"by-{o}"] == (0, o) for o in "abcd")


def test_manifest_is_made_once(spark, tmp_path):
    made, path = [], str(tmp_path / "one.json")
    makers = [threading.Thread(target=lambda i=i: made.append(vs._create_if_absent(spark, path, f"body {i}"))) for i in range(8)]
    [m.start() for m in makers]
    [m.join() for m in makers]
    assert sorted(made) == [False] * 7 + [True] and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.json"]


def test_difference_reads_one_bucket(spark, folder, tmp_path, rows):
    other = str(tmp_path / "other")
    moved = vs.read_version(spark, folder).withColumn("version", F.when(F.col("key") == "k5", 9).otherwise(F.col("version")).cast("long"))
    assert vs.create_versions(moved, other, buckets=8)
    found = vs.diff_versions(spark, (folder, None), (other, None))
    assert rows(found) == [("k5", 0, 9, "changed")]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) == 1
    vs.commit_merge(change(spark, ("k1", "delete"), ("zz", "create")), folder, ["amount"])
    assert rows(vs.diff_versions(spark, (folder, 0), (folder, 1)), "key", "status") == [("k1", "removed"), ("zz", "added")]
    assert vs.diff_versions(spark, (folder, 1), (folder, None)).count() == 0
    uneven = str(tmp_path / "uneven")
    vs.create_versions(moved, uneven, buckets=3)
    assert rows(vs.diff_versions(spark, (folder, 0), (uneven, 0)), "key") == [("k5",)]


def test_old_versions_go(spark, folder):
    for v in range(3):
        vs.commit_merge(take(spark, "k1", f"o{v}", v), folder, ["amount"])
    assert vs.expire_versions(spark, folder, keep=2) == 2 and vs.versions(spark, folder) == [2, 3]
    assert vs.read_version(spark, folder).count() == 200 and vs.read_version(spark, folder, 2).where("owner = 'o1'").count() == 1
    with pytest.raises(ValueError):
        vs.read_version(spark, folder, 0)
    with pytest.raises(ValueError):
        vs.expire_versions(spark, folder, 0)


def test_empty_tables_and_null_keys(spark, folder, tmp_path):
    empty = str(tmp_path / "empty")
    assert vs.create_versions(vs.read_version(spark, folder).limit(0), empty)
    assert vs.read_version(spark, empty).count() == 0
    assert vs.commit_merge(change(spark), empty, ["amount"]).count() == 0 and vs.versions(spark, empty) == [0]
    assert vs.commit_merge(change(spark, ("a", "create")), empty, ["amount"]).first()["applied"]
    with pytest.raises(PySparkException):
        vs.commit_merge(change(spark, (None, "create")), folder, ["amount"])
    with pytest.raises(ValueError):
        vs.read_version(spark, str(tmp_path / "none"))
