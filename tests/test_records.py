"""Records laid out by sequence, and reads that open only the files they need."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sequence as q
from tidemark.sources import records as r

SCHEMA = "shard_id long, sequence_number string, sub_sequence long, data string"


@pytest.fixture(scope="module")
def given(spark):
    """Numbers of 1 to 40 digits, some with leading zeros, most of them in one shard; sub-sequences, null ones too."""
    draw, rows = random.Random(4), []
    for i in range(4000):
        number = str(draw.randrange(10 ** draw.choice([1, 3, 5, 20, 40])))
        rows.append((draw.choice([7, 7, 7, 7, 1, 2]), draw.choice(["", "", "00"]) + number, draw.choice([0, 1, 2, None]), f"d{i}"))
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def laid(spark, given, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("laid") / "records")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        r.write_records(given.where("data < 'd2'"), path)
        r.write_records(given.where("data >= 'd2'"), path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


@pytest.mark.parametrize("position", [q.AT_SEQUENCE_NUMBER, q.AFTER_SEQUENCE_NUMBER])
@pytest.mark.parametrize("seq", ["0", "5", "0099", "99999", "5" * 20, "9" * 40, "1" + "0" * 60])
def test_a_read_from_a_number_equals_the_plain_one(spark, given, laid, rows, position, seq):
    got = r.scan_records(spark, laid, position, seq=seq)
    assert got.columns == given.columns
    assert rows(got) == rows(r.start_position(given, position, seq=seq))


def test_other_positions_read_laid_out_records_too(spark, given, laid, rows):
    assert rows(r.scan_records(spark, laid, q.TRIM_HORIZON)) == rows(given)
    assert r.scan_records(spark, laid, q.LATEST).count() == 0


def test_only_files_that_reach_the_number_are_opened(spark, laid):
    every = spark.read.parquet(laid)
    files = every.inputFiles()
    assert len(files) > 12
    seq = "5" * 20
    scan = r.scan_records(spark, laid, q.AT_SEQUENCE_NUMBER, seq=seq)
    opened = set(scan.inputFiles())
    reach = every.where((F.col(r.SEQ_LENGTH) > 20) | ((F.col(r.SEQ_LENGTH) == 20) & (F.col(r.SEQ_DIGITS) >= seq)))
    needed = {row[0] for row in reach.select("_metadata.file_path").distinct().collect()}
    assert {f.split(":")[-1].lstrip("/") for f in opened} == {f.split(":")[-1].lstrip("/") for f in needed}
    assert len(opened) < len(files)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    # the plan prints the beginning of the list
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(seq_length,20)" in pushed and "Or(GreaterThan(seq_length,20),And(" in pushed


def test_files_without_an_index_are_read(spark, given, tmp_path, rows):
    path = str(tmp_path / "records")
    r.write_records(given.limit(50), path)
    whole = spark.read.parquet(path).drop("written")
    # an interrupted call: records, but no index
    whole.write.parquet(f"{path}/written=cut")
    assert r.scan_records(spark, path, q.AT_SEQUENCE_NUMBER, seq="0").count() == 100


def test_numbers_must_be_digits(spark, tmp_path):
    for bad in ("SHARD_END", "x1"):
        with pytest.raises(Exception, match="digits"):
            r.write_records(spark.createDataFrame([(1, bad, 0, "")], SCHEMA), str(tmp_path / bad))
