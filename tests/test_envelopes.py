import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import envelopes as e


@pytest.fixture(scope="module")
def mixed(spark):
    """Envelopes of items that are either numbers or texts."""
    schema = "stream_id long, events array<struct<kind:string,number:int>>, request_context map<string,string>"
    return spark.createDataFrame(
        [
            (1, [("int", 1), ("str", None), ("int", 2)], {"k": "v"}),
            (2, [], None),
            (3, [("str", None)], {}),
        ],
        schema,
    )


def test_unpack_numbers_the_survivors(mixed, rows):
    got = e.unpack_envelopes(mixed, lambda x: x["kind"] == "int")
    assert rows(got, "stream_id", "event_index", "event.number") == [(1, 0, 1), (1, 1, 2)]
    assert e.unpack_envelopes(mixed).count() == 4


def test_filter_any_keeps_whole_envelopes(mixed, rows):
    kept = e.filter_any(mixed, lambda x: x["number"] > 1)
    assert rows(kept, "stream_id", F.size("events")) == [(1, 3)]


def test_context(mixed, rows):
    got = e.apply_context(mixed, ["k"])
    assert rows(got, "stream_id", "event_index", "k") == [(1, 0, "v"), (1, 1, "v"), (1, 2, "v"), (3, 0, None)]


def test_missing_events_are_an_error_and_empty_ones_are_not(spark, mixed):
    assert e.require_events(mixed).count() == 3
    bad = spark.createDataFrame([(None,)], "events array<int>")
    with pytest.raises(Exception, match="message contains no events"):
        e.require_events(bad).collect()
    for read in (e.unpack_envelopes(bad), e.filter_any(bad, lambda x: x > 1)):
        with pytest.raises(Exception, match="message contains no events"):
            read.collect()


@pytest.fixture(scope="module")
def said(spark):
    data = [(s, b, i, f"{s}-{b}-{i}") for s in (1, 2) for b in (1, 2, 3) for i in range(b * 3)]
    return spark.createDataFrame(data, "stream_id long, batch long, at long, word string").repartition(4)


@pytest.mark.parametrize("rows_per_range", [None, 4])
def test_pack_and_split_into_parts(said, rows, rows_per_range):
    packed = e.pack_envelopes(
        said, ["stream_id"], ["batch"], "at", ["word"], {"first": F.col("word")}, max_events=4, rows_per_range=rows_per_range
    )
    assert packed.count() == 2 * (1 + 2 + 3)
    assert packed.agg(F.max(F.size("events"))).first()[0] <= 4
    third = packed.where("stream_id = 2 and batch = 3").orderBy("part").collect()
    assert [r["part"] for r in third] == [0, 1, 2]
    assert [x["word"] for r in third for x in r["events"]] == [f"2-3-{i}" for i in range(9)]
    assert [r["request_context"] for r in third] == [{"first": "2-3-0"}] * 3


def test_results_do_not_depend_on_parts(said, rows):
    seen = set()
    for most in (1, 3, 100):
        packed = e.pack_envelopes(said, ["stream_id"], ["batch"], "at", ["word"], {"first": F.col("word")}, max_events=most)
        kept = e.filter_any(packed, lambda x: x["word"] == "2-3-7")
        index = rows(e.unpack_envelopes(kept, lambda x: x["word"] != "2-3-1"), "event_index", "event.word", F.col("request_context")["first"])
        seen.add(tuple(index))
    words = [f"2-3-{i}" for i in range(9) if i != 1]
    assert seen == {tuple((k, w, "2-3-0") for k, w in enumerate(words))}


def test_pack_then_unpack_is_the_identity(said, rows):
    packed = e.pack_envelopes(said, ["stream_id"], ["batch"], "at", ["word"])
    back = e.unpack_envelopes(packed)
    assert rows(back, "stream_id", "batch", "event_index", "event.word") == rows(said.select("stream_id", "batch", F.col("at").cast("int"), "word"))


def test_columns_that_differ_from_part_to_part_do_not_split_a_batch(spark, rows):
    schema = "id long, part long, file string, tags map<string,string>, events array<int>"
    given = spark.createDataFrame(
        [(1, 1, "b", {"x": "1"}, [5, 9]), (1, 0, "a", {}, [1, 2]), (1, 2, "c", None, []), (2, 0, "d", {}, [3]), (None, 1, "e", {}, [9]), (None, 0, "f", {}, [0])],
        schema,
    )
    kept = e.filter_any(given, lambda x: x == 9, ["id"])
    assert kept.columns == given.columns
    assert rows(kept, "id", "part", "file") == [(None, 0, "f"), (None, 1, "e"), (1, 0, "a"), (1, 1, "b"), (1, 2, "c")]
    index = e.unpack_envelopes(given, lambda x: x != 2, ["id"])
    assert rows(index, "id", "event_index", "event", "file") == [
        (None, 0, 0, "f"), (None, 1, 9, "e"), (1, 0, 1, "a"), (1, 1, 5, "b"), (1, 2, 9, "b"), (2, 0, 3, "d")
    ]
    # a part that is there twice counts once for the later ones
    again = given.unionByName(given.where("file = 'a'").withColumn("file", F.lit("z")))
    assert rows(e.unpack_envelopes(again, None, ["id"]).where("file = 'b'"), "event_index", "event") == [(2, 5), (3, 9)]
    for call in (lambda: e.filter_any(given, lambda x: x > 1), lambda: e.unpack_envelopes(given)):
        with pytest.raises(ValueError, match="batch_key"):
            call()


def test_marks_of_the_batch_survive_parquet(said, rows, tmp_path):
    path = str(tmp_path / "packed")
    e.pack_envelopes(said, ["stream_id"], ["batch"], "at", ["word"], max_events=2).write.parquet(path)
    back = said.sparkSession.read.parquet(path).withColumn("file", F.col("part"))
    assert e.batch_columns(back) == ["stream_id", "batch"]
    assert rows(back.where("stream_id = 1 and batch = 3"), "part", "parts") == [(p, 5) for p in range(5)]
    assert rows(e.unpack_envelopes(back).where("stream_id = 1 and batch = 3"), "event_index") == [(i,) for i in range(9)]


def test_messages_round_trip(mixed, rows):
    kind = mixed.schema["events"].dataType.elementType
    back = e.message_to_envelope(e.envelope_to_message(mixed), kind)
    assert rows(back, "stream_id", "events", "request_context") == rows(mixed)
    assert isinstance(e.envelope_to_message(mixed).schema["content"].dataType, T.StringType)


@pytest.mark.parametrize("rows_per_range", [None, 3])
def test_assign_sequence_and_depth(spark, rows, rows_per_range):
    messages = spark.createDataFrame([(q, i * 10) for q in (0, 1) for i in range(5 + q)], "queue_id long, arrival long")
    got = rows(e.assign_sequence(messages, rows_per_range=rows_per_range))
    assert got == [(q, i * 10, i) for q in (0, 1) for i in range(5 + q)]
    assert rows(e.queue_depth(messages)) == [(0, 5), (1, 6)]
