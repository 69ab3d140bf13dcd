"""Hash-range routing and expansion of aggregated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import effective_hash_key
from tidemark.plans.durable import cut_lineage

# The mark an aggregated record starts with, and the length of its md5 tail.
AGGREGATE_MAGIC = "F3899AC2"
DIGEST_BYTES = 16

SMALLEST_HASH_KEY = "0" * 32
LARGEST_HASH_KEY = "f" * 32


# Bits that a long holds, in whole hex digits.
MOST_BITS = 60


def _leading_bits(hash_key: Column, bits: int) -> Column:
    """The first ``bits`` bits of 32 hex digits as a number."""
    return F.shiftright(F.conv(F.substring(hash_key, 1, MOST_BITS // 4), 16, 10).cast("long"), MOST_BITS - bits)


def dyadic_cover(shards: DataFrame, bits: int) -> DataFrame:
    """Each range (shard_id, start_hash, end_hash) as the fewest prefixes of up to ``bits`` bits that cover it: ``level`` bits fewer, ``node``.

    A level adds a prefix at either end at most, so even the whole ring is one row and no range is more than 2 * ``bits``.
    """
    low, beyond = _leading_bits(F.col("start_hash"), bits), _leading_bits(F.col("end_hash"), bits) + 1
    levels = shards.select("shard_id", "start_hash", "end_hash", low.alias("__low"), beyond.alias("__beyond")).where("__low < __beyond")
    levels = levels.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    # whole prefixes of this level inside the range: from the first one up to, not with, the last one
    first, last = F.expr("shiftright(__low + shiftleft(1L, level) - 1, level)"), F.expr("shiftright(__beyond, level)")
    ends = F.array_compact(F.array(F.when(F.col("__first") % 2 == 1, F.col("__first")), F.when(F.col("__last") % 2 == 1, F.col("__last") - 1)))
    inside = levels.withColumn("__first", first).withColumn("__last", last).where("__first < __last")
    return inside.select("shard_id", "start_hash", "end_hash", "level", F.explode(ends).alias("node"))


def route_by_hash_range(
    records: DataFrame,
    shards: DataFrame,
    partition_key: str = "partition_key",
    explicit_hash_key: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Records with every shard whose hash range, both ends included, contains their key.

    ``shards``: shard_id, start_hash, end_hash as 32 hex digits. Ranges become dyadic prefixes of mixed length
    (:func:`dyadic_cover`), and a record looks up its own prefix of each length that occurs, so the join is one equality however many shards
    there are and however wide. The longest prefix has two bits more than it takes to number the shards, or ``digits`` hex
    digits; only shards whose edges fall into one such prefix are compared by their whole range.
    """
    keyed = records.withColumn("hash_key", effective_hash_key(partition_key, explicit_hash_key))
    bits = 4 * digits if digits else shards.count().bit_length() + 2
    bits = min(bits, MOST_BITS)
    names = {"start_hash": "__start", "end_hash": "__end", "level": "__level", "node": "__node"}
    listed = cut_lineage(dyadic_cover(shards, bits).withColumnsRenamed(names), "cover")
    # at most one more than the bits
    levels = sorted(row[0] for row in listed.select("__level").distinct().collect())
    # a shard_id the records bring along is kept as read_shard_id
    if "shard_id" in records.columns:
        keyed = keyed.withColumnRenamed("shard_id", "read_shard_id")
    asked = keyed.withColumn("__bits", _leading_bits(F.col("hash_key"), bits))
    asked = asked.withColumn("__asked", F.explode(F.array(*[F.lit(level) for level in levels]).cast("array<int>")))
    inside = (
        (F.col("__asked") == F.col("__level"))
        & (F.expr("shiftright(__bits, __asked)") == F.col("__node"))
        & (F.col("hash_key") >= F.col("__start"))
        & (F.col("hash_key") <= F.col("__end"))
    )
    return asked.join(listed, inside).drop(*names.values(), "__bits", "__asked")


def is_aggregated(data: Column | str) -> Column:
    """Whether record bytes are an aggregate: magic, more than a digest behind it, matching md5 tail."""
    data = F.col(data) if isinstance(data, str) else data
    mark = len(AGGREGATE_MAGIC) // 2
    size = F.octet_length(data)
    body = F.substring(data, F.lit(mark + 1), size - F.lit(mark + DIGEST_BYTES))
    tail = F.substring(data, size - F.lit(DIGEST_BYTES - 1), F.lit(DIGEST_BYTES))
    return F.coalesce(
        (F.hex(F.substring(data, 1, mark)) == AGGREGATE_MAGIC)
        & (size - F.lit(mark) > DIGEST_BYTES)
        & (F.md5(body) == F.lower(F.hex(tail))),
        F.lit(False),
    )


def deaggregate(records: DataFrame, shards: DataFrame | None = None) -> DataFrame:
    """One row per user record.

    ``records``: shard_id, sequence_number, partition_key, data (bytes), arrival_ts and the
    decoded aggregate: partition_keys, explicit_hash_keys (decimal text) and items, an array
    of (pk_index, ehk_index or null, data). An aggregate gives sub-sequences 0, 1, ... with
    its own sequence number and arrival; if any item's hash key lies outside the shard's
    range, none of its items remain; an aggregate that was not decoded raises an error. Other records pass through once as sub-sequence 0.
    """
    marked = records.withColumn("aggregated", is_aggregated("data"))
    if shards is None:
        ranged = marked.withColumn("__start", F.lit(SMALLEST_HASH_KEY)).withColumn("__end", F.lit(LARGEST_HASH_KEY))
    else:
        limits = shards.select("shard_id", F.col("start_hash").alias("__start"), F.col("end_hash").alias("__end"))
        ranged = marked.join(limits, "shard_id", "left")

    resolved = F.transform(
        "items",
        lambda item: F.struct(
            F.element_at("partition_keys", item["pk_index"] + 1).alias("partition_key"),
            F.when(
                item["ehk_index"].isNotNull(),
                F.element_at("explicit_hash_keys", item["ehk_index"] + 1),
            ).alias("explicit_hash_key"),
            item["data"].alias("data"),
        ),
    )

    def in_range(item: Column) -> Column:
        key = effective_hash_key(item["partition_key"], item["explicit_hash_key"])
        return F.coalesce((key >= F.col("__start")) & (key <= F.col("__end")), F.lit(True))

    single = F.array(
        F.struct(
            F.col("partition_key").alias("partition_key"),
            F.lit(None).cast("string").alias("explicit_hash_key"),
            F.col("data").alias("data"),
        )
    )
    refuse = F.raise_error(F.lit("an aggregate without its decoded items")).cast(ranged.select(resolved.alias("r")).schema["r"].dataType)
    items = F.when(F.col("aggregated"), F.coalesce(resolved, refuse)).otherwise(single)
    whole = ranged.withColumn("__items", items)
    kept = whole.where(~F.col("aggregated") | F.forall("__items", in_range))
    return kept.select(
        "shard_id",
        "sequence_number",
        F.posexplode("__items").alias("__sub", "item"),
        "arrival_ts",
        "aggregated",
    ).select(
        "shard_id",
        "sequence_number",
        F.col("__sub").cast("long").alias("sub_sequence"),
        F.col("item.partition_key").alias("partition_key"),
        F.col("item.explicit_hash_key").alias("explicit_hash_key"),
        F.col("item.data").alias("data"),
        "arrival_ts",
        "aggregated",
    )
