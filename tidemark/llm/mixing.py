"""Mixing sources to target weights by weighted sampling without replacement, in DataFrame operations only.

Targets are shares of all words by source weight, filled like water under a bound of so many epochs. A source's
complete epochs take every document; the rest of its target takes documents in the order of exponential keys
-ln(u) / quality (smallest first), until the prefix sum of sizes reaches it. The prefix sums never gather a source: sizes are
summed per slot of keys, the slot in which a source's budget ends is cut into slots again, and only the last one, of a bounded number
of documents, is sorted. What remains is one cut key per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# slots of a range of keys in one round, and documents that a source's last range may hold
SLOTS = 1024
DOCS_PER_RANGE = 1000


def text_quality(text: Column) -> Column:
    """A weight from 0.1 to 1 that falls with the share of symbols of mark-up and junk in a text (null: 0.1)."""
    plain = F.length(F.translate(text, SYMBOLS, ""))
    share = 1 - plain / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 4 * share), F.lit(0.1))


def _keyed(docs: DataFrame, quality: Column) -> DataFrame:
    """``docs`` with ``__key``: exponential, reproducible, its rate the document's quality."""
    own = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    draw = F.conv(F.substring(F.md5(own), 1, 13), 16, 10).cast("double")
    return docs.withColumn("__key", -F.log((draw + 1) / float(16**13)) / quality)


def source_targets(
    totals: DataFrame, share: float = 1.5, weights: Sequence[float] = (3.0, 1.0, 2.0), epochs: float = 2.0
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source with its ``source_size``.

    Sources in code point order, null last, have the weights in turn and share ``share`` times all sizes. No target
    exceeds ``epochs`` times its source's size; the excess goes to the others by weight until none does.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    levels = (
        totals.withColumn("weight", weight)
        .withColumn("most", epochs * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(later))
        # the level at the first source that stays below its bound holds for all after it
        .withColumn("water", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "source", "level"))).over(every)["level"])
    )
    target = F.when(F.col("water").isNull() | (F.col("ratio") <= F.col("water")), F.col("most")).otherwise(F.col("water") * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def _within(sized: DataFrame, ranges: DataFrame) -> DataFrame:
    """Documents whose key is in their source's range, with the range."""
    return sized.join(ranges, F.col("source").eqNullSafe(F.col("s"))).where(F.col("key").between(F.col("low"), F.col("high")))


def _narrowed(sized: DataFrame, rests: DataFrame) -> DataFrame:
    """Per source (``s``, ``rest``) the range of keys, ``low`` to ``high``, in which its rest ends, and the words ``before`` it.

    Each round cuts every range into ``SLOTS`` of equal width, sums sizes by slot and goes on with the slot in which the rest ends, until
    none holds more than ``DOCS_PER_RANGE`` documents with different keys. So no task gets more than the slots or the last range of a
    source, however keys are distributed. Slots follow the order of keys, so a slot's documents are those from its least key to its largest.
    """
    ranges = cut_lineage(
        sized.groupBy("source")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
        .join(rests, F.col("source").eqNullSafe(F.col("s")))
        .select("s", "rest", "low", "high", F.lit(0).cast("long").alias("before"), "n"),
        "ranges",
    )
    # a single number
    while ranges.where((F.col("n") > DOCS_PER_RANGE) & (F.col("high") > F.col("low"))).agg(F.count("*")).first()[0]:
        slot = F.floor((F.col("key") - F.col("low")) / F.greatest(F.col("high") - F.col("low"), F.lit(1e-300)) * SLOTS)
        along = Window.partitionBy("s").orderBy("slot")
        ranges = cut_lineage(
            _within(sized, ranges)
            .groupBy("s", "rest", "before", F.least(slot, F.lit(SLOTS - 1)).alias("slot"))
            .agg(F.sum("size").alias("words"), F.min("key").alias("least"), F.max("key").alias("largest"), F.count("*").alias("held"))
            .withColumn("earlier", F.col("before") + F.sum("words").over(along) - F.col("words"))
            .where((F.col("earlier") <= F.col("rest")) | (F.col("earlier") == F.col("before")))
            .groupBy("s", "rest")
            .agg(F.max(F.struct("slot", "least", "largest", "earlier", "held")).alias("m"))
            .select("s", "rest", F.col("m.least").alias("low"), F.col("m.largest").alias("high"), F.col("m.earlier").alias("before"), F.col("m.held").alias("n")),
            "ranges",
        )
    return ranges.drop("n")


def mixing_plan(
    docs: DataFrame,
    share: float = 1.5,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    epochs: float = 2.0,
    quality: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The plan, one row per source (``source``, ``source_size``, ``target``, ``whole``, ``cut``), and the sized documents.

    A document is taken ``whole`` times, and once more if its key is at most ``cut``.
    """
    quality = text_quality(F.col("text")) if quality is None else quality
    sized = _keyed(docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")), quality)
    sized = cut_lineage(sized.select("doc_id", "source", F.col("__size").alias("size"), F.col("__key").alias("key")), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, share, weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = cut_lineage(targets, "targets")

    # one row per source
    worded = sized.where("size > 0")
    inside = _within(worded, _narrowed(worded, targets.select(F.col("source").alias("s"), "rest")))
    # rows of one key have one text; they are one row from here on
    inside = inside.groupBy("source", "rest", "before", "key").agg(F.sum("size").alias("words"), F.max("size").alias("size"))
    running = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        inside.withColumn("until", F.col("before") + F.sum("words").over(running))
        .withColumn("least", F.min("key").over(Window.partitionBy("source")))
        .groupBy("source")
        # a document that the budget ends in is taken if half of it fits; all keys before the range are smaller
        .agg(
            F.max(F.when(F.col("until") - F.col("size") / 2 <= F.col("rest"), F.col("key"))).alias("last"),
            F.first("least").alias("least"),
        )
        .select(F.col("source").alias("s3"), F.coalesce("last", F.col("least") - 1e-12 * F.abs("least")).alias("cut"))
    )
    plan = targets.join(cuts, F.col("source").eqNullSafe(F.col("s3")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1.0)).alias("cut")
    )
    return cut_lineage(plan, "mixing-plan"), sized


def _copies(rows: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    plan = plan.withColumnsRenamed({name: f"__{name}" for name in plan.columns})
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left")
    return joined.withColumn("__copies", F.col("__whole") + F.when(F.col(key) <= F.col("__cut"), 1).otherwise(0))


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (3.0, 1.0, 2.0), epochs: float = 2.0, quality: Column | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``size`` (words), ``source_size`` and ``target`` of its source, ``taken`` (words, repeats counted).

    ``quality`` is a positive weight over the columns doc_id, text and source; by default ``text_quality``. Reruns agree, and
    rows equal in doc_id and text are taken or left together. A null or empty text has size 0 and is never taken; null is a source
    like others, the last. An empty table gives no rows. Other columns are ignored.
    """
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"))
    plan, sized = mixing_plan(chosen, share, weights, epochs, quality)
    return _copies(sized, plan, "key").select(
        "doc_id",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("size") * F.col("__copies")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (3.0, 1.0, 2.0), epochs: float = 2.0) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, as often as ``mix`` takes them. Documents without words are left out."""
    plan, _ = mixing_plan(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string")), share, weights, epochs)
    rows = _keyed(docs, text_quality(F.col("text")))
    rows = _copies(rows.where(F.col("text").rlike(WORD)), plan, "__key")
    taken = rows.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return taken.select(*[f"`{name}`" for name in docs.columns])
