"""Audit of how filters interact, by truth-table survival words.

Of five filters there are 32 subsets. A document becomes a 32-bit word: bit S is set if the document passes all filters of subset
S. The number of set bits at each place over all words, a positional popcount, is the number of survivors of every
subset, and everything an audit asks about any order of the filters is a difference of such numbers. Tasks take the popcounts
with carry-save adders: three words of one weight become one of that weight and one of twice the weight, until few are left to
be counted bit by bit. Spark adds up the tasks' counts per part and label.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
EVERY, GOOD, TOXIC = range(3)
BUFFER = 4_000_000  # words a task holds before it counts them

WORDS = r"[^\x20\x09-\x0D]+"


def passing_mask(place: int) -> int:
    """The word whose set bits are the subsets without the filter at ``place``."""
    return sum(1 << subset for subset in range(SUBSETS) if not subset >> place & 1)


def survival_word(failures: list[Column]) -> Column:
    """The word of a document by the filters it fails: a subset survives if none of its filters fails."""
    every = (1 << SUBSETS) - 1
    word = F.lit(every).cast("long")
    for place, fails in enumerate(failures):
        word = word.bitwiseAND(F.when(fails, F.lit(passing_mask(place))).otherwise(F.lit(every)))
    return word


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, from bit 0 on."""
    counts = np.zeros(32, np.int64)
    weight, level = 1, [words.astype(np.uint32)]
    while level:
        here = np.concatenate(level)
        level = []
        while len(here) >= 3:
            third = len(here) // 3
            a, b, c, rest = here[:third], here[third : 2 * third], here[2 * third : 3 * third], here[3 * third :]
            half = a ^ b
            level.append((a & b) | (half & c))
            here = np.concatenate([half ^ c, rest])
        for word in here.tolist():
            counts += weight * ((word >> np.arange(32)) & 1)
        weight *= 2
    return counts


def _subset_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (part, word, good, toxic) to counts of (part, label, subset)."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        for part, arrays in held.items():
            words, good, toxic = (np.concatenate(a) for a in zip(*arrays, strict=True))
            counts = [positional_popcount(words), positional_popcount(words[good]), positional_popcount(words[toxic])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * 3 * SUBSETS),
                    pa.array(np.repeat([EVERY, GOOD, TOXIC], SUBSETS).astype(np.int32)),
                    pa.array(np.tile(np.arange(SUBSETS), 3).astype(np.int32)),
                    pa.array(np.concatenate(counts)),
                ],
                ["part", "label", "subset", "n"],
            )

    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        of, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
        words = batch.column(1).to_numpy().astype(np.uint32)
        good, toxic = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3))
        for code, part in enumerate(names):
            mine = of == code
            held.setdefault(part, []).append((words[mine], good[mine], toxic[mine]))
        size += len(words)
        if size > BUFFER:
            yield from counted()
            held, size = {}, 0
    yield from counted()


def _measured(docs: DataFrame) -> DataFrame:
    """Per document its part, a digest of its text, and whether it fails A, B, C and D."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORDS), F.lit(0))
    table = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    table = table.select("doc_id", "part", "text", words.alias("words"))
    n_words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    return table.select(
        "doc_id",
        "part",
        # texts are compared by 256 bits
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (n_words < 200).alias("A"),
        (F.lit(100).cast("long") * distinct < F.lit(50).cast("long") * n_words).alias("B"),
        (F.lit(100).cast("long") * F.regexp_count("text", F.lit("[A-Z]")) > F.lit(3).cast("long") * F.char_length("text")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"),
    )


def survival_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, part (lang, null as empty), ``word`` (see the module), ``good`` and ``toxic`` (some row of ``labels`` says 1)."""
    measured = cut_lineage(_measured(docs), "measured")
    # the rows that are first of their text; a row with another doc_id fails E. Keys are unique, so a group of copies is no hot key
    firsts = measured.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    named = measured.where("doc_id is not null").join(firsts, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    named = named.select("doc_id", "part", "A", "B", "C", "D", F.col("first").isNull().alias("E"), "good", "toxic")
    # nothing is smaller than no doc_id, and no label names it
    nameless = measured.where("doc_id is null").select(
        "doc_id", "part", "A", "B", "C", "D", F.lit(False).alias("E"), F.lit(False).alias("good"), F.lit(False).alias("toxic")
    )
    word = survival_word([F.col(name) for name in FILTERS]).alias("word")
    marked = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    return named.unionByName(nameless).select("doc_id", "part", word, *marked)


def _steps() -> Column:
    """All orders' steps: the order, the step's number, its filter's bit, and the subsets before and after it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before, "after": before | bit})
            before |= bit
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, bit: int, before: int, after: int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes in every order of the five: one row per part, ``filter_order`` and ``step``.

    ``docs``: doc_id, text, lang; ``labels``: doc_id, quality, toxic. A text fails A with fewer than 200 words, B if fewer than half its words are
    distinct, C if more than 3% of its characters are A-Z, D if it holds one of ``#$%&*|``, E if a row with a smaller doc_id
    has the same text. A null text is the empty one. ``part`` is lang, null as the empty string. Counts within the part: ``kept``
    after the step, ``removed`` by it, ``redundant`` (fail its filter, but went earlier), ``unique_fails`` (fail no other
    filter), ``good_lost`` and ``toxic_lost`` (removed, labelled quality 1 and toxic 1), ``shapley`` (removed by the filter, over all orders).

    Every row counts: repeated rows are documents of their own, those of one doc_id and text all pass or fail E together. A row with a null doc_id passes E
    and has no label. Several labels of one doc_id count as one that says 1 where any does; labels of unknown
    documents, or null ones, change nothing. Ties do not occur; an empty table has no parts, so no rows. Other columns are ignored.
    """
    words = survival_words(docs, labels)
    tasks = words.select("part", "word", "good", "toxic").mapInArrow(_subset_counts, "part string, label int, subset int, n long")
    survivors = tasks.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))
    entry = F.struct((F.col("label") * SUBSETS + F.col("subset")).alias("place"), "n")
    # 96 numbers per part, in order
    numbers = survivors.groupBy("part").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    table = cut_lineage(numbers.select("part", F.transform("all", lambda e: e["n"]).alias("n")), "survivors")
    step = table.select("part", "n", F.explode(_steps()).alias("s")).select("part", "n", "s.*")

    def alive(subset: Column, label: int = EVERY) -> Column:
        return F.get("n", subset + label * SUBSETS)

    def lost(label: int = EVERY) -> Column:
        return alive(F.col("before"), label) - alive(F.col("after"), label)

    everything = F.lit(SUBSETS - 1)
    found = step.select(
        "part",
        "filter_order",
        "step",
        "bit",
        alive(F.col("after")).alias("kept"),
        lost().alias("removed"),
        (alive(F.lit(0)) - alive(F.col("bit")) - lost()).alias("redundant"),
        (alive(everything - F.col("bit")) - alive(everything)).alias("unique_fails"),
        lost(GOOD).alias("good_lost"),
        lost(TOXIC).alias("toxic_lost"),
    )
    over_orders = F.sum("removed").over(Window.partitionBy("part", "bit"))
    return found.withColumn("shapley", over_orders).drop("bit")
