"""Splitting keys that hold too many rows into ranges of their order columns.

A window over ``PARTITION BY key ORDER BY position`` puts every row of a key into
one task. A key that holds a third of the table would then be one task's work. The
functions here find such keys and cut each into consecutive ranges of about
``rows_per_range`` rows; :mod:`tidemark.plans.running` then works range by range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

# A range of this many rows is an ordinary sort for one task.
ROWS_PER_RANGE = 2_000_000
# Rows looked at per range to place its edges, as range partitioning does.
SAMPLED_PER_RANGE = 20

RANGE = "__range"
AT = "__at"


@dataclass(frozen=True)
class HotRanges:
    """The edges of each hot key's ranges: a written table, the same in every branch of a plan.

    ``table`` has one row per hot key, with the sorted edges in ``__cuts``: one for every
    ``rows_per_range`` rows or so, whatever the number of keys. They come from a sample, but
    any edges give the same results: they only decide which task works on a row.
    """

    table: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the range number, rising in order; null for rows of other keys. Tagged rows stay as they are."""
        if RANGE in df.columns:
            return df
        # one row per key, so a row meets one candidate; Spark broadcasts the table if its written size allows
        met = df.withColumn(AT, F.struct(*self.order)).join(self.table, same_key(self.keys), "left")
        return met.withColumn(RANGE, _edges_up_to(F.col("__cuts"), F.col(AT))).drop(*hot_names(self.keys), "__cuts", AT)

    def tag_spans(self, df: DataFrame, keys: Sequence[str], first: dict[str, str], last: dict[str, str], name: str) -> DataFrame:
        """A row of ``df`` for every range from its first to its last position, with the range's number; one row, null, for other keys.

        ``keys`` are the columns of ``df`` that hold the keys. ``first`` and ``last`` name its column for each order column; a
        null last position is the end.
        """
        place = lambda columns: F.struct(*[F.col(columns[o]).alias(o) for o in self.order])
        open_end = reduce(Column.__or__, [F.col(c).isNull() for c in last.values()])
        met = df.join(self.table, same_key(keys), "left")
        low = _edges_up_to(F.col("__cuts"), place(first))
        high = F.when(open_end, F.size("__cuts")).otherwise(_edges_up_to(F.col("__cuts"), place(last)))
        crossed = F.when(F.col("__cuts").isNotNull(), F.sequence(low, F.greatest(low, high)))
        return met.withColumn(name, F.explode_outer(crossed)).drop(*hot_names(self.keys), "__cuts")


def _edges_up_to(cuts: Column, at: Column) -> Column:
    """How many of the sorted ``cuts`` are not above ``at``, by halving; null without cuts."""
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.shiftright(low + high, 1)
        above = F.struct((middle + 1).alias("low"), high.alias("high"))
        below = F.struct(low.alias("low"), middle.alias("high"))
        return F.when(low >= high, span).when(F.get(cuts, middle) <= at, above).otherwise(below)

    whole = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.when(cuts.isNotNull(), F.aggregate(halvings, whole, halve, lambda span: span["low"]))


def hot_names(keys: Sequence[str]) -> list[str]:
    return [f"__hot{i}" for i in range(len(keys))]


def same_key(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for key, hot in zip(keys, hot_names(keys)):
        same = same & F.col(key).eqNullSafe(F.col(hot))
    return same


def find_hot_keys(df: DataFrame, keys: Sequence[str], rows_per_range: float | None = None) -> DataFrame | None:
    """The keys with more than ``rows_per_range`` rows; None if there are none.

    The count reads only the key columns and combines map-side. The result is a written
    table: ``__hot0``, ... for the key, ``__wanted`` for the number of ranges to cut it into, in
    proportion to its rows, and ``__rate`` for the share of its rows to sample. A caller
    that knows all keys to be small passes ``math.inf`` and saves the count.
    """
    if rows_per_range == math.inf:
        return None
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    wanted = F.ceil(F.col("__rows") / F.lit(rows_per_range))
    hot = counted.where(F.col("__rows") > rows_per_range).select(
        *[F.col(k).alias(n) for n, k in zip(hot_names(keys), keys)],
        wanted.alias("__wanted"),
        F.least(F.lit(1.0), SAMPLED_PER_RANGE * wanted / F.col("__rows")).alias("__rate"),
    )
    written = cut_lineage(hot, "hot-keys")
    return None if written.isEmpty() else written


def find_hot_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_range: float | None = None
) -> HotRanges | None:
    """Cut keys with more than ``rows_per_range`` rows into ranges; None if there is no such key.

    The edges come from a sample of the hot keys' rows, written once: a second evaluation
    might sample other rows. Nothing reaches the driver.
    """
    hot_keys = find_hot_keys(df, keys, rows_per_range)
    if hot_keys is None:
        return None
    names = hot_names(keys)
    sampled = (
        df.select(*keys, F.struct(*order).alias(AT)).join(hot_keys, same_key(keys)).where(F.rand(seed=7) < F.col("__rate"))
    )
    # windows over the sample: a key has about SAMPLED_PER_RANGE rows per wanted range in it
    by_order = Window.partitionBy(*names).orderBy(AT)
    every = F.greatest(F.floor(F.count(F.lit(1)).over(Window.partitionBy(*names)) / F.col("__wanted")), F.lit(1))
    cuts = (
        sampled.withColumn("__n", F.row_number().over(by_order))
        .withColumn("__every", every)
        .where(F.col("__n") % F.col("__every") == 0)
        .groupBy(*names)
        .agg(F.sort_array(F.collect_set(AT)).alias("__cuts"))
    )
    return HotRanges(cut_lineage(cuts, "hot-ranges"), tuple(keys), tuple(order))
