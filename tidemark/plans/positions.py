"""Positions in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

# the bits of a generated id that count the rows of its partition
ROW_BITS = 33


def with_positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 1, in the given order; rows that are equal in it are placed in any order.

    Spark sorts by ranges. The sorted rows are written once with their place in their range, ranges are counted, and every
    row adds the rows of the ranges before its own: one sort, and one small row per range. No task sees all rows.
    """
    mark, before, part = f"__{name}", f"__{name}_before", f"__{name}_range"
    ranged = cut_lineage(df.orderBy(*order).withColumn(mark, F.monotonically_increasing_id()), "positions")
    of_row = F.shiftright(mark, ROW_BITS).alias(part)
    counts = ranged.groupBy(of_row).agg(F.count(F.lit(1)).alias("__rows"))
    # one row per range of the sort
    earlier = F.coalesce(F.sum("__rows").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut_lineage(counts.select(part, earlier.alias(before)), "offsets")
    inside = F.col(mark).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = ranged.withColumn(part, F.shiftright(mark, ROW_BITS)).join(offsets, part)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (inside + F.col(before) + 1).alias(name))
