"""Running values per key that do not need a key's rows in one task.

Keys of ordinary size use one plain window. Hot keys (see
:mod:`tidemark.plans.hot_ranges`) get a window per range, plus what the earlier
ranges of the key add up to; that carry is one small row per range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage
from tidemark.plans.hot_ranges import RANGE, HotRanges, find_hot_ranges


@dataclass(frozen=True)
class Measure:
    """A running value: inside a range, of a whole range, and across ranges."""

    local: Callable[[WindowSpec], Column]
    summary: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    merge: Callable[[Column, Column], Column]


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def row_count() -> Measure:
    """1 for the first row of the key, 2 for the second, ..."""
    return Measure(
        local=lambda w: F.row_number().over(w).cast("long"),
        summary=lambda order: F.count(F.lit(1)),
        carry=lambda s, w: F.sum(s).over(_before(w)),
        merge=lambda here, earlier: here + F.coalesce(earlier, F.lit(0)),
    )


def total(value: Column) -> Measure:
    """Sum up to and including the row; null counts as 0."""
    filled = F.coalesce(value.cast("long"), F.lit(0))
    return Measure(
        local=lambda w: F.sum(filled).over(_so_far(w)),
        summary=lambda order: F.sum(filled),
        carry=lambda s, w: F.sum(s).over(_before(w)),
        merge=lambda here, earlier: here + F.coalesce(earlier, F.lit(0)),
    )


def greatest_before(value: Column) -> Measure:
    """Greatest non-null value of the rows before this one; null if there is none."""
    return Measure(
        local=lambda w: F.max(value).over(_before(w)),
        summary=lambda order: F.max(value),
        carry=lambda s, w: F.max(s).over(_before(w)),
        merge=lambda here, earlier: F.greatest(here, earlier),
    )


def latest(value: Column) -> Measure:
    """Last non-null value up to and including the row."""
    return Measure(
        local=lambda w: F.last(value, ignorenulls=True).over(_so_far(w)),
        summary=lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(_before(w)),
        merge=lambda here, earlier: F.coalesce(here, earlier),
    )


def previous(value: Column) -> Measure:
    """A struct holding the value of the row before (field ``value``); null on the first row."""
    boxed = F.struct(value.alias("value"))
    return Measure(
        local=lambda w: F.lag(boxed).over(w),
        summary=lambda order: F.max_by(boxed, order),
        carry=lambda s, w: F.lag(s).over(w),
        merge=lambda here, earlier: F.coalesce(here, earlier),
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: dict[str, Measure],
    ranges: HotRanges | None,
) -> DataFrame:
    """Add one column per measure, taken over each key's rows in ``order`` (ascending, unique per key).

    ``df`` may carry the range tag already; it then stays, so that several calls in a
    row share one set of ranges. With ranges the tagged rows are written once: the windows
    and the carries both read them, so calls in a row do not repeat what lies below them.
    """
    if ranges is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[m.local(window).alias(name) for name, m in measures.items()])

    tagged = cut_lineage(ranges.tag(df), "tagged")
    window = Window.partitionBy(*keys, RANGE).orderBy(*order)
    # stated, because rows that an earlier join left partitioned by key alone would pass as clustered
    spread = tagged.repartition(*keys, RANGE)
    inside = spread.select("*", *[m.local(window).alias(f"__in_{name}") for name, m in measures.items()])

    order_value = F.struct(*order)
    summaries = (
        tagged.where(F.col(RANGE).isNotNull())
        .groupBy(*keys, RANGE)
        .agg(*[m.summary(order_value).alias(f"__of_{name}") for name, m in measures.items()])
    )
    across = Window.partitionBy(*keys).orderBy(RANGE)
    carries = summaries.select(
        *[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        F.col(RANGE).alias("__at"),
        *[m.carry(F.col(f"__of_{name}"), across).alias(f"__up_{name}") for name, m in measures.items()],
    )
    same_range = F.col(RANGE) == F.col("__at")
    for i, key in enumerate(keys):
        same_range = same_range & F.col(key).eqNullSafe(F.col(f"__key{i}"))
    # one small row per range; as a written table its size is known, and Spark broadcasts it or not by that
    return inside.join(cut_lineage(carries, "carries"), same_range, "left").select(
        *df.columns,
        *[m.merge(F.col(f"__in_{name}"), F.col(f"__up_{name}")).alias(name) for name, m in measures.items()],
    )


def running_since(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counted: Column,
    reset: Column,
    name: str,
    ranges: HotRanges | None,
) -> DataFrame:
    """Add ``name``: how many rows were ``counted`` after the last ``reset`` row, this row included.

    A row that is both counts as a reset.
    """
    is_reset = F.coalesce(reset, F.lit(False))
    counts = F.when(~is_reset & F.coalesce(counted, F.lit(False)), 1).otherwise(0)
    df_columns = df.columns
    marked = df.withColumn("__is_reset", is_reset)
    if ranges is not None:
        marked = ranges.tag(marked)
    summed = running(marked, keys, order, {"__sum": total(counts)}, ranges)
    based = running(summed, keys, order, {"__base": latest(F.when(F.col("__is_reset"), F.col("__sum")))}, ranges)
    return based.select(*df_columns, (F.col("__sum") - F.coalesce(F.col("__base"), F.lit(0))).alias(name))


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    rows_per_range: float | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key.

    Up to the session's group-limit threshold each task first drops all but its own
    ``n`` leading rows per key, so even a hot key shuffles only ``n`` rows per task.
    Above it, rows are numbered range by range.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    ranges = None
    if n > threshold:
        ranges = find_hot_ranges(df, keys, order, rows_per_range)
    if ranges is None:
        numbered = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        numbered = running(df, keys, order, {"__n": row_count()}, ranges)
    return numbered.where(F.col("__n") <= n).drop("__n")
