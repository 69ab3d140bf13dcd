"""Left join of a large table with one row per key, with hot keys taken apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.plans.durable import cut_lineage
from tidemark.plans.hot_ranges import find_hot_keys, hot_names, same_key


def join_one_per_key(
    rows: DataFrame, one_per_key: DataFrame, keys: Sequence[str], rows_per_range: float | None = None
) -> DataFrame:
    """``rows`` left join ``one_per_key`` on non-null ``keys``.

    Rows of a hot key meet the hot keys' single rows only, a written table that Spark
    broadcasts if its size allows; the other rows use an ordinary join. Adaptive execution would split a hot
    partition too, but not where an aggregate on the same key follows.
    """
    found = find_hot_keys(rows, keys, rows_per_range)
    if found is None:
        return rows.join(one_per_key, list(keys), "left")
    hot = found.drop("__wanted", "__rate")
    names = hot_names(keys)
    singles = cut_lineage(one_per_key.join(hot, same_key(keys), "left_semi"), "singles")
    of_hot = rows.join(hot, same_key(keys), "left_semi").join(singles, list(keys), "left")
    of_others = rows.join(hot, same_key(keys), "left_anti").join(one_per_key, list(keys), "left")
    return of_hot.drop(*names).unionByName(of_others)
