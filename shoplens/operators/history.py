"""Long-run action counts before a cut-off day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys, short_name, sum_where
from shoplens.settings import Calendar

# Key sets, in result order, and the types counted one by one.
HISTORY_KEYS = [
    ["user_id"], ["shop_id"], ["cate"], ["user_id", "cate"], ["shop_id", "cate"],
    ["user_id", "shop_id"], ["user_id", "cate", "shop_id"],
]
HISTORY_TYPES = (1, 2, 3, 4)


def history_counts(log: DataFrame, calendar: Calendar, keys: list[str]) -> DataFrame:
    """All actions, and those of types 1-4, per key over all days before the cut-off."""
    name = short_name(keys)
    past = log.where(F.col("action_date") < F.lit(calendar.history_before))
    counts = [F.sum("n").alias(f"{name}_action_times")]
    counts += [sum_where(F.col("type") == t).alias(f"{name}_action{t}_times") for t in HISTORY_TYPES]
    return known_keys(past, keys).groupBy(*keys).agg(*counts)


def type_counts_by_full_join(log: DataFrame, keys: list[str], types: tuple[int, ...]) -> DataFrame:
    """Per-type counts assembled by a chain of full outer joins.

    Kept for callers that hold the per-type tables separately; one conditional aggregate, as in
    :func:`history_counts`, gives the same from a single shuffle.
    """
    name = short_name(keys)
    rows = known_keys(log, keys)
    joined = rows.groupBy(*keys).agg(F.sum("n").alias(f"{name}_action_times"))
    for t in types:
        part = rows.where(F.col("type") == t).groupBy(*keys).agg(F.sum("n").alias(f"{name}_action{t}_times"))
        joined = joined.join(part, keys, "full")
    return joined.na.fill(0)
