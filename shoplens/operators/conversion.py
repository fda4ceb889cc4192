"""Smoothed conversion rates from browsing to another action type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys, smoothed, sum_where
from shoplens.settings import BROWSE, ONE_KEY_PRIOR, TWO_KEY_PRIOR, Calendar

# Key sets and target action types of the rates.
ONE_KEY = [["cate"], ["user_id"], ["shop_id"], ["province"], ["city"], ["county"], ["age"], ["sex"]]
TWO_KEYS = [
    ["user_id", "cate"], ["user_id", "shop_id"], ["cate", "shop_id"],
    ["age", "shop_id"], ["age", "cate"], ["age", "province"], ["age", "city"], ["age", "county"],
    ["sex", "shop_id"], ["sex", "cate"], ["sex", "province"], ["sex", "city"], ["sex", "county"],
]
TARGET_TYPES = (2, 3, 4)


def rate_name(keys: list[str], target: int) -> str:
    # Fixed value: the spelling of the result column.
    return f"{'_'.join(keys)}_{target}_coversion_rate"


def overall_rates(log: DataFrame, calendar: Calendar, targets: tuple[int, ...] = TARGET_TYPES) -> DataFrame:
    """One row: for each target type its actions per browse before the cut-off day."""
    kind = F.col("type")
    browses = sum_where(kind == BROWSE)
    return _past(log, calendar).agg(*[F.try_divide(sum_where(kind == t), browses).alias(f"mean_{t}") for t in targets])


def conversion_rates(
    log: DataFrame, calendar: Calendar, keys: list[str],
    targets: tuple[int, ...] = TARGET_TYPES, prior: int | None = None, overall: DataFrame | None = None,
) -> DataFrame:
    """``(n_t + k m) / (n_browse + k)`` per key with at least one browse before the cut-off day.

    ``m`` is the same ratio over all rows, ``k`` is ``prior`` (by default 1000 for one key and 500
    for two). All target types come from one aggregate. ``overall`` is the written result of
    :func:`overall_rates`, for callers with many key sets.
    """
    if prior is None:
        prior = ONE_KEY_PRIOR if len(keys) == 1 else TWO_KEY_PRIOR
    if overall is None:
        overall = overall_rates(log, calendar, targets)
    kind = F.col("type")
    counts = [sum_where(kind == BROWSE).alias("browses")]
    counts += [sum_where(kind == t).alias(f"hits_{t}") for t in targets]
    means = overall.select(F.struct(*[f"mean_{t}" for t in targets])).scalar()
    table = known_keys(_past(log, calendar), keys).groupBy(*keys).agg(*counts).where("browses > 0")
    rates = [
        smoothed(F.col(f"hits_{t}"), F.col("browses"), prior, F.col(f"means.mean_{t}")).alias(rate_name(keys, t))
        for t in targets
    ]
    return table.withColumn("means", means).select(*keys, *rates)


def _past(log: DataFrame, calendar: Calendar) -> DataFrame:
    return log.where(F.col("action_date") < F.lit(calendar.conversion_before))
