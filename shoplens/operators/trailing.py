"""Trailing-window action counts and active-day counts per key set, anchor day and window."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys, short_name, sum_where
from shoplens.settings import ACTION_TYPES, Calendar

# Key sets whose counts enter the feature matrix, in result order.
MATRIX_KEYS = [
    ["shop_id"], ["user_id"], ["cate"], ["province"], ["city"], ["county"], ["age"], ["sex"],
    ["user_id", "cate"], ["user_id", "shop_id"], ["sex", "cate"], ["sex", "shop_id"],
    ["age", "cate"], ["age", "shop_id"],
]
# Key sets that are computed on demand only.
EXTRA_KEYS = [
    ["sku_id"], ["brand"], ["user_id", "sku_id"], ["user_id", "brand"], ["sex", "sku_id"],
    ["sex", "brand"], ["age", "sku_id"], ["age", "brand"],
    ["cate", "shop_id"], ["user_id", "cate", "shop_id"],
]
ACTIVE_DAY_TYPES = (2, 3, 4)
# Days of a window that a 64-bit set can hold beside its anchor.
LONGEST_SET = 62


def in_reach(log: DataFrame, calendar: Calendar) -> DataFrame:
    """Rows that fall into some window of some anchor."""
    start = calendar.first - timedelta(days=calendar.reach - 1)
    return log.where(F.col("action_date").between(F.lit(start), F.lit(calendar.last)))


def active_anchors(log: DataFrame, calendar: Calendar, keys: list[str]) -> DataFrame:
    """(keys, anchor_date) for the anchors on which the keys were active."""
    days = known_keys(log.where(F.col("action_date").isin(*calendar.anchors)), keys)
    return days.select(*keys, F.col("action_date").alias("anchor_date")).distinct()


def at_anchors(days: DataFrame, calendar: Calendar) -> DataFrame:
    """Repeat every dated row for each anchor whose longest window holds its day."""
    day = F.col("action_date")
    start = F.greatest(day, F.lit(calendar.first))
    stop = F.least(F.date_add(day, calendar.reach - 1), F.lit(calendar.last))
    rows = in_reach(days, calendar).withColumn("anchor_date", F.explode(F.sequence(start, stop)))
    return rows if calendar.consecutive else rows.where(F.col("anchor_date").isin(*calendar.anchors))


def day_bit(calendar: Calendar) -> Column:
    """Bit for ``action_date`` in a 64-bit set of days; bit 0 is the last anchor.

    Needs a calendar of one span, see :meth:`shoplens.settings.Calendar.spans`.
    """
    return F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.datediff(F.lit(calendar.last), F.col("action_date"))
    )


def days_up_to_anchor(mask: str, calendar: Calendar) -> Column:
    """Day set shifted so that bit 0 is the row's anchor; later days drop out."""
    return F.call_function("shiftright", F.col(mask), F.datediff(F.lit(calendar.last), F.col("anchor_date")))


def window_bits(days: int) -> Column:
    return F.lit((1 << days) - 1).cast("bigint")


def count_name(keys: list[str], kind: int, days: int) -> str:
    return f"{short_name(keys)}_action{kind}_counts_{days}day"


def day_count_name(keys: list[str], kind: int, days: int) -> str:
    return f"{short_name(keys)}_action{kind}_counts_date_{days}day"


def trailing_counts(
    log: DataFrame, calendar: Calendar, keys: list[str], only_active: bool = False,
    types: tuple[int, ...] = ACTION_TYPES,
) -> DataFrame:
    """Actions of each type in ``[anchor - n + 1, anchor]`` for every window n.

    The log is first rolled up to (keys, day), which bounds every later group by the number of
    days, whatever its share of the log. Then

    * by default each (keys, anchor) with an action in the longest window gets a row: days are
      repeated for the anchors that see them and summed conditionally;
    * with ``only_active`` only anchors on which the keys were active get a row. That is all a
      sample can ask for, since a sample is itself an action on its anchor day. Range frames over
      the days of a key give it without repeating rows.
    """
    rows = in_reach(known_keys(log.where(F.col("type").isin(*types)), keys), calendar)
    daily = rows.groupBy(*keys, "action_date").agg(
        *[sum_where(F.col("type") == t).alias(f"n{t}") for t in types]
    )
    if only_active:
        by_day = f"partition by {', '.join(keys)} order by unix_date(action_date)"
        counts = [
            f"sum(n{t}) over ({by_day} range between {n - 1} preceding and current row) as {count_name(keys, t, n)}"
            for n in calendar.windows
            for t in types
        ]
        return (
            daily.selectExpr(*keys, "action_date as anchor_date", *counts)
            .where(F.col("anchor_date").isin(*calendar.anchors))
        )
    spread = at_anchors(daily, calendar).withColumn("elapsed", F.datediff("anchor_date", "action_date"))
    counts = [
        F.expr(f"sum(if(elapsed < {n}, n{t}, 0))").alias(count_name(keys, t, n))
        for n in calendar.windows
        for t in types
    ]
    return spread.groupBy(*keys, "anchor_date").agg(*counts)


def active_days(
    log: DataFrame, calendar: Calendar, keys: list[str], only_active: bool = False,
    types: tuple[int, ...] = ACTIVE_DAY_TYPES,
) -> DataFrame:
    """Distinct days with an action of each type in every window.

    The days of a key form a bit set, so one mergeable aggregate per type answers all anchors and
    windows, with one shuffle and no distinct. Anchors too far apart for one set are split; windows
    longer than a set count their days one by one.
    """
    if calendar.reach > LONGEST_SET:
        return _active_days_by_day(log, calendar, keys, only_active, types)
    spans = calendar.spans()
    if len(spans) > 1:
        return reduce(DataFrame.unionByName, [active_days(log, s, keys, only_active, types) for s in spans])
    bit = day_bit(calendar)
    sets = known_keys(in_reach(log, calendar), keys).groupBy(*keys).agg(
        F.bit_or(bit).alias("any"),
        *[F.bit_or(F.when(F.col("type") == t, bit)).alias(f"m{t}") for t in types],
    )
    spread = sets.withColumn("anchor_date", F.explode(F.array(*[F.lit(a) for a in calendar.anchors])))
    seen = window_bits(1 if only_active else calendar.reach)
    counts = [
        F.coalesce(
            F.bit_count(days_up_to_anchor(f"m{t}", calendar).bitwiseAND(window_bits(n))).cast("bigint"), F.lit(0)
        ).alias(day_count_name(keys, t, n))
        for n in calendar.windows
        for t in types
    ]
    return spread.where(days_up_to_anchor("any", calendar).bitwiseAND(seen) != 0).select(
        *keys, "anchor_date", *counts
    )


def _active_days_by_day(
    log: DataFrame, calendar: Calendar, keys: list[str], only_active: bool, types: tuple[int, ...]
) -> DataFrame:
    days = known_keys(in_reach(log, calendar), keys).groupBy(*keys, "action_date").agg(
        *[F.max((F.col("type") == t).cast("bigint")).alias(f"d{t}") for t in types]
    )
    spread = at_anchors(days, calendar).withColumn("elapsed", F.datediff("anchor_date", "action_date"))
    if only_active:
        spread = spread.join(active_anchors(log, calendar, keys), [*keys, "anchor_date"], "left_semi")
    counts = [
        F.expr(f"sum(if(elapsed < {n}, d{t}, 0))").alias(day_count_name(keys, t, n)) for n in calendar.windows for t in types
    ]
    return spread.groupBy(*keys, "anchor_date").agg(*counts)
