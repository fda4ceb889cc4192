"""Trailing distinct counts: how many categories, shops, skus, brands or modules a key touched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import VALUE_NAMES, known_keys, short_name
from shoplens.operators.trailing import LONGEST_SET, active_anchors, at_anchors, day_bit, days_up_to_anchor, in_reach, window_bits
from shoplens.settings import Calendar

# Key sets and what is counted for them, in result order.
BREADTH = [
    (["user_id"], ["cate", "module_id", "shop_id", "sku_id"]),
    (["shop_id"], ["sku_id", "brand"]),
    (["cate"], ["shop_id", "sku_id", "brand"]),
    (["user_id", "cate"], ["shop_id", "sku_id", "brand"]),
]
BREADTH_TYPES = (1, 2, 3, 4)


def breadth_name(keys: list[str], kind: int | None, value: str, days: int) -> str:
    """``kind`` None stands for any action type."""
    return f"{short_name(keys)}_action{'' if kind is None else kind}_{VALUE_NAMES[value]}_{days}day"


def trailing_distinct(
    log: DataFrame, calendar: Calendar, keys: list[str], values: list[str], only_active: bool = False,
    types: tuple[int, ...] = BREADTH_TYPES,
) -> DataFrame:
    """Exact distinct counts of several columns per (keys, anchor), window and type.

    First each (keys, value) pair is reduced to one bit set of days per type, a mergeable aggregate
    spread over the values, so that no key is a hot spot. Then pairs are counted per anchor with
    plain conditional counts. Nothing is expanded per window or type, and all value columns share
    the two shuffles.

    With ``only_active`` only anchors on which the keys were active get a row (see
    :func:`shoplens.operators.trailing.trailing_counts`). Anchors too far apart for one bit set are
    split and the parts put together. Windows longer than a bit set count by the latest day instead.
    """
    if calendar.reach > LONGEST_SET:
        return _distinct_by_age(log, calendar, keys, values, only_active, types)
    spans = calendar.spans()
    if len(spans) > 1:
        return reduce(
            DataFrame.unionByName, [trailing_distinct(log, s, keys, values, only_active, types) for s in spans]
        )
    rows = known_keys(in_reach(log, calendar), keys)
    kind = dict(rows.dtypes)
    common = "string" if any(kind[v] == "string" for v in values) else "bigint"
    items = F.array(
        *[F.struct(F.lit(v).alias("what"), F.col(v).cast(common).alias("value")) for v in values]
    )
    bit = day_bit(calendar)
    pairs = (
        rows.select(*keys, "type", bit.alias("bit"), F.inline(items))
        .groupBy(*keys, "what", "value")
        .agg(
            F.bit_or("bit").alias("m"),
            *[F.bit_or(F.when(F.col("type") == t, F.col("bit"))).alias(f"m{t}") for t in types],
        )
    )
    masks = {None: "m", **{t: f"m{t}" for t in types}}
    if only_active:
        # Pairs meet the anchors on which their key was active, and no others are made.
        placed = pairs.join(active_anchors(log, calendar, keys), keys)
    else:
        placed = pairs.withColumn("anchor_date", F.explode(F.array(*[F.lit(a) for a in calendar.anchors])))
    spread = (
        placed.select(
            *keys, "anchor_date", "what", F.col("value").isNotNull().alias("known"),
            *[days_up_to_anchor(m, calendar).alias(m) for m in masks.values()],
        )
        .where(F.col("m").bitwiseAND(window_bits(calendar.reach)) != 0)
    )
    # SQL text: dozens of generated columns are built far faster from text than from Column calls.
    counts = [
        F.expr(
            f"count_if(what = '{v}' and known and ({masks[t]} & {(1 << n) - 1}) != 0)"
        ).alias(breadth_name(keys, t, v, n))
        for n in calendar.windows
        for v in values
        for t in masks
    ]
    return spread.groupBy(*keys, "anchor_date").agg(*counts)


def _distinct_by_age(
    log: DataFrame, calendar: Calendar, keys: list[str], values: list[str], only_active: bool, types: tuple[int, ...]
) -> DataFrame:
    """The same for windows of any length: a pair counts in a window if its latest day up to the
    anchor lies in it. Days are repeated for the anchors that see them, so this costs more rows."""
    rows = known_keys(in_reach(log, calendar), keys)
    kind = dict(rows.dtypes)
    common = "string" if any(kind[v] == "string" for v in values) else "bigint"
    items = F.array(*[F.struct(F.lit(v).alias("what"), F.col(v).cast(common).alias("value")) for v in values])
    daily = rows.select(*keys, "type", "action_date", F.inline(items)).distinct()
    spread = at_anchors(daily, calendar)
    if only_active:
        spread = spread.join(active_anchors(log, calendar, keys), [*keys, "anchor_date"], "left_semi")
    age = F.datediff("anchor_date", "action_date")
    latest = spread.groupBy(*keys, "anchor_date", "what", "value").agg(
        F.min(age).alias("a"), *[F.min(F.when(F.col("type") == t, age)).alias(f"a{t}") for t in types]
    )
    ages = {None: "a", **{t: f"a{t}" for t in types}}
    counts = [
        F.expr(f"count_if(what = '{v}' and value is not null and {ages[t]} < {n})").alias(breadth_name(keys, t, v, n))
        for n in calendar.windows
        for v in values
        for t in ages
    ]
    return latest.groupBy(*keys, "anchor_date").agg(*counts)
