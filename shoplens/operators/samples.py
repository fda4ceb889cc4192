"""Samples on anchor days and their purchase labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys
from shoplens.settings import PURCHASE, Calendar

SAMPLE_KEYS = ["user_id", "cate", "shop_id"]


def samples(log: DataFrame, calendar: Calendar, keys: list[str] = SAMPLE_KEYS) -> DataFrame:
    """Distinct key tuples active on an anchor day."""
    return (
        known_keys(log.where(F.col("action_date").isin(*calendar.anchors)), keys)
        .select(*keys, F.col("action_date").alias("anchor_date"))
        .distinct()
    )


def last_day_samples(log: DataFrame, keys: list[str]) -> DataFrame:
    """One sample per key tuple, on the last day it was active."""
    return known_keys(log, keys).groupBy(*keys).agg(F.max("action_date").alias("anchor_date"))


def label(
    sample: DataFrame,
    log: DataFrame,
    calendar: Calendar,
    keys: list[str] = SAMPLE_KEYS,
    horizon: int | None = None,
    last_data_day: date | None = None,
) -> DataFrame:
    """Add ``flag``: 1 if the same keys have a purchase in ``(anchor, anchor + horizon]``.

    A purchase on day p answers the anchors p - horizon .. p - 1, so spreading the few purchases
    over these days turns the range condition into a plain equi-join. With ``last_data_day`` a
    column ``label_complete`` tells whether the whole horizon lies inside the data.
    """
    horizon = horizon or calendar.horizon
    day = F.col("action_date")
    bought = known_keys(log.where(F.col("type") == PURCHASE), keys).where(
        (day > F.lit(calendar.first)) & (day <= F.date_add(F.lit(calendar.last), horizon))
    )
    answered = (
        bought.select(*keys, "action_date")
        .distinct()
        .select(*keys, F.explode(F.sequence(F.date_sub(day, horizon), F.date_sub(day, 1))).alias("anchor_date"))
        .where(F.col("anchor_date").isin(*calendar.anchors))
        .distinct()
        .withColumn("hit", F.lit(1))
    )
    labelled = sample.join(answered, [*keys, "anchor_date"], "left").withColumn(
        "flag", F.coalesce("hit", F.lit(0))
    )
    if last_data_day is not None:
        labelled = labelled.withColumn(
            "label_complete", F.date_add("anchor_date", horizon) <= F.lit(last_data_day)
        )
    return labelled.drop("hit")


def label_horizons(
    sample: DataFrame, log: DataFrame, calendar: Calendar, horizons: tuple[int, ...],
    keys: list[str] = SAMPLE_KEYS,
) -> DataFrame:
    """``flag_{h}`` for several horizons from one pass: the days until the next purchase decide all."""
    day = F.col("action_date")
    longest = max(horizons)
    bought = known_keys(log.where(F.col("type") == PURCHASE), keys).where(
        (day > F.lit(calendar.first)) & (day <= F.date_add(F.lit(calendar.last), longest))
    )
    wait = (
        bought.select(*keys, "action_date")
        .distinct()
        .select(
            *keys, day,
            F.explode(F.sequence(F.date_sub(day, longest), F.date_sub(day, 1))).alias("anchor_date"),
        )
        .where(F.col("anchor_date").isin(*calendar.anchors))
        .groupBy(*keys, "anchor_date")
        .agg(F.min(F.datediff("action_date", "anchor_date")).alias("wait"))
    )
    joined = sample.join(wait, [*keys, "anchor_date"], "left")
    flags = [F.coalesce((F.col("wait") <= h).cast("int"), F.lit(0)).alias(f"flag_{h}") for h in horizons]
    return joined.select(*keys, "anchor_date", *flags)


def next_purchase(sample: DataFrame, log: DataFrame, keys: list[str] = SAMPLE_KEYS) -> DataFrame:
    """(keys, anchor_date, wait): days from each distinct sample to the next purchase of its keys after the
    anchor; null without one.

    An as-of join: samples and purchases become one row per keys and day, and a running value over the
    days in descending order is the next purchase. Nothing is repeated per day of a horizon, and hot keys
    cost no more than their number of days.
    """
    day = F.col("action_date")
    bought = known_keys(log.where(F.col("type") == PURCHASE), keys).select(*keys, day, F.lit(1).alias("bought"), F.lit(0).alias("asked"))
    asked = sample.select(*keys, F.col("anchor_date").alias("action_date"), F.lit(0).alias("bought"), F.lit(1).alias("asked"))
    days = asked.unionByName(bought).groupBy(*keys, "action_date").agg(F.max("bought").alias("bought"), F.max("asked").alias("asked"))
    later = Window.partitionBy(*keys).orderBy(F.desc("action_date")).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col("bought") == 1, day), ignorenulls=True).over(later)
    waits = days.withColumn("wait", F.datediff(following, day)).where("asked = 1")
    return waits.select(*keys, day.alias("anchor_date"), "wait")


def label_next_purchase(
    sample: DataFrame, log: DataFrame, horizons: tuple[int, ...], keys: list[str] = SAMPLE_KEYS
) -> DataFrame:
    """Distinct samples with ``flag_{h}`` for horizons of any length, by the wait for the next purchase."""
    flags = [F.coalesce((F.col("wait") <= h).cast("int"), F.lit(0)).alias(f"flag_{h}") for h in horizons]
    return next_purchase(sample, log, keys).select(*keys, "anchor_date", *flags)
