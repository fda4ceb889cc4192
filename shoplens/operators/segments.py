"""User segments and what follows from them: restriction, time split, rules, conversion."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys, sum_where
from shoplens.settings import ACTION_TYPES, CART, PURCHASE, Calendar


def _class_of(all_actions: Column, purchases: Column, carts: Column) -> Column:
    return F.when(purchases == all_actions, 1).when(carts > 0, 2).otherwise(3)


def user_classes(log: DataFrame, cart_span: tuple[date, date] | None = None) -> DataFrame:
    """Action counts per user and the segment they imply.

    1: nothing but purchases; 2: any add-to-cart; 3: everyone else. ``cart_span`` limits the
    add-to-cart test to a closed range of days.
    """
    kind = F.col("type")
    in_span = F.lit(True) if cart_span is None else F.col("action_date").between(*[F.lit(d) for d in cart_span])
    counts = known_keys(log, ["user_id"]).groupBy("user_id").agg(
        F.sum("n").alias("user_action_times"),
        *[sum_where(kind == t).alias(f"user_action{t}_times") for t in ACTION_TYPES],
        sum_where((kind == CART) & in_span).alias("carts"),
    )
    segment = _class_of(F.col("user_action_times"), F.col(f"user_action{PURCHASE}_times"), F.col("carts"))
    return counts.withColumn("user_class", segment).drop("carts")


def in_segment(sample: DataFrame, classes: DataFrame, segment: int) -> DataFrame:
    """Samples of the users of one segment."""
    return sample.join(classes.where(F.col("user_class") == segment).select("user_id"), "user_id", "left_semi")


def training_part(sample: DataFrame, calendar: Calendar) -> DataFrame:
    return sample.where(F.col("anchor_date") < F.lit(calendar.train_before))


def scoring_part(sample: DataFrame, day: date) -> DataFrame:
    return sample.where(F.col("anchor_date") == F.lit(day))


def time_split(sample: DataFrame, calendar: Calendar) -> DataFrame:
    """Role of each sample: training, last anchor, anchor before, or held out."""
    day = F.col("anchor_date")
    role = (
        F.when(day < F.lit(calendar.train_before), "train")
        .when(day == F.lit(calendar.last), "score_last")
        .when(day == F.lit(calendar.before_last), "score_before")
        .otherwise("hold_out")
    )
    return sample.withColumn("part", role)


def repeat_buyers(
    log: DataFrame, classes: DataFrame, last_day: date, days: int = 7, at_least: int = 2,
    keys: list[str] | None = None,
) -> DataFrame:
    """Rule for segment 1: keys with at least two purchases in the last seven days."""
    keys = keys or ["user_id"]
    recent = log.where(
        (F.col("type") == PURCHASE)
        & F.col("action_date").between(F.date_sub(F.lit(last_day), days - 1), F.lit(last_day))
    )
    counts = known_keys(recent, keys).groupBy(*keys).agg(F.sum("n").alias("purchases"))
    return in_segment(counts.where(F.col("purchases") >= at_least), classes, 1)


def segment_conversion(classes: DataFrame, labelled: DataFrame) -> DataFrame:
    """Users, samples, positive samples and conversion per segment."""
    per_user = labelled.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("samples"), F.sum("flag").alias("positives")
    )
    joined = classes.select("user_id", "user_class").join(per_user, "user_id", "left")
    return (
        joined.groupBy("user_class")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"),
            F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        )
        .withColumn("conversion", F.try_divide("positives", "samples"))
    )
