"""Reports on the log: daily curves, buyers, purchase lag, abnormal days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.samples import SAMPLE_KEYS
from shoplens.settings import PURCHASE


def daily_curve(log: DataFrame) -> DataFrame:
    """Actions per day and type."""
    return log.groupBy("action_date", "type").agg(F.sum("n").alias("actions"))


def _purchases(log: DataFrame) -> DataFrame:
    return log.where(F.col("type") == PURCHASE).select(*SAMPLE_KEYS, "action_date").distinct()


def daily_buyers(log: DataFrame, day: date) -> DataFrame:
    """Purchased (user, cate, shop) per day, and those by users active on ``day``."""
    active = log.where(F.col("action_date") == F.lit(day)).select("user_id").distinct()
    marked = _purchases(log).join(active.withColumn("was_active", F.lit(1)), "user_id", "left")
    return marked.groupBy("action_date").agg(
        F.count(F.lit(1)).alias("buyers"), F.count("was_active").alias("active_buyers")
    )


def purchase_lag(log: DataFrame, horizon: int = 7) -> DataFrame:
    """For every activity day: purchases of its users 1..horizon days later, by lag.

    A purchase on day p is sent to the days p - horizon .. p - 1 and meets the user's activity there
    by an equi-join.
    """
    active = log.select("user_id", F.col("action_date").alias("activity_day")).distinct()
    day = F.col("action_date")
    earlier = F.explode(F.sequence(F.date_sub(day, horizon), F.date_sub(day, 1))).alias("activity_day")
    bought = _purchases(log).groupBy("user_id", "action_date").agg(F.count(F.lit(1)).alias("purchases"))
    return (
        bought.select("user_id", "action_date", "purchases", earlier)
        .join(active, ["user_id", "activity_day"], "left_semi")
        .groupBy("activity_day", F.datediff("action_date", "activity_day").alias("lag"))
        .agg(F.sum("purchases").alias("purchases"))
    )


def recency_lag(log: DataFrame, day: date, recencies: tuple[int, ...] = (0, 1, 2), horizon: int = 7) -> DataFrame:
    """Purchases after ``day`` by lag, for users grouped by the days since they were last active."""
    today = F.lit(day)
    last = (
        log.where(F.col("action_date") <= today)
        .groupBy("user_id")
        .agg(F.datediff(today, F.max("action_date")).alias("recency"))
        .where(F.col("recency").isin(*recencies))
    )
    future = (
        _purchases(log)
        .where((F.col("action_date") > today) & (F.col("action_date") <= F.date_add(today, horizon)))
        .groupBy("user_id", "action_date")
        .agg(F.count(F.lit(1)).alias("purchases"))
    )
    return (
        future.join(last, "user_id")
        .groupBy("recency", F.datediff("action_date", today).alias("lag"))
        .agg(F.sum("purchases").alias("purchases"))
    )


def abnormal_days(log: DataFrame, low: float = 0.5) -> DataFrame:
    """Every day of the log per type: its count, the type's span and mean, and flags.

    ``missing`` marks days without any action of the type, ``abnormal`` days below ``low`` times
    the type's mean over the whole span of the log. Works on the daily curve: days x types rows.
    """
    curve = daily_curve(log)
    span = curve.agg(F.min("action_date").alias("first"), F.max("action_date").alias("last"))
    types = curve.groupBy("type").agg(
        F.min("action_date").alias("first_day"),
        F.max("action_date").alias("last_day"),
        F.sum("actions").alias("total"),
    )
    whole = span.select(F.struct("first", "last")).scalar()
    grid = types.withColumn("span", whole).select(
        "type", "first_day", "last_day",
        (F.col("total") / (F.datediff("span.last", "span.first") + 1)).alias("mean_actions"),
        F.explode(F.sequence("span.first", "span.last")).alias("action_date"),
    )
    days = grid.join(curve, ["type", "action_date"], "left").na.fill(0, ["actions"])
    return days.select(
        "type", "action_date", "first_day", "last_day", "actions", "mean_actions",
        (F.col("actions") == 0).cast("int").alias("missing"),
        (F.col("actions") < F.lit(low) * F.col("mean_actions")).cast("int").alias("abnormal"),
    )
