"""Gap features: rhythm and recency of the active days of a key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys


def gap_features(log: DataFrame, keys: list[str], until: date, by_type: bool = True) -> DataFrame:
    """First and last active day, recency, and mean, min and variance of the gaps in days.

    Only days up to ``until`` count. Days are made distinct before the window, which bounds each
    window partition by the number of days.
    """
    group = [*keys, "type"] if by_type else list(keys)
    days = (
        known_keys(log.where(F.col("action_date") <= F.lit(until)), keys).select(*group, "action_date").distinct()
    )
    in_order = Window.partitionBy(*group).orderBy("action_date")
    gaps = days.withColumn("gap", F.datediff("action_date", F.lag("action_date").over(in_order)))
    return gaps.groupBy(*group).agg(
        F.count(F.lit(1)).alias("active_days"),
        F.min("action_date").alias("first_day"),
        F.max("action_date").alias("last_day"),
        F.datediff(F.lit(until), F.max("action_date")).alias("recency"),
        F.avg("gap").alias("gap_mean"),
        F.min("gap").alias("gap_min"),
        F.var_samp("gap").alias("gap_var"),
    )
