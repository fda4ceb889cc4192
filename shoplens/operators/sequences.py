"""Ordered behaviour sequence of each user, cut into pieces of bounded length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.session import HandOver

ORDER = ["user_id", "action_time", "sku_id", "type"]


def user_sequences(actions: DataFrame, length: int = 512, hand_over: HandOver | None = None) -> DataFrame:
    """All actions of each user in time order, as pieces of at most ``length`` steps.

    Piece 0 holds steps 0 .. length - 1, and so on; nothing is dropped. All actions are put in one
    order by a range shuffle, which cuts at any place, also within one user's second, and written.
    An action's step is its number in its part, plus what the user has in earlier parts: one row per
    user and part. So neither a user, nor a day without times, nor a burst ends up in one task.
    """
    store = hand_over or HandOver(actions.sparkSession)
    parts = max(2, int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The row number separates equal actions, which may be many.
    rows = actions.select(*ORDER, F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(parts, *ORDER, "row").sortWithinPartitions(*ORDER, "row")
    numbered = store.put("ordered", ordered.select(*ORDER, F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)  # partition number, as monotonically_increasing_id builds it
    held = numbered.groupBy("user_id", part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("user_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("user_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A user's actions are side by side in a part, so its first place counts them off.
    joined = numbered.withColumn("part", part).join(offsets, ["user_id", "part"])
    steps = joined.withColumn("step", F.col("before") + F.col("place") - F.col("first"))
    piece = F.floor(F.col("step") / length).alias("piece")
    return (
        steps.groupBy("user_id", piece)
        .agg(F.sort_array(F.collect_list(F.struct("step", "action_time", "sku_id", "type"))).alias("steps"))
        .select("user_id", "piece", F.size("steps").alias("n_steps"), "steps")
    )
