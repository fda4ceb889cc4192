"""Places of rows in the order of their group, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import written


def numbered(rows: DataFrame, group: str, order: list[str], place: str, size: str) -> DataFrame:
    """``rows`` with their ``place`` (from 0) in the order of their group, and the group's ``size``.

    One range shuffle puts all rows in order, which also cuts within a group and between equal rows, and
    is written. A row's place is its number in its part plus what its group has in earlier parts: a table
    of one row per group and part. ``group`` holds no nulls; equal rows follow each other in any order.
    """
    keys = [group, *order, "_on_row"]
    # The row number separates equal rows, which may be many.
    ordered = rows.withColumn("_on_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = written(ordered.drop("_on_row").withColumn("_on_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_on_at", 33)  # partition number, as monotonically_increasing_id builds it
    held = kept.groupBy(group, part.alias("_on_part")).agg(F.count("*").alias("_on_n"), F.min("_on_at").alias("_on_first"))
    whole, earlier = Window.partitionBy(group), Window.partitionBy(group).orderBy("_on_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_on_n").over(earlier), F.lit(0)) - F.col("_on_first")
    offsets = written(held.select(group, "_on_part", before.alias("_on_before"), F.sum("_on_n").over(whole).alias(size)), "offsets")
    joined = kept.withColumn("_on_part", part).join(offsets, [group, "_on_part"])
    return joined.withColumn(place, F.col("_on_at") + F.col("_on_before")).drop("_on_at", "_on_part", "_on_before")
