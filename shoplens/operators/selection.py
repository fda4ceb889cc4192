"""From scores to the final list: top fractions, unions, consensus."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.quantile import exact_percentile, exact_percentiles
from shoplens.operators.samples import SAMPLE_KEYS

# Percentiles of the last day and of the day before, per kind of model.
SEGMENT_PERCENTS = (92, 98)
POOLED_PERCENTS = (92, 99)


def top_fraction(scored: DataFrame, percent: float, score: str = "score") -> DataFrame:
    """Rows strictly above the percentile of their score; ties at the threshold are left out."""
    threshold = exact_percentile(scored, score, percent / 100)
    return scored.where(F.col(score) > F.lit(threshold).cast("double"))


def select_days(
    scored: DataFrame, days: tuple[date, date], percents: tuple[float, float],
    score: str = "score", keys: list[str] = SAMPLE_KEYS,
) -> DataFrame:
    """Distinct keys in the top fraction of any of the given days, each with its own percentile. All
    percentiles come from the same passes, and the rows from one more."""
    fractions = {day: percent / 100 for day, percent in zip(days, percents, strict=True)}
    thresholds = exact_percentiles(scored, score, fractions, "anchor_date")
    above = [(F.col("anchor_date") == F.lit(day)) & (F.col(score) > F.lit(t)) for day, t in thresholds.items() if t is not None]
    return scored.where(reduce(or_, above, F.lit(False))).select(*keys).distinct()


def merged(*selections: DataFrame) -> DataFrame:
    """Union of selections without duplicates."""
    result = selections[0]
    for part in selections[1:]:
        result = result.unionByName(part)
    return result.distinct()


def consensus(pooled: DataFrame, *segments: DataFrame, keys: list[str] = SAMPLE_KEYS) -> DataFrame:
    """Keys chosen by the pooled model and by any segment model."""
    return pooled.join(merged(*segments), keys, "left_semi")
