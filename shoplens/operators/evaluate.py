"""Precision, recall and F of a selection at pair and triple level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the pair level (user, cate) and of the triple level (user, cate, shop).
PAIR_WEIGHT = 0.4
TRIPLE_WEIGHT = 0.6


def _level(predicted: DataFrame, truth: DataFrame, keys: list[str], beta: float) -> Column:
    """Counts and rates of one level as a one-row struct; one shuffle over both key lists."""
    both = predicted.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        truth.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    marked = both.groupBy(*keys).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    counts = marked.agg(
        F.sum("p").alias("predicted"), F.sum("t").alias("actual"), F.sum(F.col("p") * F.col("t")).alias("hits")
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    rated = counts.select("*", precision.alias("precision"), recall.alias("recall"))
    weight = beta * beta
    f = F.try_divide(
        F.lit(1.0 + weight) * F.col("precision") * F.col("recall"),
        F.lit(weight) * F.col("precision") + F.col("recall"),
    )
    return rated.select(F.struct("*", F.coalesce(f, F.lit(0.0)).alias("f"))).scalar()


def evaluate_selection(
    predicted: DataFrame, truth: DataFrame, beta: float = 1.0,
    weights: tuple[float, float] = (PAIR_WEIGHT, TRIPLE_WEIGHT),
) -> DataFrame:
    """One row: counts, precision, recall and F per level, and the weighted score.

    Repeated pairs count once.
    """
    spark = predicted.sparkSession
    levels = spark.range(1).select(
        _level(predicted, truth, ["user_id", "cate"], beta).alias("pair"),
        _level(predicted, truth, ["user_id", "cate", "shop_id"], beta).alias("triple"),
    )
    names = ["predicted", "actual", "hits", "precision", "recall", "f"]
    columns = [F.col(f"{level}.{name}").alias(f"{level}_{name}") for level in ("pair", "triple") for name in names]
    score = F.lit(weights[0]) * F.col("pair.f") + F.lit(weights[1]) * F.col("triple.f")
    return levels.select(*columns, score.alias("score"))
