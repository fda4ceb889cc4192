"""Catalogue size and comment statistics of shops, categories and their pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import VALUE_NAMES, known_keys, short_name, total

# What is counted within each key.
OWNED = {
    ("shop_id",): ["sku_id", "brand", "cate"],
    ("cate",): ["sku_id", "brand", "shop_id"],
    ("shop_id", "cate"): ["sku_id", "brand"],
}


def catalogue(products: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct things owned, comment sums, and mean/max/min comment rates per key.

    A key without any comment gets the mean over all keys for the rate columns.
    """
    name = short_name(keys)
    owned = [F.count_distinct(v).alias(f"{name}_own_{VALUE_NAMES[v]}") for v in OWNED[tuple(keys)]]
    sums = [
        total("sku_comment_nums").alias(f"{name}_comment_nums"),
        total("sku_good_comment_nums").alias(f"{name}_good_comment_nums"),
        total("sku_bad_comment_nums").alias(f"{name}_bad_comment_nums"),
    ]
    rates = [
        stat(f"sku_{kind}_comment_rate").alias(f"{name}_{kind}_comm_rate_{label}")
        for kind in ("good", "bad")
        for label, stat in (("mean", F.avg), ("max", F.max), ("min", F.min))
    ]
    groups = known_keys(products, keys).groupBy(*keys)
    table = groups.agg(*owned, *sums, *rates)
    rate_names = [c for c in table.columns if "_comm_rate_" in c]
    means = groups.agg(*rates).agg(F.struct(*[F.avg(c).alias(c) for c in rate_names]).alias("mean")).scalar()
    filled = table.withColumn("mean", means)
    return filled.withColumns({c: F.coalesce(c, F.col(f"mean.{c}")) for c in rate_names}).drop("mean")
