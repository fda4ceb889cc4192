"""Enriched action log, smoothed comment rates, and the report on unmatched actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import smoothed, total
from shoplens.settings import COMMENT_PRIOR
from shoplens.sources.tables import Tables

PRODUCT_COLUMNS = ["sku_id", "brand", "shop_id", "cate"]
USER_COLUMNS = ["user_id", "age", "sex", "province", "city", "county"]


def dated(actions: DataFrame) -> DataFrame:
    """Actions with the calendar day of their timestamp."""
    return actions.withColumn("action_date", F.to_date("action_time"))


def roll_up_daily(actions: DataFrame) -> DataFrame:
    """One row per (user, sku, module, type, day) with its action count ``n``."""
    return (
        dated(actions)
        .groupBy("user_id", "sku_id", "module_id", "type", "action_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def enrich(actions: DataFrame, tables: Tables) -> DataFrame:
    """Add product and user columns; actions without product, shop or user vanish.

    Products meet shops first, a join of two dimension tables, so that the log itself is joined
    only twice.
    """
    sellable = tables.products.select(*PRODUCT_COLUMNS).join(
        tables.shops.select("shop_id"), "shop_id", "left_semi"
    )
    return actions.join(sellable, "sku_id").join(tables.users.select(*USER_COLUMNS), "user_id")


def enriched_actions(tables: Tables) -> DataFrame:
    """Enriched log at row level."""
    return enrich(dated(tables.actions), tables)


def daily_log(tables: Tables) -> DataFrame:
    """Enriched log rolled up to days *before* the joins; every feature reads this with weight ``n``."""
    return enrich(roll_up_daily(tables.actions), tables)


def sku_comment_rates(comments: DataFrame, prior: int = COMMENT_PRIOR) -> DataFrame:
    """Comment sums and smoothed good/bad rates per sku."""
    sums = (
        comments.dropna(subset=["sku_id"])
        .groupBy("sku_id")
        .agg(
            total("comments").alias("sku_comment_nums"),
            total("good_comments").alias("sku_good_comment_nums"),
            total("bad_comments").alias("sku_bad_comment_nums"),
        )
    )
    # Overall rates are taken from the sums per sku, so both read one shuffle of the comments.
    means = sums.agg(
        F.struct(
            *[
                F.try_divide(F.sum(f"sku_{kind}_comment_nums"), F.sum("sku_comment_nums")).alias(kind)
                for kind in ("good", "bad")
            ]
        )
    ).scalar()
    rates = [
        smoothed(F.col(f"sku_{kind}_comment_nums"), F.col("sku_comment_nums"), prior, F.col(f"means.{kind}")).alias(
            f"sku_{kind}_comment_rate"
        )
        for kind in ("good", "bad")
    ]
    return sums.withColumn("means", means).select("*", *rates).drop("means")


def rated_products(tables: Tables, prior: int = COMMENT_PRIOR) -> DataFrame:
    """Product table with its comment sums and rates, NULL where a sku has no comment."""
    return tables.products.join(sku_comment_rates(tables.comments, prior), "sku_id", "left")


def dirty_rows(tables: Tables) -> DataFrame:
    """Number of actions, and of distinct users and skus behind them, per kind of missing match.

    The log is rolled up before the look-ups, which are left joins: one pass instead of one
    anti-join per table.
    """
    pairs = tables.actions.groupBy("user_id", "sku_id").agg(F.count(F.lit(1)).alias("n"))
    products = tables.products.select("sku_id", "shop_id", F.lit(1).alias("has_product"))
    shops = tables.shops.select("shop_id", F.lit(1).alias("has_shop"))
    users = tables.users.select("user_id", F.lit(1).alias("has_user"))
    found = products.join(shops, "shop_id", "left").select("sku_id", "has_product", "has_shop")
    status = (
        F.when(F.col("has_product").isNull(), "no product")
        .when(F.col("has_shop").isNull(), "no shop")
        .when(F.col("has_user").isNull(), "no user")
        .otherwise("matched")
    )
    checked = pairs.join(found, "sku_id", "left").join(users, "user_id", "left").withColumn("status", status)
    return checked.groupBy("status").agg(
        F.sum("n").alias("actions"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("sku_id").alias("skus"),
    )
