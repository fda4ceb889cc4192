"""The five input tables derived from the synthetic star-schema Parquet tables.

Every source table is read whole. Products of size 46..50 carry no shop, so their actions find no
shop; customers with ``c_custkey % 50 = 49`` carry no sex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.tables import Tables

# Action type code of each event type; anything else is 5 (add to cart).
EVENT_CODES = {"view": 1, "purchase": 2, "click": 3, "signup": 4}
CART_CODE = 5


# Columns read from each source table; a declared schema saves a job per table for its footer.
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_acctbal double",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "orders": "o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_shipdate timestamp_ntz",
}


def load(spark: SparkSession, folder: str) -> Tables:
    def table(name: str) -> DataFrame:
        return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return Tables(
        actions=_actions(table("events")),
        products=_products(table("part")),
        shops=_shops(table("supplier"), table("lineitem"), table("part")),
        users=_users(table("customer"), table("nation"), table("orders")),
        comments=_comments(table("lineitem")),
    )


def _actions(events: DataFrame) -> DataFrame:
    code = F.lit(CART_CODE)
    for name, value in EVENT_CODES.items():
        code = F.when(F.col("event_type") == name, value).otherwise(code)
    return events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        F.col("ts").alias("action_time"),
        (F.col("event_id") % 7).alias("module_id"),
        code.cast("int").alias("type"),
    )


def _cate(part_type: str):
    return (F.ascii(part_type) * 100 + F.length(part_type)).cast("bigint")


def _products(part: DataFrame) -> DataFrame:
    shop = F.col("p_partkey") % 10 + F.floor(F.col("p_partkey") / 200) * 10
    return part.select(
        F.col("p_partkey").alias("sku_id"),
        F.expr("substr(p_brand, 7)").cast("bigint").alias("brand"),
        F.when(F.col("p_size") <= 45, shop).cast("bigint").alias("shop_id"),
        _cate("p_type").alias("cate"),
    )


def _shops(supplier: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    sold = lineitem.groupBy(F.col("l_suppkey").alias("shop_id")).agg(
        F.count(F.lit(1)).alias("fans_num"),
        F.count_distinct("l_orderkey").alias("vip_num"),
        F.min("l_shipdate").alias("shop_reg_tm"),
    )
    main = part.select(F.col("p_partkey").alias("shop_id"), _cate("p_type").alias("main_cate"))
    return (
        supplier.select(F.col("s_suppkey").alias("shop_id"), F.col("s_acctbal").alias("shop_score"))
        .join(sold, "shop_id", "left")
        .join(main, "shop_id", "left")
    )


def _users(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    first_order = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.min("o_orderdate").alias("user_reg_tm")
    )
    key = F.col("c_custkey")
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("user_id"),
        (key % 6 + 1).cast("int").alias("age"),
        F.when(key % 50 != 49, key % 3).cast("int").alias("sex"),
        F.floor(F.col("c_acctbal") / 2500).cast("int").alias("user_lv_cd"),
        (F.col("n_nationkey") % 4 + 1).cast("int").alias("city_level"),
        F.col("n_regionkey").alias("province"),
        F.col("n_nationkey").alias("city"),
        F.ascii("c_mktsegment").alias("county"),
    )
    return people.join(first_order, "user_id", "left")


def _comments(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.to_date("l_shipdate").alias("dt"),
        F.col("l_partkey").alias("sku_id"),
        F.lit(1).cast("bigint").alias("comments"),
        (flag == "N").cast("bigint").alias("good_comments"),
        (flag == "R").cast("bigint").alias("bad_comments"),
    )
