"""A user with half of the log must not end up in one task."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shoplens.operators import enrich
from shoplens.plans import matrix
from shoplens.sources.tables import SCHEMAS, Tables

SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_LIMITS}
    for key, value in SMALL_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_user_is_split_in_the_enrichment_join(spark, small_limits):
    row = F.col("id")
    actions = spark.range(200_000, numPartitions=8).select(
        F.when(row % 2 == 0, 7).otherwise(row % 1000).cast("bigint").alias("user_id"),
        F.xxhash64("id").alias("sku_id"),
        F.lit(datetime(2024, 1, 30)).alias("action_time"), F.lit(1).cast("bigint").alias("module_id"),
        F.lit(1).alias("type"),
    )
    products = actions.select("sku_id", F.lit(1).cast("bigint").alias("brand"), F.lit(1).cast("bigint").alias("shop_id"),
                              F.lit(1).cast("bigint").alias("cate"))
    shops = spark.createDataFrame([(1,)], "shop_id bigint")
    users = spark.createDataFrame([(u, 1, 1, None, 1, 1, 1, 1, 1) for u in range(1000)], SCHEMAS["user"])
    log = enrich.daily_log(Tables(actions, products, shops, users, None))
    per_user = log.groupBy("user_id", "cate").agg(F.sum("n").alias("n"))
    counts = {r["user_id"]: r["n"] for r in per_user.collect()}
    assert counts[7] == 100_000 + 200 and sum(counts.values()) == 200_000
    assert "skew=true" in per_user._jdf.queryExecution().executedPlan().toString()


def test_hot_user_is_split_in_the_matrix_joins(spark, small_limits):
    row = F.col("id")
    sample = spark.range(200_000, numPartitions=8).select(
        F.when(row % 2 == 0, 7).otherwise(row % 1000).cast("bigint").alias("user_id"), F.xxhash64("id").alias("shop_id"),
    )
    features = spark.range(1000).select(F.col("id").alias("user_id"), *[(row + i).alias(f"f{i}") for i in range(20)])
    packed, places = matrix._packed(features, ["user_id"], "by_user_id")
    total = sample.join(packed, ["user_id"], "left").selectExpr("shop_id", f"{places['f3']} as f").agg(F.sum("f"), F.max("shop_id"))
    hot, others = 100_000, sum(i % 1000 for i in range(1, 200_000, 2))
    assert total.collect()[0][0] == hot * 7 + others + 3 * 200_000
    assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
