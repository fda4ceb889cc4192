"""Static shop and user profile of a sample."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import days_before, equal_flag
from shoplens.settings import REGISTRATION_AS_OF

SHOP_COLUMNS = ["fans_num", "vip_num", "main_cate", "shop_score", "shop_reg_year", "shop_reg_days"]
USER_COLUMNS = [
    "age", "sex", "user_lv_cd", "city_level", "province", "city", "county", "user_reg_year", "user_reg_days",
]


def shop_profile(shops: DataFrame, as_of: date = REGISTRATION_AS_OF) -> DataFrame:
    """Registered shops with their registration year and age; shops without a date are left out."""
    return shops.where(F.col("shop_reg_tm").isNotNull()).select(
        "shop_id",
        "fans_num",
        "vip_num",
        "main_cate",
        "shop_score",
        F.year("shop_reg_tm").alias("shop_reg_year"),
        days_before(as_of, "shop_reg_tm").alias("shop_reg_days"),
    )


def user_profile(users: DataFrame, as_of: date = REGISTRATION_AS_OF) -> DataFrame:
    return users.select(
        "user_id",
        "age", "sex", "user_lv_cd", "city_level", "province", "city", "county",
        F.year("user_reg_tm").alias("user_reg_year"),
        days_before(as_of, "user_reg_tm").alias("user_reg_days"),
    )


def static_profile(
    sample: DataFrame, shops: DataFrame, users: DataFrame, as_of: date = REGISTRATION_AS_OF
) -> DataFrame:
    """Attach both profiles; samples of shops without a registration date are dropped.

    The dropping is an inner join with the registered shops: a left join followed by a not-null
    filter on the joined column means the same.
    """
    return (
        sample.join(shop_profile(shops, as_of), "shop_id")
        .join(user_profile(users, as_of), "user_id", "left")
        .withColumn("same_with_main_cate", equal_flag("main_cate", "cate"))
    )
