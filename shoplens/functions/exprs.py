"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How key and value columns are written in feature names.
KEY_NAMES = {"user_id": "user", "shop_id": "shop", "sku_id": "sku"}
VALUE_NAMES = {
    "cate": "cates",
    "shop_id": "shops",
    "sku_id": "skus",
    "brand": "brands",
    "module_id": "modules",
}


def short_name(keys: Iterable[str]) -> str:
    """``['user_id', 'cate']`` -> ``user_cate``."""
    return "_".join(KEY_NAMES.get(k, k) for k in keys)


def sum_where(condition: Column, value: str | Column = "n") -> Column:
    """Sum of ``value`` over matching rows, 0 where no row matches."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, value).otherwise(0))


def total(value: str) -> Column:
    """Sum that is 0, not NULL, for a group of NULLs."""
    return F.coalesce(F.sum(value), F.lit(0))


def known_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose grouping keys are all present; NULL keys form no group."""
    return df.dropna(subset=keys)


def days_before(as_of, column: str) -> Column:
    """Whole days from ``column`` to the fixed day ``as_of``; NULL in, NULL out."""
    return F.datediff(F.lit(as_of), F.to_date(column))


def equal_flag(left: str, right: str) -> Column:
    """1 if both are present and equal, else 0."""
    return F.coalesce((F.col(left) == F.col(right)).cast("int"), F.lit(0))


def smoothed(hits: Column, base: Column, prior: int, mean: Column) -> Column:
    """Rate pulled towards ``mean`` with the weight of ``prior`` extra observations."""
    return (hits + F.lit(float(prior)) * mean) / (base + F.lit(float(prior)))

