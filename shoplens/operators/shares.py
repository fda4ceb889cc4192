"""Favourites and shares: which item leads within a key, and how much of the key it makes up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys
from shoplens.settings import BROWSE


def _pair_counts(log: DataFrame, owner: str, item: str, kind: int | None) -> DataFrame:
    rows = log if kind is None else log.where(F.col("type") == kind)
    return known_keys(rows, [owner, item]).groupBy(owner, item).agg(F.sum("n").alias("actions"))


def favourite(log: DataFrame, owner: str, item: str, kind: int | None = BROWSE) -> DataFrame:
    """Item with most actions per owner; the smaller id wins a tie.

    A mergeable maximum instead of a sorted window: no owner is gathered in one task.
    """
    best = F.max(F.struct(F.col("actions"), (-F.col(item)).alias("negative")))
    return (
        _pair_counts(log, owner, item, kind)
        .groupBy(owner)
        .agg(best.alias("best"))
        .select(owner, (-F.col("best.negative")).alias(f"top_{item}"), F.col("best.actions").alias("actions"))
    )


def item_share(log: DataFrame, owner: str, item: str, kind: int | None = BROWSE) -> DataFrame:
    """Each item's part of its owner's actions.

    Totals are joined back rather than taken by a window: an owner of very many items can then be
    split over tasks.
    """
    counts = _pair_counts(log, owner, item, kind)
    totals = counts.groupBy(owner).agg(F.sum("actions").alias("total"))
    return counts.join(totals, owner).select(
        owner, item, "actions", (F.col("actions") / F.col("total")).alias("share")
    )
