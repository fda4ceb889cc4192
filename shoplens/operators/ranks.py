"""Percentile ranks of trailing browse counts among the samples of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.trailing import count_name
from shoplens.settings import BROWSE, Calendar

# Name, ranked key set and group of each rank family, in result order.
RANKS = [
    ("user_like_cate", ["user_id", "cate"], "user_id"),
    ("ruser_like_cate", ["user_id", "cate"], "cate"),
    ("user_like_shop", ["user_id", "shop_id"], "user_id"),
    ("ruser_like_shop", ["user_id", "shop_id"], "shop_id"),
    ("sex_like_cate", ["sex", "cate"], "sex"),
    ("sex_like_shop", ["sex", "shop_id"], "sex"),
    ("age_like_cate", ["age", "cate"], "age"),
    ("age_like_shop", ["age", "shop_id"], "age"),
]


def rank_name(family: str, days: int) -> str:
    return f"{family}{days}_rank"


def rank_columns(family: str, keys: list[str], calendar: Calendar) -> dict[str, str]:
    """Ranked count column -> name of its rank."""
    return {count_name(keys, BROWSE, n): rank_name(family, n) for n in calendar.windows}


def sample_counts(sample: DataFrame, keys: list[str]) -> DataFrame:
    """Number of samples per (keys, anchor): the weight of one ranked entity."""
    return sample.groupBy(*keys, "anchor_date").agg(F.count(F.lit(1)).alias("weight"))


def percentile_ranks(entities: DataFrame, keys: list[str], group: str, columns: dict[str, str]) -> DataFrame:
    """Share of a group's samples whose value is at least as large, per (keys, anchor).

    Equals the descending percentile rank with ties at their maximum, taken over samples, where an
    entity of ``weight`` w stands for w samples. The rank depends on the value alone, so groups are
    reduced to a histogram of values first; a running sum over it replaces sorting the samples, and
    a group with a third of all samples costs no more than its number of distinct values.
    """
    ids = list(dict.fromkeys([*keys, group, "anchor_date"]))
    cells = F.array(
        *[F.struct(F.lit(out).alias("rank"), F.col(c).alias("value")) for c, out in columns.items()]
    )
    tall = entities.select(*ids, "weight", F.inline(cells))
    histogram = tall.groupBy(group, "anchor_date", "rank", "value").agg(F.sum("weight").alias("samples"))
    part = Window.partitionBy(group, "anchor_date", "rank")
    upto = part.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = histogram.select(
        group, "anchor_date", "rank", "value",
        (F.sum("samples").over(upto) / F.sum("samples").over(part)).alias("share"),
    )
    return (
        tall.join(shares, [group, "anchor_date", "rank", "value"])
        .groupBy(*ids)
        .agg(*[F.max(F.when(F.col("rank") == out, F.col("share"))).alias(out) for out in columns.values()])
    )


def rank_family(sample: DataFrame, counts: DataFrame, calendar: Calendar, family: str) -> DataFrame:
    """One rank family per (keys, anchor) from the samples and the trailing counts of its key set."""
    _, keys, group = next(r for r in RANKS if r[0] == family)
    columns = rank_columns(family, keys, calendar)
    entities = (
        sample_counts(sample, keys)
        .join(counts.select(*keys, "anchor_date", *columns), [*keys, "anchor_date"], "left")
        .na.fill(0, list(columns))
    )
    return percentile_ranks(entities, keys, group, columns)
