"""Mixing sources to target weights by Poisson replication.

A document's number of copies is the inverse of the Poisson distribution at a uniform number hashed
from its id and a seed; the mean is the target repetition rate of its source. Copies are spread by
a global sort on a hash of (id, copy, seed). No state is kept, so any task can be repeated.

Defined results: a null source is a source of its own; a null or empty text has size 0 but is
replicated like the others; rows repeated with one ``doc_id`` get the same number of copies each; a
source without size (empty texts only) has rate 0; an empty table gives no rows; columns named like
the added ones (``copy``, ``shuffle_key``) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import written

# 13 hexadecimal digits fit a double exactly.
UNIT = float(1 << 52)
# Largest mean whose terms are summed from zero copies on.
NORMAL = 700.0


def hashed_unit(*parts: Column) -> Column:
    """Uniform number in (0, 1) from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(UNIT)


def poisson_inverse(unit: Column, mean: Column) -> Column:
    """Smallest k with P(X <= k) >= unit for X ~ Poisson(mean).

    The scan ends at mean + 14 sqrt(mean) + 40, beyond which less than 2**-53 of the mass lies, so no
    value of ``hashed_unit`` is cut. Up to a mean of ``NORMAL`` exp(-mean) is a normal number and the scan
    starts at 0. Above, it starts 14 sqrt(mean) below the mean, with less than 2**-53 of the mass before
    it; that term is taken from Stirling's series, in a form that does not subtract large numbers.
    """
    large = mean > NORMAL
    first = F.when(large, F.floor(mean - 14 * F.sqrt(mean))).otherwise(0).cast("int")
    last = F.ceil(mean + 14 * F.sqrt(mean) + 40).cast("int")
    k, off = first.cast("double"), (first - mean) / mean
    series = 1 / (12 * k) - 1 / (360 * k * k * k)
    log_term = -mean * ((1 + off) * F.log1p(off) - off) - F.log(2 * math.pi * k) / 2 - series
    term = F.when(large, F.exp(log_term)).otherwise(F.exp(-mean))
    start = F.struct(term.alias("p"), term.alias("below"), first.alias("k"))
    step = lambda a, i: F.struct(
        (a["p"] * mean / i).alias("p"),
        (a["below"] + a["p"] * mean / i).alias("below"),
        F.when(a["below"] < unit, i).otherwise(a["k"]).alias("k"),
    )
    return F.aggregate(F.sequence(first + 1, last), start, step, lambda a: a["k"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, rate): mean copies per document so that sources reach their share of the text.

    ``weights`` gives target shares by source (others get none). Without them shares are the sources'
    sizes to the power ``temperature``, normalised. ``epochs`` scales the whole output.
    """
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    sizes = docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(temperature))
    else:
        listed = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        share = F.coalesce(F.element_at(F.create_map(*listed), F.col("source")), F.lit(0.0)) if listed else F.lit(0.0)
    sized = sizes.withColumn("share", share)
    all_size, all_share = sized.agg(F.sum("size")).scalar(), sized.agg(F.sum("share")).scalar()
    rate = F.lit(float(epochs)) * all_size * F.col("share") / all_share / F.col("size")
    return sized.select(
        "source", F.when((F.col("size") > 0) & (F.col("share") > 0), rate).otherwise(0.0).alias("rate")
    )


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 17) -> DataFrame:
    """Every document as often as its Poisson count says, in a global random order.

    Adds ``copy`` (from 1) and ``shuffle_key``, the sort key of the global order.
    """
    own = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    # The row number only separates rows that are equal in the sort key, so that many of them can be split.
    numbered = docs.select(*own, F.monotonically_increasing_id().alias("_row"))
    joined = numbered.alias("d").join(rates.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
    count = poisson_inverse(hashed_unit(F.lit(seed), F.col("d.doc_id")), F.col("r.rate"))
    copies = joined.withColumn("_n", count).where("_n > 0")
    spread = copies.select(*[F.col(f"d.{c}") for c in [*own, "_row"]], F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.col("doc_id").cast("string"), F.col("copy").cast("string")).cast("binary"))
    return spread.withColumn("shuffle_key", key).orderBy("shuffle_key", "_row").drop("_row")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: int = 17) -> DataFrame:
    # Written, so that the join knows the table's exact size and does not shuffle the texts for it.
    return replicate(docs, written(source_rates(docs, weights, temperature, epochs), "rates"), seed)
