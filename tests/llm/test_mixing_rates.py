"""Repetition rates of tiny sources beside huge ones."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoplens.llm import mixing


def poisson_count(unit, mean):
    below, k = math.exp(-mean), 0  # exp(-mean) may be 0: the first terms weigh nothing
    while below < unit:
        k += 1
        below += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
    return k


def unit_of(doc_id, seed=17):
    return (int(hashlib.md5(f"{seed}|{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def test_a_tiny_source_beside_a_huge_one_is_repeated_by_its_rate(spark):
    huge = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', 1000)").alias("text"), F.lit("huge").alias("source"))
    tiny = spark.createDataFrame([(5000, "y", "tiny"), (5001, "z", None)], "doc_id bigint, text string, source string")
    copies = Counter(r["doc_id"] for r in mixing.mix(huge.unionByName(tiny)).where("doc_id >= 5000").select("doc_id").collect())
    rate = 4_000_002 / (2000 + 1 + 1)
    assert rate > 700 and copies == {i: poisson_count(unit_of(i), rate) for i in (5000, 5001)}


@pytest.mark.parametrize("mean", [650.0, 700.0, 700.5, 5000.0, 60_000.0])
def test_inverse_poisson_of_large_means(spark, mean):
    units = [1e-6, 0.02, 0.25, 0.5, 0.75, 0.98, 1 - 1e-6]
    frame = spark.createDataFrame([(u, mean) for u in units], "unit double, mean double").coalesce(1)
    got = [r[0] for r in frame.select(mixing.poisson_inverse(F.col("unit"), F.col("mean"))).collect()]
    deviation = math.sqrt(mean)
    assert got == sorted(got) and abs(got[3] - mean) < 1 and abs(got[1] - mean + 2.054 * deviation) < 3
    if mean < 744:
        assert got == [poisson_count(u, mean) for u in units]


def test_inverse_poisson_agrees_above_and_below_the_switch(spark, monkeypatch):
    units = [(i + 0.5) / 200 for i in range(200)]
    frame = spark.createDataFrame([(u, 690.0) for u in units], "unit double, mean double")
    from_zero = frame.select(mixing.poisson_inverse(F.col("unit"), F.col("mean"))).collect()
    monkeypatch.setattr(mixing, "NORMAL", 600.0)
    assert frame.select(mixing.poisson_inverse(F.col("unit"), F.col("mean"))).collect() == from_zero
