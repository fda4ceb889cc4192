"""What reaches the driver: broadcasts by their size in memory, and edges of bins instead of values."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators import boosting
from shoplens.plans import matrix
from shoplens.session import HandOver, broadcast_bytes, release_garbage, tune


def joined_by(df: DataFrame) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_that_is_small_only_in_its_file_is_not_broadcast(spark):
    with HandOver(spark) as store:
        wide = store.put("wide", spark.range(300_000).select("id", *[F.lit(i).cast("long").alias(f"c{i}") for i in range(30)]))
        plan = joined_by(spark.range(10).join(wide, "id", "left"))
    assert "BroadcastHashJoin" not in plan


def test_last_joins_go_by_rows_and_cells(spark):
    table = spark.range(5).select("id", F.array(F.lit(1.0)).alias("values"))
    most = broadcast_bytes(spark) // 8
    left = spark.range(10)
    assert "BroadcastHashJoin" in joined_by(left.join(matrix._hinted(table, 5, 2), "id", "left"))
    assert "BroadcastHashJoin" not in joined_by(left.join(matrix._hinted(table, most // 10, 3), "id", "left"))


def test_row_counts_of_written_tables(spark):
    with HandOver(spark) as store:
        tables = {"five": store.put("five", spark.range(5)), "none": store.put("none", spark.range(0).select(F.col("id").alias("other")))}
        assert matrix._row_counts(tables) == {"five": 5, "none": 0}


@pytest.mark.parametrize("given", ["1g", "256k", "-1"])
def test_limit_of_broadcasts_fits_the_heap(spark, given):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", given)
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert broadcast_bytes(tune(session)) == {"1g": heap // 256, "256k": 256 << 10, "-1": -1}[given]


@pytest.mark.parametrize(("free", "times"), [(60, 0), (20, 1)])
def test_garbage_is_released_when_half_of_the_heap_is_used(free, times):
    calls = []
    runtime = SimpleNamespace(totalMemory=lambda: 90, freeMemory=lambda: free, maxMemory=lambda: 100)
    lang = SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: runtime), System=SimpleNamespace(gc=lambda: calls.append(1)))
    release_garbage(SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(lang=lang))))
    assert len(calls) == times


def test_edges_are_found_on_executors(spark, monkeypatch):
    names = [f"f{i}" for i in range(20)]
    cells = [F.when(F.col("id") % 11 != 0, (F.col("id") * (i + 3)) % (10 if i % 2 else 4001)).cast("double").alias(n) for i, n in enumerate(names)]
    sample = spark.range(4000).select("id", (F.col("id") % 2).alias("flag"), *cells)
    values = np.array([[x or 0.0 for x in r] for r in sample.select(*names).collect()])
    sent, plain = [], type(sample).toArrow
    monkeypatch.setattr(type(sample), "toArrow", lambda self: sent.append(plain(self)) or sent[-1])
    edges = boosting.bin_edges(sample, names)
    for i, own in enumerate(edges):
        distinct = np.unique(values[:, i])
        inner = np.quantile(values[:, i], np.arange(1, 255) / 255, method="inverted_cdf")
        expected = (distinct[1:] + distinct[:-1]) / 2 if len(distinct) <= 255 else np.unique(inner[inner < distinct[-1]])
        assert np.array_equal(own, expected)
    assert sum(t.nbytes for t in sent) < values.nbytes / 4
