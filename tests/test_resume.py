"""Tables that a later run finds again, quarantined lines, waits for the next purchase, infinite scores."""

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.functions import quantile
from shoplens.operators import samples
from shoplens.resume import ResumableStore
from shoplens.session import HandOver
from shoplens.settings import PURCHASE
from shoplens.sources.tables import scan_with_quarantine

from tests.conftest import LAST


@pytest.fixture
def source(spark, tmp_path):
    spark.range(100).withColumn("x", F.col("id") % 7).write.parquet(f"{tmp_path}/in")
    return lambda: spark.read.parquet(f"{tmp_path}/in")


def test_a_killed_run_goes_on_with_its_finished_tables(spark, source, tmp_path):
    def steps(store, fail):
        first = store.put("first", source().groupBy("x").count())
        second = first.where("x > 2")
        return store.put("second", second.withColumn("y", F.raise_error("killed").cast("int") if fail else F.lit(1)))

    with pytest.raises(Exception, match="killed"), ResumableStore(spark, "r", 1, str(tmp_path)) as store:
        steps(store, fail=True)
    again = ResumableStore(spark, "r", 1, str(tmp_path))
    assert steps(again, fail=False).count() == 4 and again.reused == ["first"]
    last = ResumableStore(spark, "r", 1, str(tmp_path))
    assert sorted(map(tuple, steps(last, fail=False).collect())) == [(x, 14, 1) for x in range(3, 7)]
    assert last.reused == ["first", "second"]
    last.close()
    assert steps(ResumableStore(spark, "r", 1, str(tmp_path)), fail=False).count() == 4


def test_nothing_is_reused_after_a_change(spark, source, tmp_path):
    def reused(settings, df, name="t", partition_by=()):
        store = ResumableStore(spark, "r", settings, str(tmp_path))
        store.put(name, df, partition_by)
        return store.reused

    plain = source().where("x = 3")
    assert reused(1, plain) == [] and reused(1, source().where("x = 3")) == ["t"]
    assert reused(2, plain) == []
    assert reused(1, source().where("x = 4")) == []
    assert reused(1, plain, partition_by=("x",)) == []
    # A condition far behind in a wide plan counts too.
    wide = [(F.col("x") + i).alias(f"c{i}") for i in range(60)]
    assert reused(1, source().select(*wide)) == []
    assert reused(1, source().select(*wide[:-1], (F.col("x") + 1000).alias("c59"))) == []
    spark.range(5).withColumn("x", F.lit(3)).write.mode("append").parquet(f"{tmp_path}/in")
    assert reused(1, source().where("x = 3")) == []


def test_half_written_entries_do_not_count(spark, source, tmp_path):
    store = ResumableStore(spark, "r", 1, str(tmp_path))
    mark = store.fingerprint("t", source())
    (tmp_path / "run-r" / "manifest").mkdir(parents=True)
    (tmp_path / "run-r" / "manifest" / f"t-{mark}.json").write_text('{"path": "/no')
    assert store.put("t", source()).count() == 100 and store.reused == []
    later = ResumableStore(spark, "r", 1, str(tmp_path))
    assert later.put("t", source()).count() == 100 and later.reused == ["t"]


def test_broken_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "product"
    folder.mkdir()
    (folder / "a.csv").write_text('sku_id,brand,shop_id,cate\n1,2,3,4\n5,6,7\n8,9,10,11,12\n13,"14,15,16\n')
    (folder / "b.csv").write_text("sku_id,brand,shop_id,cate\n17,,x,20.0\n21\n")
    with HandOver(spark) as store:
        rows, broken = scan_with_quarantine(spark, str(folder), "product", store)
        assert sorted(map(tuple, rows.collect())) == [(1, 2, 3, 4), (17, None, None, 20)]
        found = {(r["file_name"], r["line"]) for r in broken.collect()}
        assert found == {("a.csv", "5,6,7"), ("a.csv", "8,9,10,11,12"), ("a.csv", '13,"14,15,16'), ("b.csv", "21")}
        assert {r["block_start"] for r in broken.collect()} == {0}


def test_foreign_columns_are_counted_too(spark, tmp_path):
    (tmp_path / "p.csv").write_text("cate,extra,sku_id,brand,shop_id\n1,z,2,3,4\n1,z,2,3\n")
    with HandOver(spark) as store:
        order = ["cate", "extra", "sku_id", "brand", "shop_id"]
        rows, broken = scan_with_quarantine(spark, str(tmp_path / "p.csv"), "product", store, order)
        assert [r.asDict() for r in rows.collect()] == [{"sku_id": 2, "brand": 3, "shop_id": 4, "cate": 1}]
        assert [r["line"] for r in broken.collect()] == ["1,z,2,3"]


def test_next_purchase_equals_brute_force(spark, make_log, calendar):
    rng = np.random.default_rng(4)
    rows = [(int(u), int(c), 1, 1, int(t), int(ago)) for u, c, t, ago in zip(
        rng.integers(0, 6, 400), rng.integers(0, 3, 400), rng.choice([1, PURCHASE], 400, p=[0.8, 0.2]), rng.integers(-20, 9, 400), strict=True)]
    log = make_log(rows)
    sample = samples.samples(log, calendar)
    got = {(r["user_id"], r["cate"], r["anchor_date"]): r["wait"] for r in samples.next_purchase(sample, log).collect()}
    bought = {(u, c, LAST - timedelta(days=ago)) for u, c, _, _, t, ago in rows if t == PURCHASE}
    asked = {(u, c, LAST - timedelta(days=ago)) for u, c, _, _, _, ago in rows if LAST - timedelta(days=ago) in calendar.anchors}
    want = {(u, c, d): min([(p - d).days for v, e, p in bought if (v, e) == (u, c) and p > d], default=None) for u, c, d in asked}
    assert got == want
    same = samples.label_horizons(sample, log, calendar, (1, 3, 7)).collect()
    assert sorted(map(tuple, samples.label_next_purchase(sample, log, (1, 3, 7)).collect())) == sorted(map(tuple, same))


def test_waits_shuffle_rows_once_whatever_the_horizon(spark, make_log, calendar):
    log = make_log([(u, 1, 1, 1, PURCHASE, ago) for u in range(50) for ago in range(-3, 8)])
    plans = []
    for horizon in (1, 90):
        flagged = samples.label_next_purchase(samples.samples(log, calendar), log, (horizon,))
        plans.append(flagged._jdf.queryExecution().optimizedPlan().toString())
        assert "Generate" not in plans[-1] and "Join" not in plans[-1]
    # A purchase on day 0 of a key without sample, and a sample without purchase.
    only = make_log([(1, 1, 1, 1, 1, 0), (2, 1, 1, 1, PURCHASE, -1)])
    assert [r["wait"] for r in samples.next_purchase(samples.samples(only, calendar), only).collect()] == [None]


INF = float("inf")


@pytest.mark.parametrize(("values", "fraction", "answer"), [
    ([-INF, 1.0, 2.0], 0.0, -INF), ([-INF, 1.0, 2.0], 0.25, -INF), ([-INF, 1.0, 2.0], 0.5, 1.0),
    ([1.0, 2.0, INF], 0.75, INF), ([1.0, 2.0, INF], 1.0, INF), ([INF, INF], 0.5, INF), ([-INF, -INF, 3.0], 0.5, -INF),
    ([-1.7e308, 1.7e308], 0.5, 0.0), ([-1.7e308, 1.7e308], 0.25, -0.85e308), ([float("nan"), 4.0], 1.0, 4.0),
])
def test_percentiles_with_infinite_and_overflowing_values(spark, values, fraction, answer):
    got = quantile.exact_percentile(spark.createDataFrame([(v,) for v in values], "s double"), "s", fraction)
    assert got == pytest.approx(answer, rel=1e-12)


def test_between_both_infinities_is_nan(spark):
    got = quantile.exact_percentile(spark.createDataFrame([(-INF,), (INF,)], "s double"), "s", 0.5)
    assert got != got


def test_infinities_do_not_send_values_to_the_driver(spark, monkeypatch):
    n = 200_000
    scored = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, INF).when(F.col("id") % 10 == 1, -INF).otherwise(F.exp(F.col("id") / 400)).alias("s"))
    fetched, count_out, narrowed, passes = [], quantile._count_out, quantile._narrowed, []

    def counted(rows, brackets):
        found = count_out(rows, brackets)
        fetched.extend(map(len, found.values()))
        return found

    monkeypatch.setattr(quantile, "_count_out", counted)
    monkeypatch.setattr(quantile, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    values = np.array([INF if i % 10 == 0 else -INF if i % 10 == 1 else np.exp(i / 400) for i in range(n)])
    got = quantile.exact_percentile(scored, "s", 0.77)
    assert got == pytest.approx(np.sort(values)[int(0.77 * (n - 1)):][:2].mean(), rel=1e-2)
    low, high = np.sort(values)[int(0.77 * (n - 1)):][:2]
    assert low <= got <= high and len(passes) == 1 and sum(fetched) <= quantile.FEW
