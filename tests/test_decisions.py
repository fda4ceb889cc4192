"""Ranks, percentiles, segments, selections, evaluation, sequences and the model."""

import os
import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoplens.functions import quantile
from shoplens.operators import (
    enrich, evaluate, explore, intervals, model, ranks, segments, selection, sequences, shares,
)
from shoplens.plans import run
from shoplens.session import HandOver
from shoplens.sources.tables import SCHEMAS, Tables, read_csv, read_result, unparsed_cells
from tests.conftest import LAST


def test_rank_ties_take_the_highest_share(spark):
    entities = spark.createDataFrame(
        [(1, c, LAST, 1, v) for c, v in enumerate([3, 3, 1, 0])],
        "user_id bigint, cate bigint, anchor_date date, weight bigint, value bigint",
    )
    result = ranks.percentile_ranks(entities, ["user_id", "cate"], "user_id", {"value": "r"})
    assert [r["r"] for r in result.orderBy("cate").collect()] == [0.5, 0.5, 0.75, 1.0]


def test_ranks_equal_pandas_over_weighted_samples_with_a_hot_group(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        group = 0 if rng.random() < 0.4 else rng.randrange(1, 5)
        rows.append((group, i, LAST, rng.randrange(1, 4), rng.randrange(6)))
    entities = spark.createDataFrame(
        rows, "cate bigint, user_id bigint, anchor_date date, weight bigint, value bigint"
    )
    got = {
        (r["cate"], r["user_id"]): r["r"]
        for r in ranks.percentile_ranks(entities, ["user_id", "cate"], "cate", {"value": "r"}).collect()
    }
    flat = pd.DataFrame([(g, u, v) for g, u, _, w, v in rows for _ in range(w)], columns=["g", "u", "v"])
    flat["r"] = flat.groupby("g")["v"].rank(ascending=False, method="max", pct=True)
    for g, u, r in flat.drop_duplicates(["g", "u"])[["g", "u", "r"]].itertuples(index=False):
        assert got[(g, u)] == r


@pytest.mark.parametrize("shape", ["distinct", "ties", "few", "two atoms", "one atom", "wide"])
def test_percentiles_are_exact(spark, shape, monkeypatch):
    rng = np.random.default_rng(5)
    values = {
        "distinct": rng.normal(size=3000),
        "ties": np.where(rng.random(3000) < 0.4, 1.0, rng.integers(0, 50, 3000)).astype(float),
        "few": rng.normal(size=7),
        "two atoms": np.repeat([0.0, 1.0], 1500),
        "one atom": np.full(3000, 0.25),
        "wide": rng.normal(size=3000) * 10.0 ** rng.integers(-200, 200, 3000),
    }[shape]
    df = spark.createDataFrame([(float(v), g) for v in values for g in (1, 2)], "s double, g int").repartition(7)
    for few in (4096, 5):  # with 5 every answer takes several passes
        monkeypatch.setattr(quantile, "FEW", few)
        for pair in ((0.0, 0.5), (0.92, 0.98), (0.999, 1.0)):
            got = quantile.exact_percentiles(df, "s", dict(zip((1, 2), pair, strict=True)), "g")
            for g, fraction in zip((1, 2), pair, strict=True):
                assert got[g] == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12, abs=1e-12)
    assert quantile.exact_percentiles(df, "s", {9: 0.5}, "g") == {9: None}


def test_no_score_is_shuffled_outside_its_bracket(spark, monkeypatch):
    scored = spark.range(50_000).select((F.col("id") % 49_999).cast("double").alias("score"), F.lit(1).alias("user_id"))
    grouped, inside = [], quantile._inside

    def counted(rows, brackets):
        grouped.append(inside(rows, brackets).count())
        return inside(rows, brackets)

    monkeypatch.setattr(quantile, "_inside", counted)
    chosen = selection.top_fraction(scored, 98)
    assert chosen.count() == 1000
    # One pass counts all rows into steps, the last one fetches the values of a short bracket.
    assert grouped[0] == 50_000 and grouped[-1] <= quantile.FEW and len(grouped) == 2
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_equal_scores_select_nothing(spark):
    scored = spark.range(50).select("id", F.lit(0.5).alias("score"))
    assert selection.top_fraction(scored, 92).count() == 0


def test_select_days_merges_and_consensus_intersects(spark):
    days = (LAST, LAST - timedelta(days=1))
    rows = [(u, 1, 1, d, float(u)) for d in days for u in range(100)]
    scored = spark.createDataFrame(
        rows, "user_id bigint, cate bigint, shop_id bigint, anchor_date date, score double"
    )
    chosen = selection.select_days(scored, days, (92, 98))
    assert sorted(r["user_id"] for r in chosen.collect()) == list(range(92, 100))
    part = chosen.where("user_id >= 95")
    other = chosen.where("user_id = 93")
    assert sorted(r["user_id"] for r in selection.consensus(chosen, part, other).collect()) == [93, 95, 96, 97, 98, 99]


def test_segments_are_disjoint_and_complete(make_log):
    log = make_log(
        [(1, 1, 1, 1, 2, 0), (1, 1, 1, 1, 2, 1), (2, 1, 1, 1, 5, 9), (2, 1, 1, 1, 2, 0), (3, 1, 1, 1, 1, 0)]
    )
    whole = {r["user_id"]: r["user_class"] for r in segments.user_classes(log).collect()}
    assert whole == {1: 1, 2: 2, 3: 3}
    span = {r["user_id"]: r["user_class"] for r in segments.user_classes(log, cart_span=(LAST, LAST)).collect()}
    assert span == {1: 1, 2: 3, 3: 3}
    rule = segments.repeat_buyers(log, segments.user_classes(log), LAST)
    assert [(r["user_id"], r["purchases"]) for r in rule.collect()] == [(1, 2)]
    sample = log.select("user_id").distinct()
    assert [r["user_id"] for r in segments.in_segment(sample, segments.user_classes(log), 2).collect()] == [2]


def test_time_split(spark, calendar):
    sample = spark.createDataFrame([(a,) for a in calendar.anchors], "anchor_date date")
    parts = {r["anchor_date"]: r["part"] for r in segments.time_split(sample, calendar).collect()}
    assert Counter(parts.values()) == {"train": 5, "hold_out": 1, "score_before": 1, "score_last": 1}
    assert segments.training_part(sample, calendar).count() == 5


def test_evaluation(spark):
    schema = "user_id bigint, cate bigint, shop_id bigint"
    predicted = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (2, 1, 1), (3, 1, 1)], schema)
    truth = spark.createDataFrame([(1, 1, 1), (2, 1, 9)], schema)
    row = evaluate.evaluate_selection(predicted, truth).collect()[0]
    assert (row["pair_predicted"], row["pair_actual"], row["pair_hits"]) == (3, 2, 2)
    assert (row["triple_predicted"], row["triple_actual"], row["triple_hits"]) == (4, 2, 1)
    pair = 2 * (2 / 3) * 1 / (2 / 3 + 1)
    triple = 2 * 0.25 * 0.5 / 0.75
    assert row["score"] == pytest.approx(0.4 * pair + 0.6 * triple)
    empty = evaluate.evaluate_selection(predicted.limit(0), truth).collect()[0]
    assert empty["score"] == 0


@pytest.mark.parametrize("span", [200_000, 1])
def test_sequences_keep_every_step_in_order(spark, span):
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = [
        (0 if rng.random() < 0.5 else rng.randrange(4), start + timedelta(seconds=rng.randrange(span)),
         rng.randrange(9), rng.randrange(1, 6))
        for _ in range(500)
    ]
    actions = spark.createDataFrame(rows, "user_id bigint, action_time timestamp, sku_id bigint, type int")
    pieces = sequences.user_sequences(actions.repartition(5), length=7).orderBy("user_id", "piece").collect()
    assert max(p["n_steps"] for p in pieces) == 7
    joined = {}
    for p in pieces:
        joined.setdefault(p["user_id"], []).extend((s["action_time"], s["sku_id"], s["type"]) for s in p["steps"])
    for user, steps in joined.items():
        assert steps == sorted((t, k, y) for u, t, k, y in rows if u == user)


def test_gaps(make_log):
    log = make_log([(1, 1, 1, k, 1, ago) for k, ago in ((1, 0), (2, 0), (1, 3), (1, 10))])
    row = intervals.gap_features(log, ["user_id"], LAST).collect()[0]
    assert (row["active_days"], row["recency"], row["gap_min"]) == (3, 0, 3)
    assert row["gap_mean"] == 5.0 and row["gap_var"] == 8.0


def test_favourite_breaks_ties_by_smaller_id(make_log):
    log = make_log([(1, 1, 7, 1, 1, 0), (1, 1, 4, 1, 1, 0), (2, 1, 9, 1, 1, 0), (2, 1, 9, 1, 1, 1), (2, 1, 3, 1, 1, 0)])
    top = {r["user_id"]: r["top_shop_id"] for r in shares.favourite(log, "user_id", "shop_id").collect()}
    assert top == {1: 4, 2: 9}
    total = shares.item_share(log, "user_id", "shop_id").groupBy("user_id").agg(F.sum("share").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in total)


def test_missing_days_are_flagged(make_log):
    log = make_log([(1, 1, 1, 1, 1, d) for d in (0, 1, 3)] + [(1, 1, 1, 1, 5, 1)])
    days = {(r["type"], r["action_date"]): r for r in explore.abnormal_days(log).collect()}
    assert len(days) == 8
    assert days[(1, LAST - timedelta(days=2))]["missing"] == 1
    assert days[(5, LAST)]["abnormal"] == 1 and days[(5, LAST - timedelta(days=1))]["missing"] == 0


def test_purchase_lag(make_log):
    log = make_log([(1, 1, 1, 1, 1, 5), (1, 1, 1, 1, 2, 3), (2, 1, 1, 1, 2, 3)])
    lag = {(r["activity_day"], r["lag"]): r["purchases"] for r in explore.purchase_lag(log).collect()}
    assert lag == {(LAST - timedelta(days=5), 2): 1}


def test_dirty_rows_and_enrichment(spark):
    actions = spark.createDataFrame(
        [(1, 1, datetime(2024, 1, 30, 5), 1, 1), (1, 1, datetime(2024, 1, 30, 6), 1, 1),
         (1, 2, datetime(2024, 1, 30), 1, 1), (1, 9, datetime(2024, 1, 30), 1, 1), (8, 1, datetime(2024, 1, 30), 1, 1)],
        "user_id bigint, sku_id bigint, action_time timestamp, module_id bigint, type int",
    )
    products = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 77, 1)], SCHEMAS["product"])
    shops = spark.createDataFrame([(1,)], "shop_id bigint")
    users = spark.createDataFrame([(1, 1, 1, None, 1, 1, 1, 1, 1)], SCHEMAS["user"])
    tables = Tables(actions, products, shops, users, None)
    status = {r["status"]: r["actions"] for r in enrich.dirty_rows(tables).collect()}
    assert status == {"matched": 2, "no shop": 1, "no product": 1, "no user": 1}
    assert enrich.enriched_actions(tables).count() == 2
    daily = enrich.daily_log(tables).collect()
    assert len(daily) == 1 and daily[0]["n"] == 2 and daily[0]["action_date"] == LAST


def test_csv_scan_tolerates_floats_and_blanks(spark, tmp_path):
    path = tmp_path / "user.csv"
    path.write_text(
        "user_id,sex,age,user_reg_tm,user_lv_cd,city_level,province,city,county\n"
        "1,0.0,5,2016-08-22 00:00:00,7,4.0,,3,x\n"
    )
    header = ["user_id", "sex", "age", "user_reg_tm", "user_lv_cd", "city_level", "province", "city", "county"]
    row = read_csv(spark, str(path), "user", header).collect()[0]
    assert (row["user_id"], row["age"], row["sex"], row["city_level"]) == (1, 5, 0, 4)
    assert row["province"] is None and row["county"] is None
    assert row["user_reg_tm"] == datetime(2016, 8, 22)


def test_lists_are_written_with_header(spark, tmp_path):
    chosen = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "user_id bigint, cate bigint, shop_id bigint")
    run.write_lists({"result": chosen}, str(tmp_path))
    back = read_result(spark, f"{tmp_path}/result", chosen.schema, "csv")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2, 3), (4, 5, 6)]


def test_boosters_learn_and_blend(spark, calendar):
    rng = random.Random(2)
    rows = [(float(a), float(b), int(a + b > 1)) for a, b in ((rng.random(), rng.random()) for _ in range(300))]
    sample = spark.createDataFrame(rows, "a double, b double, flag int")
    boosters = model.train_boosters(
        sample, ["a", "b"], rounds=(2, 3, 4), maxDepth=3, stepSize=0.3, featureSubsetStrategy="all"
    )
    scored = model.blended_score(boosters, sample)
    low, high = scored.agg(F.min("score"), F.max("score")).collect()[0]
    assert 0 <= low < high <= 2 + 1 / 3
    assert model.area_under_curve(scored) > 0.9
    held_out = sample.withColumn("anchor_date", F.lit(calendar.train_before))
    assert run.hold_out_auc(boosters, held_out, calendar) > 0.9
    with pytest.raises(ValueError):
        model.blended_score(model.Boosters(boosters.features, boosters.models[:2]), sample)


def test_shorter_models_are_prefixes_of_the_longest(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.random(), i % 7) for i in range(800)]
    rows = [(a, b, c, int(a + 0.5 * b + rng.random() / 2 > 1)) for a, b, c in rows]
    sample = spark.createDataFrame(rows, "a double, b double, c int, flag int").repartition(5)
    settings = {"maxDepth": 3, "checkpointInterval": 2}
    both = model.train_boosters(sample, ["a", "b", "c"], rounds=(3, 6), **settings)
    alone = model.train_boosters(sample, ["a", "b", "c"], rounds=(3,), **settings)
    assert [m.getNumTrees for m in both.models] == [3, 6]
    got = model.probabilities(both, sample).select("a", "probability_0").orderBy("a").collect()
    expected = model.probabilities(alone, sample).select("a", "probability_0").orderBy("a").collect()
    assert got == expected


def test_wrong_number_of_weights_raises(spark, calendar):
    with pytest.raises(ValueError, match="weights"):
        run.scored_days(spark.range(1), calendar, rounds=(2, 3), weights=(1.0,))
    with pytest.raises(ValueError, match="weights"):
        model.blend(spark.range(1), ["a", "b"], (1.0, 1.0, 1.0))


def test_integers_are_exact_and_lost_cells_are_counted(spark, tmp_path):
    cells = ["9007199254740993", "9007199254740992", "3.0", "3.7", "", "x", "-5.", "99999999999999999999", " 8 "]
    (tmp_path / "p.csv").write_text("sku_id,brand,shop_id,cate\n" + "".join(f"{c},1,1,1\n" for c in cells))
    found = [r["sku_id"] for r in read_csv(spark, str(tmp_path / "p.csv"), "product").collect()]
    assert found == [9007199254740993, 9007199254740992, 3, None, None, None, -5, None, 8]
    lost = {r["column_name"]: r["cells"] for r in unparsed_cells(spark, str(tmp_path / "p.csv"), "product").collect()}
    assert lost == {"sku_id": 3, "brand": 0, "shop_id": 0, "cate": 0}


def test_calendar_with_gaps(spark, calendar):
    days = [LAST - timedelta(days=d) for d in (10, 5, 0)]
    gaps = replace(calendar, anchors=tuple(days), train_before=days[1])
    sample = spark.createDataFrame([(1, 1, 1, d, float(u)) for d in days for u in range(100)], "user_id int, cate int, shop_id int, anchor_date date, score double")
    parts = {r["anchor_date"]: r["part"] for r in segments.time_split(sample, gaps).collect()}
    assert parts == dict(zip(days, ("train", "score_before", "score_last"), strict=True))
    assert run.held_out(sample, gaps).count() == 0
    assert selection.select_days(sample.drop("user_id").withColumn("user_id", F.col("score")), (gaps.last, gaps.before_last), (92, 98)).count() == 8
    with pytest.raises(ValueError, match="two anchors"):
        replace(calendar, anchors=(LAST,)).before_last  # noqa: B018


def test_hand_over_removes_its_tables_and_passes_errors_on(spark):
    with HandOver(spark) as store:
        assert store.put("a", spark.range(3)).count() == 3
        folder = store.folder.removeprefix("file:")
        assert os.path.isdir(folder)
        with pytest.raises(Exception, match="no_such_column"):
            store.put_many({"bad": lambda: spark.range(1).selectExpr("no_such_column"), "good": lambda: spark.range(5)})
    assert not os.path.exists(folder)
