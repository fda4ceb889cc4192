"""Hand-made frames for null rules, window edges and names; brute force for random logs."""

import random
import re
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shoplens.operators import breadth, catalogue, conversion, enrich, history, profile, samples, trailing
from shoplens.plans.features import feature_names
from shoplens.plans.matrix import KEY_SETS, _same, feature_matrix, written_log
from shoplens.session import HandOver
from shoplens.settings import Calendar
from shoplens.sources import standin
from tests.conftest import LAST


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_feature_names_follow_the_grammar():
    names = feature_names()
    assert len(names) == len(set(names)) == 713
    assert names[0] == "fans_num" and names[-1] == "age_like_shop21_rank"
    assert sum("_counts_" in n for n in names) == 292
    assert sum(n.endswith("_coversion_rate") for n in names) == 63
    assert sum(n.endswith("_times") for n in names) == 35
    assert sum(n.endswith("_rank") for n in names) == 32


def test_every_feature_key_set_has_a_table():
    needed = (
        trailing.MATRIX_KEYS + conversion.ONE_KEY + conversion.TWO_KEYS + history.HISTORY_KEYS
        + [k for k, _ in breadth.BREADTH] + [list(k) for k in catalogue.OWNED]
    )
    assert all(any(_same(k, have) for have in KEY_SETS) for k in needed)


def test_calendar_dates():
    calendar = Calendar.ending(date(2018, 4, 15))
    assert calendar.first == date(2018, 4, 8)
    assert calendar.conversion_before == date(2018, 4, 8)
    assert calendar.history_before == date(2018, 3, 26)
    assert calendar.train_before == date(2018, 4, 13)
    with pytest.raises(ValueError):
        Calendar.ending(date(2018, 4, 15), windows=(0,))


def test_windows_are_closed_and_trailing(make_log, calendar):
    # Days before the last anchor; -1 lies after it and must not count.
    log = make_log([(1, 1, 1, 1, 1, ago) for ago in (-1, 0, 2, 3, 6, 7, 20, 21)])
    row = rows_by(trailing.trailing_counts(log, calendar, ["user_id"]), "user_id", "anchor_date")[(1, LAST)]
    got = [row[f"user_action1_counts_{n}day"] for n in (1, 3, 7, 21)]
    assert got == [1, 2, 4, 6]
    assert row["user_action2_counts_21day"] == 0


def test_null_keys_form_no_group(make_log, calendar):
    log = make_log([(1, 1, 1, 1, 1, 0)], sex=None)
    assert trailing.trailing_counts(log, calendar, ["sex"]).count() == 0
    assert history.history_counts(make_log([(1, 1, 1, 1, 1, 25)], sex=None), calendar, ["sex"]).count() == 0
    assert conversion.conversion_rates(make_log([(1, 1, 1, 1, 1, 25)], sex=None), calendar, ["sex"]).count() == 0


def test_key_columns_survive_trailing_counts(make_log, calendar):
    log = make_log([(1, 1, 1, 1, 1, 3)], age=5)
    result = trailing.trailing_counts(log, calendar, ["age"]).collect()
    assert {r["age"] for r in result} == {5}


def random_log(make_log, size=600, users=6, hot=0.35):
    rng = random.Random(7)
    rows = []
    for _ in range(size):
        user = 0 if rng.random() < hot else rng.randrange(users)  # user 0 holds over a third
        sku = rng.randrange(12)
        rows.append((user, sku % 3, sku % 4, sku, rng.randrange(1, 6), rng.randrange(-2, 30)))
    return rows, make_log(rows)


@pytest.mark.parametrize("only_active", [False, True])
def test_trailing_counts_against_brute_force(make_log, calendar, only_active):
    rows, log = random_log(make_log)
    got = rows_by(
        trailing.trailing_counts(log, calendar, ["user_id", "cate"], only_active), "user_id", "cate", "anchor_date"
    )
    expected = defaultdict(lambda: defaultdict(int))
    active = set()
    for user, cate, _, _, kind, ago in rows:
        for back in range(8):
            age = ago - back
            if age == 0:
                active.add((user, cate, LAST - timedelta(days=back)))
            for n in calendar.windows:
                if 0 <= age < n:
                    expected[(user, cate, LAST - timedelta(days=back))][(kind, n)] += 1
    keys = {k for k in expected if not only_active or k in active}
    assert set(got) == keys
    for key in keys:
        for n in calendar.windows:
            for t in range(1, 6):
                assert got[key][f"user_cate_action{t}_counts_{n}day"] == expected[key][(t, n)]


@pytest.mark.parametrize("only_active", [False, True])
def test_distinct_counts_against_brute_force(make_log, calendar, only_active):
    rows, log = random_log(make_log)
    got = rows_by(
        breadth.trailing_distinct(log, calendar, ["user_id"], ["sku_id", "shop_id"], only_active),
        "user_id", "anchor_date",
    )
    seen = defaultdict(set)
    active = set()
    for user, _, shop, sku, kind, ago in rows:
        for back in range(8):
            anchor, age = LAST - timedelta(days=back), ago - back
            if age == 0:
                active.add((user, anchor))
            for n in calendar.windows:
                if 0 <= age < n:
                    for t in ("", kind):
                        seen[(user, anchor, t, n, "skus")].add(sku)
                        seen[(user, anchor, t, n, "shops")].add(shop)
    keys = {k[:2] for k in seen if not only_active or k[:2] in active}
    assert set(got) == keys
    for user, anchor in keys:
        for n in calendar.windows:
            for t in ("", 1, 2, 3, 4):
                for what in ("skus", "shops"):
                    name = f"user_action{t}_{what}_{n}day"
                    assert got[(user, anchor)][name] == len(seen[(user, anchor, t, n, what)])


def test_one_sku_on_several_days_is_one_sku(make_log, calendar):
    log = make_log([(1, 1, 1, 9, 1, ago) for ago in (0, 2, 10)])
    row = rows_by(breadth.trailing_distinct(log, calendar, ["user_id"], ["sku_id"]), "anchor_date")[(LAST,)]
    assert [row[f"user_action1_skus_{n}day"] for n in calendar.windows] == [1, 1, 1, 1]


def test_null_values_are_not_counted_but_keep_the_key(make_log, calendar):
    log = make_log([(1, 1, 1, 9, 1, 0)], module_id=None)
    row = breadth.trailing_distinct(log, calendar, ["user_id"], ["module_id"]).collect()[0]
    assert row["user_action_modules_21day"] == 0


def test_active_days(make_log, calendar):
    log = make_log([(1, 1, 1, k, 2, ago) for k, ago in ((1, 0), (2, 0), (1, 2), (1, 6))])
    row = rows_by(trailing.active_days(log, calendar, ["user_id"]), "anchor_date")[(LAST,)]
    assert [row[f"user_action2_counts_date_{n}day"] for n in calendar.windows] == [1, 2, 3, 3]
    active = trailing.active_days(log, calendar, ["user_id"], only_active=True)
    assert {r["anchor_date"] for r in active.collect()} == {LAST - timedelta(days=d) for d in (0, 2, 6)}


def test_windows_nest_and_distinct_stays_below_count(make_log, calendar):
    _, log = random_log(make_log, size=200)
    counts = trailing.trailing_counts(log, calendar, ["user_id"])
    skus = breadth.trailing_distinct(log, calendar, ["user_id"], ["sku_id"])
    for row in counts.join(skus, ["user_id", "anchor_date"]).collect():
        for t in (1, 2, 3, 4):
            series = [row[f"user_action{t}_counts_{n}day"] for n in calendar.windows]
            assert series == sorted(series)
            assert all(row[f"user_action{t}_skus_{n}day"] <= c for n, c in zip(calendar.windows, series))


def test_anchors_need_not_be_consecutive(make_log):
    anchors = (date(2024, 1, 20), date(2024, 1, 30))
    sparse = Calendar(anchors, anchors[0], date(2024, 1, 10), anchors[1])
    _, log = random_log(make_log, size=150)
    days = {r["anchor_date"] for r in trailing.trailing_counts(log, sparse, ["user_id"]).collect()}
    assert days == set(anchors)


def test_anchors_far_apart_are_split_into_spans(make_log, calendar):
    anchors = (LAST - timedelta(days=200), LAST - timedelta(days=60), LAST)
    wide = Calendar(anchors, anchors[0], anchors[0], anchors[2])
    assert [c.anchors for c in wide.spans()] == [(a,) for a in anchors]
    assert len(calendar.spans()) == 1
    log = make_log([(1, 1, 1, k, 2, ago) for k, ago in ((1, 0), (2, 5), (3, 61), (4, 200), (4, 203), (5, 221))])
    skus = rows_by(breadth.trailing_distinct(log, wide, ["user_id"], ["sku_id"]), "anchor_date")
    days = rows_by(trailing.active_days(log, wide, ["user_id"]), "anchor_date")
    assert [skus[(a,)]["user_action_skus_21day"] for a in anchors] == [1, 1, 2]
    assert [days[(a,)]["user_action2_counts_date_21day"] for a in anchors] == [2, 1, 2]
    with pytest.raises(ValueError):
        Calendar.ending(LAST, windows=(1, 90)).spans()


def test_labels_look_only_ahead(make_log, calendar):
    anchor = calendar.last - timedelta(days=4)
    for ahead, expected in ((0, 0), (1, 1), (3, 1), (4, 0), (-1, 0)):
        log = make_log([(1, 1, 1, 1, 1, 4), (1, 1, 1, 1, 2, 4 - ahead)])
        sample = samples.samples(log, calendar).where(F.col("anchor_date") == F.lit(anchor))
        row = samples.label(sample, log, calendar).collect()[0]
        assert row["flag"] == expected, ahead
        assert samples.label_horizons(sample, log, calendar, (3,)).collect()[0]["flag_3"] == expected


def test_label_completeness(make_log, calendar):
    log = make_log([(1, 1, 1, 1, 1, 0), (1, 1, 1, 1, 1, 3)])
    labelled = samples.label(samples.samples(log, calendar), log, calendar, last_data_day=LAST)
    assert {r["anchor_date"]: r["label_complete"] for r in labelled.collect()} == {
        LAST: False, LAST - timedelta(days=3): True,
    }


def test_conversion_needs_a_browse_and_survives_none_at_all(make_log, calendar):
    log = make_log([(1, 1, 1, 1, 1, 20), (1, 1, 1, 1, 2, 20), (2, 1, 1, 1, 2, 20)])
    rates = rows_by(conversion.conversion_rates(log, calendar, ["user_id"]), "user_id")
    assert set(rates) == {(1,)}
    assert rates[(1,)]["user_id_2_coversion_rate"] == (1 + 1000 * 2.0) / (1 + 1000)
    nothing = make_log([(1, 1, 1, 1, 2, 20)])
    assert conversion.conversion_rates(nothing, calendar, ["user_id"]).count() == 0


def test_catalogue_fills_missing_rates_with_the_mean_over_keys(spark):
    products = spark.createDataFrame(
        [(1, 1, 10, 5, 100, 60, 10, 0.6, 0.1), (2, 1, 20, 5, 50, 10, 5, 0.2, 0.3),
         (3, 2, 30, 5, None, None, None, None, None), (4, 2, None, 5, 7, 7, 7, 0.9, 0.9)],
        "sku_id bigint, brand bigint, shop_id bigint, cate bigint, sku_comment_nums bigint, "
        "sku_good_comment_nums bigint, sku_bad_comment_nums bigint, sku_good_comment_rate double, "
        "sku_bad_comment_rate double",
    )
    shops = rows_by(catalogue.catalogue(products, ["shop_id"]), "shop_id")
    assert set(shops) == {(10,), (20,), (30,)}
    assert shops[(30,)]["shop_comment_nums"] == 0
    assert shops[(30,)]["shop_good_comm_rate_mean"] == pytest.approx(0.4)
    assert shops[(30,)]["shop_bad_comm_rate_max"] == pytest.approx(0.2)


def test_comment_rates(spark):
    comments = spark.createDataFrame(
        [(1, 4, 3, 1), (1, 6, 1, 1), (2, 10, 0, 2), (None, 90, 90, 0)],
        "sku_id bigint, comments bigint, good_comments bigint, bad_comments bigint",
    )
    rates = rows_by(enrich.sku_comment_rates(comments), "sku_id")
    assert rates[(1,)]["sku_comment_nums"] == 10
    assert rates[(1,)]["sku_good_comment_rate"] == pytest.approx((4 + 50 * 0.2) / 60)
    assert rates[(2,)]["sku_bad_comment_rate"] == pytest.approx((2 + 50 * 0.2) / 60)


def test_profile_null_rules(spark, calendar):
    day = "timestamp'2018-06-15 10:00:00'"
    shops = spark.sql(
        f"select 1L shop_id, 5L main_cate, 1L fans_num, 1L vip_num, 1.0D shop_score, {day} shop_reg_tm "
        f"union all select 2L, null, 1L, 1L, 1.0D, {day} union all select 3L, 5L, 1L, 1L, 1.0D, null"
    )
    users = spark.sql(
        "select 1L user_id, 1 age, 1 sex, 1 user_lv_cd, 1 city_level, 1 province, 1 city, 1 county, "
        "cast(null as timestamp) user_reg_tm"
    )
    sample = spark.sql("select 1L user_id, 5L cate, id + 1 as shop_id, date'2024-01-30' anchor_date from range(3)")
    rows = rows_by(profile.static_profile(sample, shops, users), "shop_id")
    assert set(rows) == {(1,), (2,)}  # shop 3 has no registration date
    assert rows[(1,)]["same_with_main_cate"] == 1 and rows[(2,)]["same_with_main_cate"] == 0
    assert rows[(1,)]["shop_reg_year"] == 2018 and rows[(1,)]["shop_reg_days"] == 200
    assert rows[(1,)]["user_reg_year"] is None and rows[(1,)]["user_reg_days"] is None


def test_full_join_chain_equals_conditional_aggregate(make_log):
    _, log = random_log(make_log, size=150)
    joined = history.type_counts_by_full_join(log, ["user_id"], (1, 2, 3, 4))
    late = Calendar.ending(LAST, history_before=LAST + timedelta(days=9))
    plain = history.history_counts(log, late, ["user_id"])
    assert rows_by(joined, *joined.columns).keys() == rows_by(plain, *joined.columns).keys()


@pytest.mark.parametrize("only_active", [False, True])
def test_long_windows_against_brute_force(make_log, only_active):
    rng = random.Random(8)
    rows = [(rng.randrange(4), rng.randrange(3), 1, rng.randrange(5), rng.randrange(1, 6), rng.randrange(120)) for _ in range(300)]
    long = Calendar.ending(LAST, n_anchors=3, windows=(7, 100))
    log = make_log(rows)
    got = breadth.trailing_distinct(log, long, ["user_id"], ["sku_id"], only_active).collect()
    days = {(r["user_id"], r["anchor_date"]): r for r in trailing.active_days(log, long, ["user_id"], only_active).collect()}
    by_anchor = {(r["user_id"], r["anchor_date"]): r for r in got}
    wanted = set()
    for anchor in long.anchors:
        back = (LAST - anchor).days
        for user in range(4):
            own = [(k, t, ago - back) for u, _, _, k, t, ago in rows if u == user and ago >= back]
            if not any(a < (1 if only_active else 100) for _, _, a in own):
                continue
            wanted.add((user, anchor))
            for n in long.windows:
                r = by_anchor[(user, anchor)]
                assert r[f"user_action_skus_{n}day"] == len({k for k, _, a in own if a < n})
                assert r[f"user_action2_skus_{n}day"] == len({k for k, t, a in own if a < n and t == 2})
                assert days[(user, anchor)][f"user_action2_counts_date_{n}day"] == len({a for _, t, a in own if a < n and t == 2})
    assert set(by_anchor) == wanted == set(days)


def test_matrix_scans_the_log_a_few_times(spark, calendar):
    scans = []

    class Counting(HandOver):
        def put(self, name, df, partition_by=()):
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            plan = df._jdf.queryExecution().explainString(mode)
            scans.append(len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*/log\]", plan)))
            return super().put(name, df, partition_by)

    tables = standin.load(spark, "/root/testdata/sf0.001")
    with Counting(spark) as store:
        feature_matrix(tables, calendar, store, written_log(tables, store))
    assert 2 < sum(scans) <= 10
