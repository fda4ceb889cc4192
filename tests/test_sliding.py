"""Counts carried from day to day against the counts of all anchors at once."""

import random
from dataclasses import replace
from datetime import timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from shoplens.operators.breadth import trailing_distinct
from shoplens.operators.sliding import SlidingCounts, SlidingDistinct, VersionedRows
from shoplens.operators.trailing import trailing_counts
from shoplens.settings import Calendar
from tests.conftest import LAST

WINDOWS = (1, 3, 7)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid4().hex)


@pytest.fixture(scope="module")
def few_days():
    return replace(Calendar.ending(LAST, 4), windows=WINDOWS)


def rows_of(df):
    return sorted(df.select(*sorted(df.columns)).collect(), key=str)


def random_rows(seed=5):
    """A third of the log is one user; one day of the span has no action; some keys and values are null."""
    rng, rows = random.Random(seed), []
    for _ in range(400):
        user = 7 if rng.random() < 0.34 else rng.choice([None, *range(1, 30)])
        ago = rng.choice([a for a in range(14) if a != 1])
        rows.append((user, rng.choice([None, 1, 2, 3]), rng.randint(1, 4), rng.randint(1, 9), rng.randint(1, 5), ago))
    return rows


def run_days(state, log, calendar):
    """Counts of each anchor, read when it was the last day."""
    state.start(log, calendar.first)
    found = rows_of(state.counts())
    for _ in calendar.anchors[1:]:
        state.advance(log)
        found += rows_of(state.counts())
    return sorted(found, key=str)


def test_daily_counts_equal_those_of_all_anchors(spark, make_log, few_days, folder):
    log = make_log(random_rows())
    for keys in (["user_id"], ["user_id", "cate"]):
        state = SlidingCounts(spark, f"{folder}/{len(keys)}", keys, WINDOWS, buckets=4)
        assert run_days(state, log, few_days) == rows_of(trailing_counts(log, few_days, keys))


def test_daily_distinct_counts_equal_those_of_all_anchors(spark, make_log, few_days, folder):
    log = make_log(random_rows(6))
    state = SlidingDistinct(spark, folder, ["user_id"], ["cate", "sku_id"], WINDOWS, buckets=4)
    assert run_days(state, log, few_days) == rows_of(trailing_distinct(log, few_days, ["user_id"], ["cate", "sku_id"]))


def test_only_days_that_enter_or_leave_are_read(spark, make_log, few_days, folder):
    state = SlidingCounts(spark, folder, ["user_id"], WINDOWS, buckets=4)
    state.start(make_log(random_rows()), few_days.first)
    state.advance(make_log(random_rows()))
    day = few_days.anchors[1]
    schema = state._daily(make_log([])).schema
    read = {p.split("action_date=")[1][:10] for p in state._changes(day, schema).inputFiles()}
    assert read <= {str(day), *[str(day - timedelta(days=n)) for n in WINDOWS]}


def test_parts_without_change_are_not_rewritten(spark, make_log, few_days, folder):
    state = SlidingCounts(spark, folder, ["user_id"], (7,), buckets=16)
    ago = (LAST - few_days.first).days
    state.start(make_log([(u, 1, 1, 1, 1, ago) for u in range(100)]), few_days.first)
    state.advance(make_log([(3, 1, 1, 1, 1, ago - 1)]))
    versions = list(state.state._manifest(few_days.anchors[1])["parts"].values())
    assert versions.count(str(few_days.anchors[1])) == 1 and len(versions) == 16
    counts = {r["user_id"]: r["user_action1_counts_7day"] for r in state.counts().collect()}
    assert counts == {u: 2 if u == 3 else 1 for u in range(100)}


def test_a_day_that_was_cut_off_is_run_again(spark, make_log, few_days, folder, monkeypatch):
    log = make_log(random_rows())
    state = SlidingCounts(spark, folder, ["user_id"], WINDOWS, buckets=4)
    state.start(log, few_days.first)
    publish = VersionedRows.publish

    def cut_off(self, day, rows, replaced):
        # Half of the parts are written and no manifest.
        rows.withColumn("bucket", self.bucket()).where("bucket < 2").write.partitionBy("bucket").parquet(f"{self.folder}/parts/{day}")
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedRows, "publish", cut_off)
    with pytest.raises(KeyboardInterrupt):
        state.advance(log)
    monkeypatch.setattr(VersionedRows, "publish", publish)
    later = SlidingCounts(spark, folder, ["user_id"], WINDOWS, buckets=4)
    assert later.state.last() == few_days.first
    assert later.advance(log) == few_days.anchors[1]
    wanted = trailing_counts(log, few_days, ["user_id"]).where(F.col("anchor_date") == F.lit(few_days.anchors[1]))
    assert rows_of(later.counts()) == rows_of(wanted)


def test_counts_stay_readable_for_a_day_and_old_parts_go(spark, make_log, few_days, folder):
    log = make_log(random_rows())
    state = SlidingCounts(spark, folder, ["user_id"], WINDOWS, buckets=4)
    state.start(log, few_days.first)
    lazy = state.counts()
    before = rows_of(lazy)
    state.advance(log)
    assert rows_of(lazy) == before
    for _ in few_days.anchors[2:]:
        state.advance(log)
    assert len(state.state._names(f"{folder}/state/manifest")) == 2
    assert f"action_date={few_days.first - timedelta(days=6)}" not in state.state._names(f"{folder}/days")


def test_empty_log_empty_days_and_other_settings(spark, make_log, few_days, folder):
    state = SlidingCounts(spark, folder, ["user_id"], (1,), buckets=4)
    with pytest.raises(ValueError):
        state.advance(make_log([]))
    state.start(make_log([]), few_days.first)
    assert state.counts().count() == 0
    state.advance(make_log([(1, 1, 1, 1, 1, (LAST - few_days.first).days - 1)]))
    assert state.counts().count() == 1
    state.advance(make_log([]))
    assert state.counts().count() == 0
    with pytest.raises(ValueError):
        state.start(make_log([]), few_days.first)
    with pytest.raises(ValueError):
        SlidingCounts(spark, folder, ["user_id"], (1, 3), buckets=4).counts()
