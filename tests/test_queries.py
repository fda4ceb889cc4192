"""Every registered query against its DuckDB SQL on the smallest scale."""

import pytest

import __spark_entry__ as catalogue
from checks.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
CORPUS = set(catalogue.corpus_queries.QUERIES) if catalogue.corpus_queries else set()
SQL = {name: sql for name, sql in catalogue.oracle_sql().items() if name not in CORPUS}
QUERIES = {name: build for name, build in catalogue.queries().items() if name not in CORPUS}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_trained_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == {"gbt_scores", "gbt_stage_auc", "predicted_list"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert catalogue.entry(spark).count() > 0


def test_trained_queries_return_rows_in_range(spark):
    scores = QUERIES["gbt_scores"](spark, FOLDER)
    assert scores.count() > 0 and scores.where("score < 0 or score > 7 / 3.0").count() == 0
    aucs = QUERIES["gbt_stage_auc"](spark, FOLDER).collect()
    assert [r["rounds"] for r in aucs] == list(catalogue.TRIAL_ROUNDS) and all(0 <= r["auc"] <= 1 for r in aucs)
    assert set(QUERIES["predicted_list"](spark, FOLDER).columns) == {"user_id", "cate", "shop_id"}
