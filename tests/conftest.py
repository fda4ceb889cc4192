import os
import sys
from datetime import date, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.session import build_session  # noqa: E402
from shoplens.settings import Calendar  # noqa: E402

LAST = date(2024, 1, 30)
LOG_SCHEMA = (
    "user_id bigint, sku_id bigint, module_id bigint, type int, action_date date, n bigint, "
    "brand bigint, cate bigint, shop_id bigint, age int, sex int, province int, city int, county int"
)


@pytest.fixture(scope="session")
def spark():
    return build_session(app="tests")


@pytest.fixture(scope="session")
def calendar():
    return Calendar.ending(LAST)


@pytest.fixture
def make_log(spark):
    """Log from short rows (user, cate, shop, sku, type, days before the last anchor)."""

    def build(rows, **fixed):
        base = {"module_id": 1, "brand": 1, "age": 1, "sex": 1, "province": 1, "city": 1, "county": 1, "n": 1}
        base.update(fixed)
        data = [
            {
                **base, "user_id": u, "cate": c, "shop_id": s, "sku_id": k, "type": t,
                "action_date": LAST - timedelta(days=ago),
            }
            for u, c, s, k, t, ago in rows
        ]
        return spark.createDataFrame(data, LOG_SCHEMA)

    return build
