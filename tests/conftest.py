from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpath.schemas import ACTION_SCHEMA, USER_SCHEMA  # noqa: E402
from clickpath.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="clickpath-tests")
    checkpoint_dir(s)  # unset in tests: a scratch folder is taken
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def action(
    session_id="s1",
    user_id=1,
    time="2024-01-01 10:00:00",
    keyword=None,
    click=None,
    orders=None,
    pays=None,
    date=None,
    page_id=0,
    click_product=None,
    order_products=None,
    pay_products=None,
    city_id=0,
):
    t = ts(time) if time is not None else None
    d = date if date is not None else (time[:10] if time else None)
    return (
        d,
        user_id,
        session_id,
        page_id,
        t,
        keyword,
        click,
        click_product,
        orders,
        order_products,
        pays,
        pay_products,
        city_id,
    )


def make_actions(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def user(user_id, age=30, professional=1, city=1, sex="male", name="u"):
    return (user_id, name, name, age, professional, city, sex)


def make_users(spark, rows):
    return spark.createDataFrame(rows, USER_SCHEMA)
