from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from patronlens import RunConfig  # noqa: E402
from patronlens.schemas import ORDERS  # noqa: E402
from patronlens.session import build_session  # noqa: E402

SNAPSHOT = dt.datetime(2024, 12, 31)

# Customer, order, days before the snapshot, revenue, channel, returned.
SMALL = [
    (1001, 1, 5, 80.0, "email", 0),
    (1001, 2, 20, 60.0, "organic", 0),
    (1001, 3, 45, 90.0, "email", 1),
    (1001, 4, 70, 50.0, "organic", 0),
    (1002, 5, 50, 30.0, "social", 0),
    (1002, 6, 100, 25.0, "social", 0),
    (1003, 7, 200, 15.0, "email", 0),
    (1003, 8, 250, 12.0, "organic", 1),
    (1003, 9, 300, 10.0, "email", 0),
    (1003, 10, 350, 11.0, "paid_search", 0),
]
LABELLED = [
    (9001, 101, 200, 40.0, "email", 0),
    (9001, 102, 400, 35.0, "organic", 0),
    (9002, 103, 10, 55.0, "social", 0),
    (9002, 104, 90, 45.0, "email", 0),
]


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return RunConfig()


@pytest.fixture(scope="session")
def orders_of(spark):
    """Orders from (customer, order, days before, revenue, channel, returned).

    Instead of the number of days a timestamp may be given.
    """

    def build(rows):
        def when(value):
            return SNAPSHOT - dt.timedelta(days=value) if isinstance(value, int) else value

        return spark.createDataFrame([(c, o, when(d), r, ch, ret) for c, o, d, r, ch, ret in rows], ORDERS)

    return build


@pytest.fixture(scope="session")
def small_orders(orders_of):
    return orders_of(SMALL)


@pytest.fixture(scope="session")
def labelled_orders(orders_of):
    return orders_of(LABELLED)


def by_key(df, key="customer_id"):
    return {row[key]: row for row in df.collect()}
