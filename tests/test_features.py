"""Golden values, the rules at the edges, and freedom from leakage."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL, SNAPSHOT, by_key
from pyspark.sql import functions as F

from patronlens.functions.columns import round_floats
from patronlens.operators import features
from patronlens.schemas import CHURN_COLUMNS, RFM_COLUMNS


def row(customer, order, when, revenue=10.0, returned=0):
    return (customer, order, when, revenue, "email", returned)


def test_rfm_golden_values(small_orders, cfg):
    table = features.rfm(small_orders, cfg)
    assert table.columns == RFM_COLUMNS
    found = by_key(table)
    expected = {
        1001: (4, 280.0, 5, 70, 70.0, 5, 3, 5, "535"),
        1002: (2, 55.0, 50, 100, 27.5, 3, 1, 3, "313"),
        1003: (4, 48.0, 200, 350, 12.0, 1, 5, 1, "151"),
    }
    assert {k: tuple(r)[1:] for k, r in found.items()} == expected


def test_churn_features_golden_values(small_orders, cfg):
    table = features.customer_features(small_orders, cfg)
    assert table.columns == CHURN_COLUMNS
    found = by_key(table)
    expected = {
        1001: (70.0, 18.257419, 0.25, 21.666667, 70, 0.0, 0),
        1002: (27.5, 3.535534, 0.0, 50.0, 100, 0.0, 0),
        1003: (12.0, 2.160247, 0.25, 50.0, 350, 0.0, 1),
    }
    for customer, values in expected.items():
        assert tuple(found[customer])[10:] == pytest.approx(values, abs=1e-6)


def test_second_fixture(labelled_orders, cfg):
    found = by_key(features.customer_features(labelled_orders, cfg))
    assert tuple(found[9001])[1:5] == (2, 75.0, 200, 400) and found[9001]["rfm_segment"] == "111"
    assert tuple(found[9002])[1:5] == (2, 100.0, 10, 90) and found[9002]["rfm_segment"] == "555"
    assert (found[9001]["churn_label"], found[9002]["churn_label"]) == (1, 0)
    assert found[9001]["inter_purchase_time_avg"] == 200.0
    assert found[9002]["inter_purchase_time_avg"] == 80.0
    assert found[9002]["std_order_value"] == pytest.approx(7.071068, abs=1e-6)


def test_recent_buyer_scores_higher(small_orders, cfg):
    found = by_key(features.rfm(small_orders, cfg))
    assert found[1001]["R_score"] > found[1003]["R_score"]


def test_scores_are_never_null(small_orders, cfg):
    table = features.rfm(small_orders, cfg)
    for name in ("R_score", "F_score", "M_score", "rfm_segment"):
        assert table.where(F.col(name).isNull()).count() == 0


def test_both_feature_forms_agree(small_orders, cfg):
    two_steps = features.churn_features(small_orders, features.rfm(small_orders, cfg), cfg)
    assert by_key(two_steps) == by_key(features.customer_features(small_orders, cfg))


def test_future_orders_change_nothing(orders_of, cfg):
    future = (1001, 999, SNAPSHOT + dt.timedelta(days=30), 9999.0, "email", 0)
    base, added = orders_of(SMALL), orders_of([future])
    assert by_key(features.customer_features(base.unionByName(added), cfg)) == by_key(
        features.customer_features(base, cfg)
    )


def test_row_order_and_partitions_change_nothing(orders_of, cfg):
    """Up to the last bits of the deviation, which depend on the order of adding."""
    plain = features.customer_features(orders_of(SMALL), cfg)
    turned = features.customer_features(orders_of(SMALL[::-1]).repartition(5), cfg)
    assert by_key(round_floats(turned, 9)) == by_key(round_floats(plain, 9))


def test_days_are_whole_24_hour_periods(orders_of, cfg):
    orders = orders_of([row(1, 1, dt.datetime(2024, 12, 30, 13)), row(2, 2, dt.datetime(2024, 12, 29, 23, 59))])
    found = by_key(features.customer_base(orders, cfg))
    assert (found[1]["recency"], found[2]["recency"]) == (0, 1)


def test_orders_later_on_the_snapshot_day_are_dropped(orders_of, cfg):
    orders = orders_of([row(1, 1, SNAPSHOT), row(2, 2, SNAPSHOT + dt.timedelta(seconds=1)), row(3, 3, None)])
    assert set(by_key(features.customer_base(orders, cfg))) == {1}


def test_label_is_strictly_beyond_the_window(orders_of, cfg):
    orders = orders_of([row(c, c, c) for c in (89, 90, 91)])
    found = by_key(features.customer_features(orders, cfg))
    assert [found[c]["churn_label"] for c in (89, 90, 91)] == [0, 0, 1]


def test_single_order(orders_of, cfg):
    found = by_key(features.customer_features(orders_of([row(1, 1, 3), row(2, 2, 4)]), cfg))
    assert (found[1]["std_order_value"], found[1]["inter_purchase_time_avg"]) == (0.0, 90.0)


def test_null_customer_null_revenue_and_nan(orders_of, cfg):
    orders = orders_of(
        [row(None, 1, 3), row(1, 2, 3, None), row(1, 3, 4, None), row(2, 4, 4, float("nan")), row(2, 5, 5, 7.0)]
    )
    found = by_key(features.customer_base(orders, cfg))
    assert set(found) == {1, 2}
    assert (found[1]["monetary"], found[2]["monetary"]) == (0.0, 7.0)


def test_repeated_order_id_counts_once_but_weighs_twice(orders_of, cfg):
    orders = orders_of([row(1, 7, 3, 10.0, 1), row(1, 7, 5, 30.0, 0), row(2, 8, 1)])
    found = by_key(features.customer_features(orders, cfg))
    assert found[1]["frequency"] == 1 and found[1]["avg_order_value"] == 20.0
    assert found[1]["return_rate"] == 0.5 and found[1]["inter_purchase_time_avg"] == 2.0
    assert found[1]["std_order_value"] == pytest.approx(14.142136, abs=1e-6)


def test_one_customer_cannot_be_scored(orders_of, cfg):
    with pytest.raises(ValueError, match="edges"):
        features.rfm(orders_of([row(1, 1, 3)]), cfg)


def test_text_customer_ids(small_orders, cfg):
    text = small_orders.withColumn("customer_id", F.concat(F.lit("c"), F.col("customer_id").cast("string")))
    found = by_key(features.rfm(text, cfg))
    assert found["c1001"]["rfm_segment"] == "535" and found["c1003"]["rfm_segment"] == "151"


def brute_force_gap(stamps, window):
    stamps = sorted(stamps)
    gaps = [(b - a).days for a, b in zip(stamps, stamps[1:])]
    return sum(gaps) / len(gaps) if gaps else float(window)


def test_gap_mean_against_row_by_row(spark, orders_of, cfg):
    import random

    draw = random.Random(5)
    rows, stamps = [], {}
    for order in range(600):
        customer = draw.choice([1, 1, 1, 2, 3, 4, draw.randint(5, 40)])
        when = dt.datetime(2024, 12, 1) + dt.timedelta(microseconds=draw.randint(0, 20 * 86_400 * 1_000_000))
        if draw.random() < 0.2:
            when = when.replace(hour=0, minute=0, second=0, microsecond=0)
        rows.append(row(customer, order, when))
        stamps.setdefault(customer, []).append(when)
    found = by_key(features.inter_purchase_time(orders_of(rows), cfg))
    for customer, times in stamps.items():
        assert found[customer]["inter_purchase_time_avg"] == pytest.approx(brute_force_gap(times, 90), abs=1e-12)


def test_segments_and_label_counts(small_orders, cfg):
    table = features.customer_features(small_orders, cfg)
    assert [tuple(r) for r in features.top_segments(table, 2).collect()] == [("151", 1), ("313", 1)]
    counts = {r["status"]: (r["customers"], r["share"]) for r in features.label_counts(table).collect()}
    assert counts == {"churned": (1, pytest.approx(1 / 3)), "retained": (2, pytest.approx(2 / 3))}


def test_one_customer_with_a_third_of_the_orders(spark, cfg):
    """Everything against pandas, with repeated order ids and times of day."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    size = 20_000
    local = pd.DataFrame(
        {
            "customer_id": np.where(np.arange(size) % 3 == 0, 7, rng.integers(1, 900, size)),
            "order_id": rng.integers(1, size, size),
            "order_date": pd.Timestamp(SNAPSHOT) - pd.to_timedelta(rng.integers(-86_400 * 9, 86_400 * 700, size), "s"),
            "revenue": rng.integers(100, 9_999, size) / 100.0,
            "channel": "email",
            "is_returned": rng.integers(0, 2, size).astype("int32"),
        }
    )
    orders = spark.createDataFrame(local).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    found = features.customer_features(orders, cfg).toPandas().sort_values("customer_id").reset_index(drop=True)

    past = local[local.order_date <= SNAPSHOT].sort_values("order_date")
    by = past.groupby("customer_id")
    base = pd.DataFrame(
        {
            "frequency": by.order_id.nunique(),
            "monetary": by.revenue.sum(),
            "recency": (pd.Timestamp(SNAPSHOT) - by.order_date.max()).dt.days,
            "T": (pd.Timestamp(SNAPSHOT) - by.order_date.min()).dt.days,
            "avg_order_value": by.revenue.mean(),
            "std_order_value": by.revenue.std().fillna(0.0),
            "return_rate": by.is_returned.mean(),
            "inter_purchase_time_avg": by.order_date.apply(lambda d: brute_force_gap(list(d), 90)),
        }
    ).reset_index()
    for name, column, turned in (("R_score", "recency", True), ("F_score", "frequency", False)):
        bins = pd.qcut(base[column].rank(method="first"), 5, labels=False)
        assert (found[name] == (5 - bins if turned else bins + 1)).all()
    for column in base.columns:
        assert np.allclose(found[column].astype(float), base[column].astype(float), rtol=1e-12, atol=1e-9), column
    assert found.loc[found.customer_id == 7, "frequency"].item() > 4_000
