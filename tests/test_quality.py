"""Checks, guard and summaries."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from conftest import SNAPSHOT
from pyspark.sql import functions as F

from patronlens.functions.columns import is_blank, percent_text, pounds_text, round_half_even
from patronlens.operators import quality


def report(orders, cfg):
    return {r["check_name"]: (r["violations"], r["passed"]) for r in quality.validation_report(orders, cfg).collect()}


def test_clean_orders_pass(small_orders, cfg):
    few = replace(cfg, min_customers=3)
    results = quality.run_validation(small_orders, few)
    assert [name for name, _ in results] == quality.check_names(few)
    assert all(passed for _, passed in results)


def test_all_failures_are_named_in_order(orders_of, cfg):
    bad = orders_of(
        [
            (None, 1, 3, 5.0, "email", 0),
            (1, 2, -1, 5.0, "email", 0),
            (2, 3, 4, float("nan"), "email", 0),
            (3, 4, None, 0.0, "email", 0),
        ]
    )
    found = report(bad, replace(cfg, min_customers=5))
    assert found["no_nulls_in_key_columns"] == (3, False)
    assert found["revenue_always_positive"] == (2, False)
    assert found["no_orders_after_snapshot_date"] == (2, False)
    assert found["no_empty_string_ids"] == (0, True)
    assert found["at_least_5_distinct_customers"] == (2, False)
    with pytest.raises(ValueError) as error:
        quality.run_validation(bad, replace(cfg, min_customers=5))
    names = [n for n in quality.check_names(replace(cfg, min_customers=5)) if n in str(error.value)]
    assert len(names) == 4 and "no_empty_string_ids" not in str(error.value)


def test_empty_table_fails_only_the_customer_minimum(small_orders, cfg):
    found = report(small_orders.limit(0), cfg)
    assert [passed for _, passed in found.values()] == [True, True, True, True, False]


def test_blank_ids(spark, small_orders, cfg):
    texts = spark.createDataFrame([(" ",), ("\t",), ("",), (" ",), ("a ",), (None,)], "c string")
    assert [r[0] for r in texts.select(is_blank(texts, "c")).collect()] == [True, True, True, True, False, False]
    blank = small_orders.withColumn("customer_id", F.lit(" "))
    assert report(blank, cfg)["no_empty_string_ids"] == (10, False)


def test_future_guard(orders_of, small_orders, cfg):
    quality.assert_no_future_dates(small_orders, cfg)
    late = orders_of([(1, 1, SNAPSHOT + dt.timedelta(days=1), 1.0, "email", 0), (1, 2, 1, 1.0, "email", 0)])
    with pytest.raises(ValueError, match="order_date is past .* in 1 rows"):
        quality.assert_no_future_dates(late, cfg)


def test_table_summary_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x"), (None, "y")], "a double, b string")
    found = {r["column_name"]: (r["missing"], r["rows"], r["columns"]) for r in quality.table_summary(df).collect()}
    assert found == {"a": (2, 3, 2), "b": (1, 3, 2)}


def test_rounding_goes_to_the_even_neighbour(spark):
    values = [2.675, 0.285, 1.005, 0.125, -0.001]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(round_half_even(F.col("v"))).collect()] == [2.68, 0.28, 1.0, 0.12, 0.0]


def test_number_texts(spark):
    row = spark.range(1).select(percent_text(F.lit(0.66666)), pounds_text(F.lit(1234567.5))).first()
    assert tuple(row) == ("66.7%", "£1,234,567.50")
