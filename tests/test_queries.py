"""Every registered query against its SQL, and the plans of the main ones."""

from __future__ import annotations

import pytest
from compare import compare, driver, duck
from pyspark.sql import functions as F

from patronlens.operators import features
from patronlens.plans import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"
FITTED = {"churn_scores", "feature_attribution"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_only_fitted_models_lack_sql():
    assert set(catalog.queries()) - set(oracle.oracle_sql()) == FITTED
    assert set(oracle.oracle_sql()) <= set(catalog.queries())
    assert set(catalog.queries()) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - FITTED))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""


def test_entry(spark):
    assert driver.entry(spark).count() == 150


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_plan_spreads_orders_before_customers(spark):
    plan = plan_of(features.customer_base(catalog.star_orders(spark, SF_DIR), catalog.STAR))
    assert "hashpartitioning(customer_id" in plan and "SinglePartition" not in plan
    assert "order_id" in [p for p in plan.split("hashpartitioning(") if "customer_id" in p][-1].split(")")[0]
    assert "lineitem" not in plan and "Python" not in plan
    assert "LessThanOrEqual(o_orderdate" in plan


def test_gap_plan_orders_days_not_rows(spark):
    plan = plan_of(features.inter_purchase_time(catalog.event_orders(spark, SF_DIR), catalog.EVENTS))
    window = plan.index("Window")
    assert "partial_min" in plan[window:] and "day" in plan[window:]
    assert "SinglePartition" not in plan and "value" not in plan.split("ReadSchema")[1]


def test_gap_plan_at_midnights_is_one_aggregate(spark):
    plan = plan_of(features.inter_purchase_time(catalog.star_orders(spark, SF_DIR), catalog.STAR))
    assert plan.count("Exchange") == 1 and "Window" not in plan and "lineitem" not in plan


def test_scoring_adds_no_shuffle(spark):
    table = features.rfm(catalog.star_orders(spark, SF_DIR), catalog.STAR)
    assert "Exchange" not in plan_of(table) and "Sort" not in plan_of(table)
    scored = plan_of(catalog.fixed_clv(table).where(F.col("clv_12m") > 0))
    assert "BroadcastExchange" in scored and "hashpartitioning" not in scored and "Python" not in scored
