"""Data-quality checks, the leakage guard and table summaries."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from patronlens.config import RunConfig
from patronlens.functions.columns import is_blank, is_missing, known, on_or_before
from patronlens.schemas import KEY_COLUMNS

log = logging.getLogger(__name__)

# Times the least number of customers from which an estimate is certain to be above it (its error is 5 %).
SURE = 2


def check_names(cfg: RunConfig) -> list[str]:
    """The checks, in the order they are reported."""
    # Names that users of the report look for.
    return [
        "no_nulls_in_key_columns",
        "revenue_always_positive",
        "no_orders_after_snapshot_date",
        "no_empty_string_ids",
        f"at_least_{cfg.min_customers}_distinct_customers",
    ]


def validation_report(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per check with its violations, from one aggregate over the orders.

    A null revenue or date violates its check, while an empty table passes. For
    the last check the violations are the customers missing to the minimum.
    """
    customers = F.greatest(F.lit(cfg.min_customers) - F.count_distinct("customer_id"), F.lit(0))
    return _report(orders.agg(*_violations(orders, cfg), customers.alias("v4")), cfg)


def _violations(orders: DataFrame, cfg: RunConfig) -> list[Column]:
    """Counts of the first four checks."""
    missing = sum((is_missing(orders, c).cast("long") for c in KEY_COLUMNS), F.lit(0))
    positive = F.coalesce(known(F.col("revenue")) > 0, F.lit(False))
    in_time = F.coalesce(on_or_before(orders, "order_date", cfg.snapshot), F.lit(False))
    blank = is_blank(orders, "customer_id") | is_blank(orders, "order_id")
    return [
        F.coalesce(F.sum(missing), F.lit(0)).alias("v0"),
        F.count_if(~positive).alias("v1"),
        F.count_if(~in_time).alias("v2"),
        F.count_if(blank).alias("v3"),
    ]


def _report(counted: DataFrame, cfg: RunConfig) -> DataFrame:
    checks = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("check_name"),
            F.col(f"v{i}").cast("long").alias("violations"),
        )
        for i, name in enumerate(check_names(cfg))
    ]
    return counted.select(F.inline(F.array(*checks))).withColumn("passed", F.col("violations") == 0)


def watched(orders: DataFrame, cfg: RunConfig) -> tuple[DataFrame, Observation]:
    """``orders`` with the checks counted as they pass, by whatever action reads them next; see :func:`observed_report`."""
    told = Observation(f"orders-{uuid.uuid4().hex}")
    return orders.observe(told, *_violations(orders, cfg), F.approx_count_distinct("customer_id").alias("customers")), told


def observed_report(told: Observation, stored: DataFrame, cfg: RunConfig) -> DataFrame:
    """The report of :func:`validation_report` from what an action on watched orders has counted.

    Observed counts hold no exact number of distinct customers. An estimate of ``SURE`` times the minimum is far more than
    its error above it; only below that are the customers of the ``stored`` orders counted exactly.
    """
    found = told.get
    missing = 0
    if found["customers"] < SURE * cfg.min_customers:
        exact = stored.agg(F.count_distinct("customer_id")).first()[0]
        missing = max(cfg.min_customers - exact, 0)
    counts = [tuple(int(found[f"v{i}"]) for i in range(4)) + (missing,)]
    return _report(stored.sparkSession.createDataFrame(counts, ", ".join(f"v{i} long" for i in range(5))), cfg)


def run_validation(orders: DataFrame, cfg: RunConfig) -> list[tuple[str, bool]]:
    """Report every check and raise if any failed, naming all that did."""
    return enforce(validation_report(orders, cfg))


def enforce(report: DataFrame) -> list[tuple[str, bool]]:
    """Log a report and raise if any check failed."""
    rows = sorted(report.collect(), key=lambda r: r["position"])
    for row in rows:
        log.info("%s: %s", row["check_name"], "ok" if row["passed"] else f"{row['violations']} violations")
    broken = {row["check_name"]: row["violations"] for row in rows if not row["passed"]}
    if broken:
        counts = ", ".join(f"{name} ({count} violations)" for name, count in broken.items())
        raise ValueError(f"orders refused by {len(broken)} of {len(rows)} checks: {counts}")
    return [(row["check_name"], row["passed"]) for row in rows]


def future_rows(df: DataFrame, cfg: RunConfig, date_column: str = "order_date") -> DataFrame:
    """How many rows are dated after the snapshot."""
    late = ~on_or_before(df, date_column, cfg.snapshot)
    return df.agg(F.count_if(late).alias("future_rows"))


def assert_no_future_dates(df: DataFrame, cfg: RunConfig, date_column: str = "order_date") -> None:
    """Raise if any row is dated after the snapshot."""
    late = future_rows(df, cfg, date_column).first()["future_rows"]
    if late:
        raise ValueError(f"leak: {date_column} is past {cfg.snapshot} in {late} rows; cut the table with past_orders() first")


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and missing values per column, from one aggregate."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("rows"), *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(names)]
    )
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(names)]
    return counted.select(
        "rows", F.lit(len(names)).cast("long").alias("columns"), F.inline(F.array(*entries))
    ).select("column_name", "missing", "rows", "columns")


def orders_profile(orders: DataFrame) -> DataFrame:
    """Row count, date range and distinct customers of an orders table."""
    return orders.agg(
        F.count("*").alias("rows"),
        F.min("order_date").cast("date").alias("first_day"),
        F.max("order_date").cast("date").alias("last_day"),
        F.count_distinct("customer_id").alias("customers"),
    )
