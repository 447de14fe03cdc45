"""Customer features: recency, frequency, monetary value and churn predictors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.config import RunConfig
from patronlens.functions.columns import known, on_or_before, snapshot_ts, whole_days
from patronlens.operators.ranking import cuts_passed, quantile_spec, rank_cuts
from patronlens.schemas import CHURN_COLUMNS, RFM_COLUMNS
from patronlens.sources.staging import stage

KEY = "customer_id"


def past_orders(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Orders of known customers on or before the snapshot."""
    return orders.filter(on_or_before(orders, "order_date", cfg.snapshot) & F.col(KEY).isNotNull())


def _purchase_totals() -> list[Column]:
    return [
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.count_distinct("order_id").alias("frequency"),
        F.coalesce(F.sum(known(F.col("revenue"))), F.lit(0.0)).alias("monetary"),
    ]


def _value_stats() -> list[Column]:
    revenue = known(F.col("revenue"))
    return [
        F.avg(revenue).alias("avg_order_value"),
        F.coalesce(F.stddev_samp(revenue), F.lit(0.0)).alias("std_order_value"),
        F.avg(F.col("is_returned").cast("double")).alias("return_rate"),
    ]


def with_ages(totals: DataFrame, cfg: RunConfig) -> DataFrame:
    """Days since the last and the first order, and money per order."""
    now = snapshot_ts(cfg.snapshot)
    return totals.withColumns(
        {
            "recency": whole_days(now, F.col("last_order_date")),
            "T": whole_days(now, F.col("first_order_date")),
            "avg_monetary": F.try_divide(F.col("monetary"), F.col("frequency")),
        }
    ).drop("last_order_date", "first_order_date")


def customer_base(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per customer: frequency, monetary, recency, T, avg_monetary.

    Frequency counts distinct orders, so Spark first spreads the rows over
    (customer, order) and only then brings small partial results together by
    customer; a customer owning a third of all orders stays spread out.
    """
    return with_ages(past_orders(orders, cfg).groupBy(KEY).agg(*_purchase_totals()), cfg)


def order_value_stats(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Mean and sample deviation of order values, and the share returned."""
    return past_orders(orders, cfg).groupBy(KEY).agg(*_value_stats())


def _mean_gap(days: Column, orders: Column, cfg: RunConfig) -> Column:
    gaps = orders - F.lit(1)
    return F.when(gaps > 0, F.coalesce(days, F.lit(0)) / gaps).otherwise(F.lit(float(cfg.churn_window_days)))


def _midnight_gap(cfg: RunConfig) -> Column:
    """Mean gap where every order is at midnight: the gaps are whole days, so
    their sum is the span from the first order to the last."""
    span = whole_days(F.max("order_date"), F.min("order_date"))
    return _mean_gap(span, F.count("*"), cfg).alias("inter_purchase_time_avg")


def _gap_by_day(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Mean gap for orders with times of day.

    Consecutive orders of one calendar day are less than 24 hours apart and add
    zero whole days, so only the first and last order of each day matter. Orders
    are reduced to one row per customer and day before any ordering: the window
    below sees at most one row per calendar day, however many orders a customer
    has.
    """
    days = orders.groupBy(KEY, F.col("order_date").cast("date").alias("day")).agg(
        F.min("order_date").alias("first"), F.max("order_date").alias("last"), F.count("*").alias("orders")
    )
    gap = whole_days(F.col("first"), F.lag("last").over(Window.partitionBy(KEY).orderBy("day")))
    return (
        days.withColumn("gap", gap)
        .groupBy(KEY)
        .agg(_mean_gap(F.sum("gap"), F.sum("orders"), cfg).alias("inter_purchase_time_avg"))
    )


def inter_purchase_time(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Mean whole days between consecutive orders of each customer.

    Customers with a single order get the churn window.
    """
    past = past_orders(orders, cfg)
    if cfg.orders_at_midnight:
        return past.groupBy(KEY).agg(_midnight_gap(cfg))
    return _gap_by_day(past, cfg)


def with_scores(base: DataFrame, cfg: RunConfig) -> DataFrame:
    """Add the three quantile scores and the segment to a stored base table.

    The rows at the bin edges are found exactly and compared as literals, so
    scoring is a projection: no sort and no shuffle of the customers.
    """
    bins = cfg.score_bins
    recency, frequency, monetary = (
        quantile_spec(name, F.col(name), bins) for name in ("recency", "frequency", "monetary")
    )
    cuts = rank_cuts(base, KEY, [recency, frequency, monetary])

    def quantile(spec) -> Column:
        return cuts_passed(spec, KEY, cuts[spec.name])

    return base.withColumns(
        {
            "R_score": F.lit(bins) - quantile(recency),
            "F_score": quantile(frequency) + F.lit(1),
            "M_score": quantile(monetary) + F.lit(1),
        }
    ).withColumn("rfm_segment", F.concat(*[F.col(c).cast("string") for c in ("R_score", "F_score", "M_score")]))


def rfm(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Recency, frequency and monetary features with quantile scores."""
    base = stage(customer_base(orders, cfg), "customer_base")
    return with_scores(base, cfg).select(*RFM_COLUMNS)


def _with_label(features: DataFrame, cfg: RunConfig) -> DataFrame:
    return features.withColumns(
        {
            "days_since_first_order": F.col("T"),
            "promo_dependency_ratio": F.lit(0.0),
            "churn_label": (F.col("recency") > F.lit(cfg.churn_window_days)).cast("int"),
        }
    ).select(*CHURN_COLUMNS)


def churn_features(orders: DataFrame, rfm_table: DataFrame, cfg: RunConfig) -> DataFrame:
    """Churn predictors and label on top of a given RFM table."""
    joined = rfm_table.join(order_value_stats(orders, cfg), KEY, "left")
    return _with_label(joined.join(inter_purchase_time(orders, cfg), KEY, "left"), cfg)


def customer_features(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """The churn feature table straight from orders.

    Same rows as :func:`churn_features` over :func:`rfm`, from one aggregate where
    orders are declared to be at midnight. Else the gaps are joined to it; both
    sides arrive hashed by customer, so the join itself moves nothing. The scores
    of the result are computed as it is read: store it before further operators.
    """
    past = past_orders(orders, cfg)
    aggregates = [*_purchase_totals(), *_value_stats()]
    if cfg.orders_at_midnight:
        totals = past.groupBy(KEY).agg(*aggregates, _midnight_gap(cfg))
    else:
        totals = past.groupBy(KEY).agg(*aggregates).join(_gap_by_day(past, cfg), KEY, "left")
    base = stage(with_ages(totals, cfg), "customer_features")
    return _with_label(with_scores(base, cfg), cfg)


def label_counts(features: DataFrame) -> DataFrame:
    """Churned and retained customers, with their share as text."""
    return (
        features.agg(F.sum("churn_label").cast("long").alias("churned"), F.count("*").alias("total"))
        .select(
            "total",
            F.explode(
                F.array(
                    F.struct(F.lit("churned").alias("status"), F.col("churned").alias("customers")),
                    F.struct(F.lit("retained").alias("status"), (F.col("total") - F.col("churned")).alias("customers")),
                )
            ).alias("entry"),
        )
        .select("entry.status", "entry.customers", (F.col("entry.customers") / F.col("total")).alias("share"))
    )


def top_segments(rfm_table: DataFrame, count: int = 5) -> DataFrame:
    """The largest segments; equal sizes are ordered by segment."""
    sizes = rfm_table.groupBy("rfm_segment").agg(F.count("*").alias("customers"))
    return sizes.orderBy(F.desc("customers"), "rfm_segment").limit(count)
