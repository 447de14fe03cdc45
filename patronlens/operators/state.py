"""Order history as a state per customer that grows by parts, so a daily run reads the new orders only.

The state of a part has a row per customer: rows, money, known revenues with their mean and squared deviations, first and
last order, returns. Distinct orders cannot be added up, so they are kept as pairs of customer and order. States of
any parts of a history, disjoint or not in time, merge into the state of the whole: sums add up, and deviations by the rule
for two samples, applied to one part after the other. A merge has a row per customer and part, whatever the parts hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.config import RunConfig
from patronlens.functions.columns import known
from patronlens.operators.features import KEY, past_orders, with_ages

SUMS = ("order_rows", "monetary", "returned", "flagged")


@dataclass(frozen=True)
class HistoryState:
    """A row per customer, and the customers' distinct orders."""

    customers: DataFrame
    pairs: DataFrame


def part_state(orders: DataFrame, cfg: RunConfig) -> HistoryState:
    """State of some orders, up to the snapshot."""
    past = past_orders(orders, cfg)
    revenue = known(F.col("revenue"))
    customers = past.groupBy(KEY).agg(
        F.count("*").alias("order_rows"),
        F.coalesce(F.sum(revenue), F.lit(0.0)).alias("monetary"),
        F.coalesce(F.sum(F.col("is_returned").cast("double")), F.lit(0.0)).alias("returned"),
        F.count("is_returned").alias("flagged"),
        F.struct(
            F.count(revenue).cast("double").alias("n"),
            F.coalesce(F.avg(revenue), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop(revenue) * F.count(revenue), F.lit(0.0)).alias("squares"),
        ).alias("spread"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return HistoryState(customers, past.where(F.col("order_id").isNotNull()).select(KEY, "order_id").distinct())


def _both(one: Column, two: Column) -> Column:
    """Number, mean and squared deviations of two samples together."""
    n = one["n"] + two["n"]
    apart = two["mean"] - one["mean"]
    share = F.coalesce(F.try_divide(two["n"], n), F.lit(0.0))
    return F.struct(
        n.alias("n"),
        (one["mean"] + apart * share).alias("mean"),
        (one["squares"] + two["squares"] + apart * apart * one["n"] * share).alias("squares"),
    )


def merge(*states: HistoryState) -> HistoryState:
    """State of all parts together."""
    if not states:
        raise ValueError("no states to merge")
    numbered = [s.customers.withColumn("part", F.lit(k)) for k, s in enumerate(states)]
    rows = reduce(DataFrame.unionByName, numbered)
    nothing = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    # A row per part of a customer; their order is fixed, so the result does not depend on how rows arrive.
    parts = F.array_sort(F.collect_list(F.struct("part", "spread")))
    merged = rows.groupBy(KEY).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.aggregate(parts, nothing, lambda total, p: _both(total, p["spread"])).alias("spread"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    pairs = reduce(DataFrame.unionByName, [s.pairs for s in states]).distinct()
    return HistoryState(merged.select(*states[0].customers.columns), pairs)


def state_features(state: HistoryState, cfg: RunConfig) -> DataFrame:
    """Recency, frequency, money and order value figures from a state: those of the whole history."""
    frequency = state.pairs.groupBy(KEY).agg(F.count("*").alias("frequency"))
    n, squares = F.col("spread.n"), F.col("spread.squares")
    figures = state.customers.join(frequency, KEY, "left").withColumns(
        {
            "frequency": F.coalesce("frequency", F.lit(0)),
            "avg_order_value": F.when(n > 0, F.col("spread.mean")),
            "std_order_value": F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))).otherwise(F.lit(0.0)),
            "return_rate": F.try_divide(F.col("returned"), F.col("flagged")),
        }
    )
    return with_ages(figures, cfg).select(
        KEY, "frequency", "monetary", "recency", "T", "avg_monetary", "avg_order_value", "std_order_value", "return_rate"
    )
