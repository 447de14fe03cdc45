"""Generated orders for development and tests, built row by row on executors.

Every value is a function of the order id, the seed and nothing else, so the
table does not depend on the number of partitions, and a retried task produces
the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.config import RunConfig, SyntheticSource
from patronlens.functions.columns import round_half_even, snapshot_ts

# The shape of the generated table.
CHANNELS = ["email", "organic", "paid_search", "social"]
YEARS = 3
REVENUE_MEAN = 45.0
REVENUE_STD = 30.0
RETURN_SHARE = 0.05


def uniform(order_id: Column, salt: str, part: int) -> Column:
    """A uniform number in [0, 1) from eight hex digits of a salted hash."""
    digest = F.md5(F.concat(order_id.cast("string"), F.lit(f"-{salt}")))
    digits = F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10)
    return digits.cast("double") / F.lit(float(2**32))


def with_order_values(ids: DataFrame, customers: int, cfg: RunConfig) -> DataFrame:
    """Add the five generated columns to a table of order ids."""
    key = F.col("order_id")
    first, second = f"{cfg.seed}a", f"{cfg.seed}b"
    last_day = snapshot_ts(cfg.snapshot).cast("date")
    first_day = F.add_months(last_day, -12 * YEARS)
    days = F.date_diff(last_day, first_day)
    variance = math.log(1.0 + (REVENUE_STD / REVENUE_MEAN) ** 2)
    location = math.log(REVENUE_MEAN) - 0.5 * variance
    normal = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(key, second, 0))) * F.cos(
        F.lit(2.0 * math.pi) * uniform(key, second, 1)
    )
    channel = F.floor(uniform(key, second, 2) * F.lit(float(len(CHANNELS)))).cast("int")
    return ids.select(
        (F.floor(uniform(key, first, 0) * F.lit(float(customers))) + F.lit(1)).cast("long").alias("customer_id"),
        key.cast("long").alias("order_id"),
        F.date_add(first_day, F.floor(uniform(key, first, 1) * (days + F.lit(1))).cast("int"))
        .cast("timestamp_ntz")
        .alias("order_date"),
        round_half_even(F.exp(F.lit(location) + F.lit(math.sqrt(variance)) * normal)).alias("revenue"),
        F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), channel + F.lit(1)).alias("channel"),
        (uniform(key, first, 2) < F.lit(RETURN_SHARE)).cast("int").alias("is_returned"),
    )


def synthetic_orders(spark: SparkSession, size: SyntheticSource, cfg: RunConfig) -> DataFrame:
    """``size.orders`` generated orders with ids from 1."""
    ids = spark.range(1, size.orders + 1, numPartitions=size.partitions).withColumnRenamed("id", "order_id")
    return with_order_values(ids, size.customers, cfg)
