"""The business table: renamed columns, risk bands and value tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import known, pounds_text, round_floats
from patronlens.operators.ranking import cuts_passed, quantile_spec, rank_cuts

# Output names, band limits and tier labels.
EXPORT_NAMES = {
    "customer_id": "Customer ID",
    "churn_prob": "Churn Risk Score",
    "clv_12m": "Predicted 12M Revenue",
    "rfm_segment": "RFM Segment",
    "recency": "Days Since Last Purchase",
    "frequency": "Total Orders",
    "monetary": "Total Revenue",
}
HIGH_RISK = 0.70
MEDIUM_RISK = 0.40
TIERS = ["Low Value", "Mid Value", "High Value"]


def risk_band(score: Column) -> Column:
    """High, Medium or Low; a missing score is Low."""
    score = known(score)
    return F.when(score >= HIGH_RISK, "High").when(score >= MEDIUM_RISK, "Medium").otherwise("Low")


def clv_tier(scored: DataFrame) -> Column:
    """Equal-size tiers of the lifetime value; a missing value has no tier."""
    spec = quantile_spec("clv_12m", F.col("clv_12m"), len(TIERS))
    place = cuts_passed(spec, "customer_id", rank_cuts(scored, "customer_id", [spec])["clv_12m"])
    return F.when(place.isNotNull(), F.element_at(F.array(*[F.lit(t) for t in TIERS]), place + F.lit(1)))


def export_customers(scored: DataFrame) -> DataFrame:
    """The export table; ``scored`` is read more than once and should be stored.

    Bands and tiers use the unrounded numbers; rounding comes last.
    """
    banded = scored.select(
        *EXPORT_NAMES,
        risk_band(F.col("churn_prob")).alias("Churn Risk Band"),
        clv_tier(scored).alias("CLV Tier"),
    )
    return round_floats(banded.withColumnsRenamed(EXPORT_NAMES))


def risk_band_counts(exported: DataFrame) -> DataFrame:
    """Customers per risk band, and in total."""
    counted = exported.rollup("Churn Risk Band").agg(F.count("*").alias("customers"))
    return counted.select(F.coalesce("Churn Risk Band", F.lit("Total")).alias("risk_band"), "customers")


def risk_band_revenue(exported: DataFrame) -> DataFrame:
    """Predicted revenue per risk band, as a number and as text."""
    summed = exported.groupBy(F.col("Churn Risk Band").alias("risk_band")).agg(
        F.sum(F.col("Predicted 12M Revenue")).alias("revenue")
    )
    return summed.withColumn("revenue_text", pounds_text(F.col("revenue")))


def clv_tier_counts(exported: DataFrame) -> DataFrame:
    """Customers per value tier."""
    return exported.groupBy(F.col("CLV Tier").alias("clv_tier")).agg(F.count("*").alias("customers"))
