"""Explicit table schemas; checked where data enters."""

from __future__ import annotations

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("is_returned", T.IntegerType()),
    ]
)

ORDER_COLUMNS = ORDERS.fieldNames()
KEY_COLUMNS = ["customer_id", "order_id", "order_date", "revenue"]

# Names of the feature tables' columns, in their order.
RFM_COLUMNS = [
    "customer_id",
    "frequency",
    "monetary",
    "recency",
    "T",
    "avg_monetary",
    "R_score",
    "F_score",
    "M_score",
    "rfm_segment",
]

CHURN_COLUMNS = RFM_COLUMNS + [
    "avg_order_value",
    "std_order_value",
    "return_rate",
    "inter_purchase_time_avg",
    "days_since_first_order",
    "promo_dependency_ratio",
    "churn_label",
]

# Names of the value columns.
CLV_COLUMNS = ["predicted_purchases", "expected_avg_revenue", "clv_12m"]

# The classifier's inputs, in the order of the feature vector.
FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "R_score",
    "F_score",
    "M_score",
    "days_since_first_order",
    "avg_order_value",
    "std_order_value",
    "inter_purchase_time_avg",
    "return_rate",
]

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)
