"""The checked queries: every operator applied to whole test tables.

Two order histories are used. The star schema's orders fall on midnights and
carry a return flag from their line items; the purchase events carry times of
day, which the whole-day and snapshot rules depend on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.config import RunConfig
from patronlens.functions.columns import percent_text, round_half_even
from patronlens.operators import clv, ensemble, evaluation, export, features, quality, ranking, scaling, splits, state
from patronlens.operators.attribution import ensemble_contributions, feature_attribution
from patronlens.operators.classifier import churn_scores, fit_classifier
from patronlens.plans.runs import score_table
from patronlens.schemas import CLV_COLUMNS, FEATURES
from patronlens.sources import sinks
from patronlens.sources.orders import conform, orders_until
from patronlens.sources.staging import new_path, stage

STAR = RunConfig(snapshot="2001-01-01", orders_at_midnight=True)
EVENTS = RunConfig(snapshot="2024-01-25", churn_window_days=2, min_customers=10)

# Published parameter estimates (alpha turned from weeks to days).
LONG_HORIZON = 36_000.0
LONG_PARAMS = {
    "few_leave": {"r": 0.243, "alpha": 0.1, "a": 0.793, "b": 2.426},
    "many_leave": {"r": 0.243, "alpha": 0.1, "a": 1.7, "b": 2.426},
}
PURCHASE_PARAMS = {"r": 0.243, "alpha": 30.898, "a": 0.793, "b": 2.426}
VALUE_PARAMS = {"p": 6.25, "q": 3.74, "v": 15.44}

# Three given trees: tree, node, feature, cut, left, right, value, rows that reached the node. Values are multiples of
# a power of two, so their sums are exact in any order.
TREE_FEATURES = ["recency", "frequency", "monetary", "avg_order_value"]
TREE_WEIGHTS = [1.0, 0.5, 0.25]
TREE_NODES = [
    (0, 0, "recency", 90.0, 1, 2, 0.0, 1024.0),
    (0, 1, "frequency", 8.0, 3, 4, 0.0, 640.0),
    (0, 2, "recency", 400.0, 5, 6, 0.0, 384.0),
    (0, 3, None, 0.0, -1, -1, -0.25, 256.0),
    (0, 4, None, 0.0, -1, -1, -0.875, 384.0),
    (0, 5, "monetary", 1_000_000.0, 7, 8, 0.0, 256.0),
    (0, 6, None, 0.0, -1, -1, 0.9375, 128.0),
    (0, 7, None, 0.0, -1, -1, 0.625, 64.0),
    (0, 8, None, 0.0, -1, -1, 0.125, 192.0),
    (1, 0, "monetary", 1_500_000.0, 1, 2, 0.0, 1024.0),
    (1, 1, "avg_order_value", 150_000.0, 3, 4, 0.0, 512.0),
    (1, 2, None, 0.0, -1, -1, -0.5, 512.0),
    (1, 3, None, 0.0, -1, -1, 0.25, 128.0),
    (1, 4, None, 0.0, -1, -1, -0.125, 384.0),
    (2, 0, "frequency", 12.0, 1, 2, 0.0, 1024.0),
    (2, 1, "recency", 60.0, 3, 4, 0.0, 768.0),
    (2, 2, None, 0.0, -1, -1, -0.75, 256.0),
    (2, 3, None, 0.0, -1, -1, 0.0625, 256.0),
    (2, 4, None, 0.0, -1, -1, 0.375, 512.0),
]

Query = Callable[[SparkSession, str], DataFrame]


def star_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a return flag taken from their line items.

    Only returned lines are read, and they shrink to distinct order keys before
    they are exchanged. A query that does not use the flag drops the join.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    returned = (
        lines.where(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(F.lit(1).alias("returned"))
    )
    return conform(
        orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("revenue"),
            F.col("o_orderpriority").alias("channel"),
            F.coalesce("returned", F.lit(0)).alias("is_returned"),
        )
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as orders."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type") == "purchase")
    return conform(
        events.select(
            F.col("user_id").alias("customer_id"),
            F.col("event_id").alias("order_id"),
            F.col("ts").alias("order_date"),
            F.col("value").alias("revenue"),
            F.lit("event").alias("channel"),
            F.lit(0).alias("is_returned"),
        )
    )


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Wide integers, rounded doubles and text dates, for comparison by value.

    Lifetime values are products of long series and keep four digits.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.LongType)):
            column = column.cast("long")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            kept = min(digits, 4) if field.name in CLV_COLUMNS[1:] else digits
            column = round_half_even(column.cast("double"), kept)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.DateType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def star_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.customer_features(star_orders(spark, sf_dir), STAR)


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(star_features(spark, sf_dir), "churn_features")


def fixed_score(table: DataFrame) -> DataFrame:
    """A churn score without fitted parts, with ties: it grows with recency."""
    score = F.col("recency") / (F.col("recency") + F.lit(60.0) + F.lit(10) * F.col("frequency"))
    return table.withColumn("churn_prob", round_half_even(score, 6))


def fixed_clv(table: DataFrame) -> DataFrame:
    return clv.score_clv(table, PURCHASE_PARAMS, VALUE_PARAMS, STAR)


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides of the join come from this table, which lies by customer.
    table = stage(star_features(spark, sf_dir), "churn_features", "customer_id")
    return stage(score_table(fixed_score(splits.model_rows(table)), fixed_clv(table)), "scored_customers")


def exported_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.export_customers(scored_customers(spark, sf_dir))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(splits.stratified_split(splits.model_rows(stored_features(spark, sf_dir)), STAR), "split_rows")


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(spark, sf_dir).where(~F.col("is_test"))


# Scans, sources and sinks


def q_orders_until_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(orders_until(star_orders(spark, sf_dir), STAR))


def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings and metrics of a run with fixed scores, appended and read back."""
    scored = scored_customers(spark, sf_dir)
    value = clv.clv_summary(scored).first()
    rank = evaluation.ranking_metrics(scored, "churn_label", "churn_prob").first()
    top = evaluation.precision_at_top(scored, "churn_label", "churn_prob", "customer_id").first()
    clv_entries = [
        ("clv_model", "param", "horizon_months", STAR.horizon_months),
        ("clv_model", "metric", "mean_clv_12m", value["mean_clv_12m"]),
        ("clv_model", "metric", "median_clv_12m", value["median_clv_12m"]),
    ]
    churn_entries = [
        ("churn_model", "metric", "auroc", rank["auroc"]),
        ("churn_model", "metric", "ks_statistic", rank["ks"]),
        ("churn_model", "metric", "precision_at_top_decile", top["precision"]),
    ]
    path = new_path(spark, "run_metrics")
    for entries in (clv_entries, churn_entries):
        sinks.append_metrics(sinks.metric_rows(spark, "run", entries), path)
    return plain(spark.read.parquet(path).select("stage", "kind", "name", "value"), 4)


# Features


def q_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.rfm(star_orders(spark, sf_dir), STAR))


def q_rfm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.rfm(event_orders(spark, sf_dir), EVENTS))


def q_rfm_top_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.top_segments(features.rfm(star_orders(spark, sf_dir), STAR)))


def q_order_value_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.order_value_stats(star_orders(spark, sf_dir), STAR))


def q_inter_purchase_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.inter_purchase_time(star_orders(spark, sf_dir), STAR))


def q_inter_purchase_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(features.inter_purchase_time(event_orders(spark, sf_dir), EVENTS))


def q_churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star_features(spark, sf_dir))


def q_churn_features_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-step form: an RFM table first, churn predictors joined to it."""
    orders = event_orders(spark, sf_dir)
    return plain(features.churn_features(orders, features.rfm(orders, EVENTS), EVENTS))


def q_churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star_features(spark, sf_dir).select("customer_id", "recency", "churn_label"))


def q_churn_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = features.label_counts(star_features(spark, sf_dir))
    return plain(counts.withColumn("share_text", percent_text(F.col("share"))))


def q_leakage_invariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM after adding, for every order, a large copy dated after the snapshot."""
    orders = star_orders(spark, sf_dir)
    later = orders.withColumns(
        {
            "order_id": -F.col("order_id"),
            "order_date": F.col("order_date") + F.expr("INTERVAL '10' YEAR"),
            "revenue": F.col("revenue") * F.lit(100.0),
        }
    )
    return plain(features.rfm(orders.unionByName(later), STAR))


def q_features_from_daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the whole history from the merged states of three parts of it, which cut through customers and days."""
    orders = star_orders(spark, sf_dir)
    early = F.col("order_date") < F.lit("1997-01-01").cast("timestamp_ntz")
    odd = F.pmod(F.col("order_id"), F.lit(2)) == 1
    parts = [state.part_state(orders.where(w), STAR) for w in (early, ~early & odd, ~early & ~odd)]
    first = state.merge(*parts[:2])
    stored = state.HistoryState(stage(first.customers, "state"), stage(first.pairs, "state_pairs"))
    return plain(state.state_features(state.merge(stored, parts[2]), STAR))


# Quality


def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(quality.validation_report(star_orders(spark, sf_dir), STAR))


def q_validation_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(quality.validation_report(event_orders(spark, sf_dir), EVENTS))


def q_validation_report_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, counted while the orders are stored."""
    orders, told = quality.watched(star_orders(spark, sf_dir), STAR)
    return plain(quality.observed_report(told, stage(orders, "observed_orders"), STAR))


def q_future_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(quality.future_rows(star_orders(spark, sf_dir), STAR))


def q_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(quality.table_summary(star_orders(spark, sf_dir)))


def q_orders_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(quality.orders_profile(star_orders(spark, sf_dir)))


# Ranks


def q_global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's rank by price, then by key."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    return plain(ranking.global_rank(orders, ["o_totalprice", "o_orderkey"], "price_rank"))


# Lifetime value


def q_clv_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = clv.clv_inputs(features.rfm(star_orders(spark, sf_dir), STAR))
    return plain(inputs.select("customer_id", "repeat_purchases", "age_at_last_purchase", "T"))


def q_bgnbd_expected_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fixed_clv(features.rfm(star_orders(spark, sf_dir), STAR))
    return plain(scored.select("customer_id", "predicted_purchases"))


def q_gg_expected_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fixed_clv(features.rfm(star_orders(spark, sf_dir), STAR))
    return plain(scored.select("customer_id", "expected_avg_revenue"))


def q_clv_fixed_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fixed_clv(features.rfm(star_orders(spark, sf_dir), STAR)))


def q_clv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stage(fixed_clv(features.rfm(star_orders(spark, sf_dir), STAR)), "clv_scores")
    return plain(clv.clv_summary(scored), 4)


def q_bgnbd_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood at the fixed parameters, summed over the customers."""
    rows = stage(clv.purchase_histories(features.rfm(star_orders(spark, sf_dir), STAR)), "purchase_histories")
    sums = clv.purchase_terms(rows, PURCHASE_PARAMS)
    return plain(sums.select(F.col("t").alias("log_likelihood"), F.col("customers").alias("rows")), 4)


def q_gg_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(clv.repeat_values(features.rfm(star_orders(spark, sf_dir), STAR)), "repeat_values")
    sums = clv.value_terms(rows, VALUE_PARAMS)
    return plain(sums.select(F.col("t").alias("log_likelihood"), F.col("customers").alias("rows")), 4)


def q_bgnbd_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean slopes of the log-likelihood at the fixed parameters."""
    rows = stage(clv.purchase_histories(features.rfm(star_orders(spark, sf_dir), STAR)), "purchase_histories")
    sums = clv.purchase_terms(rows, PURCHASE_PARAMS)
    slopes = [(F.col(f"t{i}") / F.col("customers")).alias(f"by_{n}") for i, n in enumerate(clv.PURCHASE_PARAMETERS)]
    return plain(sums.select(*slopes), 5)


def q_gg_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(clv.repeat_values(features.rfm(star_orders(spark, sf_dir), STAR)), "repeat_values")
    sums = clv.value_terms(rows, VALUE_PARAMS)
    slopes = [(F.col(f"t{i}") / F.col("customers")).alias(f"by_{n}") for i, n in enumerate(clv.VALUE_PARAMETERS)]
    return plain(sums.select(*slopes), 5)


def q_bgnbd_purchases_long_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases while active of every history over a century, where the series has its argument near one."""
    pairs = clv.clv_inputs(features.rfm(star_orders(spark, sf_dir), STAR)).select("repeat_purchases", "T").distinct()
    x, age = F.col("repeat_purchases").cast("double"), F.col("T").cast("double")
    return plain(
        pairs.select(
            "repeat_purchases",
            "T",
            *[clv.purchases_while_active(p, LONG_HORIZON, x, age).alias(n) for n, p in LONG_PARAMS.items()],
        ),
        3,
    )


def significant(value: Column) -> Column:
    """Four significant digits, three behind the point at most."""
    scale = F.pow(F.lit(10.0), F.lit(3) - F.floor(F.log10(F.greatest(value, F.lit(1.0)))))
    return F.when(value.isNotNull(), F.bround(value * scale) / scale)


def _parameters(spark: SparkSession, model: str, fit: clv.Fit) -> DataFrame:
    table = sinks.parameter_table(spark, model, fit.params, fit.errors)
    return table.select("model", "name", *[significant(F.col(c)).alias(c) for c in ("value", "standard_error")])


def q_bgnbd_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted parameters of the purchase model with their standard errors."""
    return _parameters(spark, "purchases", clv.fit_purchase_model(features.rfm(star_orders(spark, sf_dir), STAR), STAR))


def q_gg_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted parameters of the value model with their standard errors."""
    return _parameters(spark, "values", clv.fit_value_model(features.rfm(star_orders(spark, sf_dir), STAR), STAR))


# Splits and scaling


def q_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.model_rows(stored_features(spark, sf_dir))
    return plain(rows.select("customer_id", *FEATURES, "churn_label"))


def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(split_rows(spark, sf_dir).select("customer_id", "churn_label", "is_test"))


def q_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.model_rows(stored_features(spark, sf_dir))
    return plain(splits.time_split(rows, STAR).select("customer_id", "recency", "is_time_test"))


def q_class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(splits.class_weight(train_rows(spark, sf_dir)))


def q_scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(scaling.scaler_stats(train_rows(spark, sf_dir)))


def q_scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    scaler = scaling.fit_scaler(rows.where(~F.col("is_test")))
    return plain(scaler.transform(rows).select("customer_id", *FEATURES))


# Evaluation


def q_auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(evaluation.auroc(scored_customers(spark, sf_dir), "churn_label", "churn_prob"))


def q_ks_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(evaluation.ks_statistic(scored_customers(spark, sf_dir), "churn_label", "churn_prob"))


def q_precision_top_decile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_customers(spark, sf_dir)
    return plain(evaluation.precision_at_top(scored, "churn_label", "churn_prob", "customer_id"))


def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(evaluation.classification_report(scored_customers(spark, sf_dir), "churn_label", "churn_prob"))


# Classifier


def q_churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    model, _ = fit_classifier(rows.where(~F.col("is_test")), STAR)
    return churn_scores(rows, model).select("customer_id", "churn_label", "is_test", "churn_prob")


def q_feature_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    model, _ = fit_classifier(rows.where(~F.col("is_test")), STAR)
    return feature_attribution(rows.where("is_test"), model)


def fixed_trees() -> ensemble.Ensemble:
    return ensemble.from_rows(TREE_FEATURES, TREE_WEIGHTS, TREE_NODES)


def q_fixed_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margins of given trees after every round, and the probability of churn."""
    found = ensemble.margins(star_features(spark, sf_dir), fixed_trees(), TREE_FEATURES, "customer_id")
    each = [F.col("margins")[k] for k in range(len(TREE_WEIGHTS))]
    named = [m.alias(f"margin_{k + 1}") for k, m in enumerate(each)]
    return plain(found.select("customer_id", *named, ensemble.probability(each[-1]).alias("churn_prob")))


def q_fixed_tree_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contribution of every feature to the margin of given trees."""
    return plain(ensemble_contributions(star_features(spark, sf_dir), fixed_trees(), TREE_FEATURES))


def q_auroc_by_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve of given trees, cut off after every round."""
    return plain(ensemble.auroc_by_round(star_features(spark, sf_dir), fixed_trees(), TREE_FEATURES, "churn_label"))


# Scores and export


def q_scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(scored_customers(spark, sf_dir))


def q_export_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(exported_customers(spark, sf_dir), 2)


def q_risk_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(export.risk_band_counts(exported_customers(spark, sf_dir)))


def q_risk_band_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(export.risk_band_revenue(exported_customers(spark, sf_dir)), 2)


def q_clv_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(export.clv_tier_counts(exported_customers(spark, sf_dir)))


def queries() -> dict[str, Query]:
    """Every query by name."""
    return {name.removeprefix("q_"): f for name, f in globals().items() if name.startswith("q_")}
