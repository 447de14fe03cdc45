"""Splits, scaling, evaluation, classifier, attribution and export."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import by_key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronlens.config import ClassifierConfig, SyntheticSource
from patronlens.operators import attribution, classifier, evaluation, export, features, ranking, scaling, splits
from patronlens.schemas import FEATURES
from patronlens.sources.staging import stage
from patronlens.sources.synthetic import synthetic_orders


@pytest.fixture(scope="module")
def feature_rows(spark, cfg):
    orders = synthetic_orders(spark, SyntheticSource(6_000, 900), cfg)
    return stage(splits.model_rows(features.customer_features(orders, cfg)), "test_rows")


@pytest.fixture(scope="module")
def fitted(spark, feature_rows, cfg):
    rows = stage(splits.stratified_split(feature_rows, cfg), "test_split")
    inputs = [n for n in FEATURES if n not in ("recency", "R_score")]
    model, weight = classifier.fit_classifier(
        rows.where(~F.col("is_test")), cfg, ClassifierConfig(trees=6, depth=4), inputs
    )
    return rows, model, weight


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 5_000), st.integers(2, 5_000), st.floats(0.05, 0.5))
def test_stratified_counts(first, second, share):
    total = first + second
    try:
        test = splits.stratified_test_counts({0: first, 1: second}, share)
    except ValueError:
        assert math.ceil(total * share) < 2 or total - math.ceil(total * share) < 2
        return
    assert sum(test.values()) == math.ceil(total * share)
    for label, size in ((0, first), (1, second)):
        assert abs(test[label] - size * math.ceil(total * share) / total) <= 1


def test_stratified_split_is_exact_and_repeatable(feature_rows, cfg):
    def chosen(df, settings_):
        return {r["customer_id"] for r in splits.stratified_split(df, settings_).where("is_test").collect()}

    first = chosen(feature_rows, cfg)
    assert len(first) == math.ceil(feature_rows.count() * 0.2)
    assert chosen(feature_rows.repartition(13), cfg) == first
    assert chosen(feature_rows, replace(cfg, seed=7)) != first


def test_split_needs_both_classes(spark):
    with pytest.raises(ValueError, match="two rows"):
        splits.stratified_test_counts({0: 1, 1: 50}, 0.2)


def test_time_split_takes_the_most_recent(feature_rows, cfg):
    rows = splits.time_split(feature_rows, cfg).toPandas().sort_values(["recency", "customer_id"])
    wanted = int(len(rows) * 0.2)
    assert rows["is_time_test"].tolist() == [True] * wanted + [False] * (len(rows) - wanted)


def test_scaler_uses_population_deviation(feature_rows):
    scaler = scaling.fit_scaler(feature_rows)
    local = feature_rows.toPandas()[FEATURES].astype(float)
    out = scaler.transform(feature_rows).toPandas()[FEATURES]
    deviation = local.std(ddof=0).replace(0.0, 1.0)
    assert np.allclose(out, (local - local.mean()) / deviation)


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "a double")
    assert [r[0] for r in scaling.fit_scaler(df, ["a"]).transform(df).collect()] == [0.0, 0.0]


def naive_metrics(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    if pos and neg:
        auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        ks = max(abs(sum(p >= t for p in pos) / len(pos) - sum(n >= t for n in neg) / len(neg)) for t in scores)
        return auc, ks
    return None, 0.0


@pytest.mark.parametrize("case", range(5))
def test_ranking_metrics_against_all_pairs(spark, case):
    rng = np.random.default_rng(case)
    size = [1, 7, 60, 300, 40][case]
    scores = rng.integers(0, [2, 4, 10, 1000, 1][case], size) / 10.0
    labels = (rng.random(size) < [1.0, 0.5, 0.3, 0.7, 0.5][case]).astype(int)
    df = spark.createDataFrame(list(zip(range(size), labels.tolist(), scores.tolist())), "k long, y int, s double")
    row = evaluation.ranking_metrics(df, "y", "s").first()
    auc, ks = naive_metrics(labels.tolist(), scores.tolist())
    assert row["auroc"] == (None if auc is None else pytest.approx(auc, abs=1e-12))
    assert row["ks"] == pytest.approx(ks, abs=1e-12)


def test_precision_of_the_top(spark):
    rows = [(k, int(k % 3 == 0), 0.5 if k < 15 else 0.1) for k in range(25)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    row = evaluation.precision_at_top(df, "y", "s", "k", 0.2).first()
    assert tuple(row) == (5, 2 / 5)
    assert evaluation.precision_at_top(df.limit(3), "y", "s", "k").first()["top_rows"] == 1


def test_report_by_hand(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.6), (0, 0.2), (1, 0.7)]
    df = spark.createDataFrame(rows, "y int, s double")
    found = by_key(evaluation.classification_report(df, "y", "s"), "name")
    assert tuple(found["1"])[1:] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert tuple(found["0"])[1:] == pytest.approx((1 / 2, 1 / 2, 1 / 2, 2))
    assert found["accuracy"]["f1"] == pytest.approx(3 / 5)
    assert found["macro avg"]["recall"] == pytest.approx(7 / 12)
    assert found["weighted avg"]["precision"] == pytest.approx(0.6)
    only = by_key(evaluation.classification_report(df.where("y = 1 AND s > 0.5"), "y", "s"), "name")
    assert "0" not in only and only["macro avg"]["f1"] == 1.0


def test_model_survives_storing(spark, fitted, tmp_path):
    rows, model, _ = fitted
    classifier.save_model(model, str(tmp_path / "model"))
    again = classifier.load_model(str(tmp_path / "model"))
    assert by_key(classifier.churn_scores(rows, again)) == by_key(classifier.churn_scores(rows, model))


def test_scores_are_probabilities_and_rank_well(fitted):
    rows, model, weight = fitted
    counts = {r["churn_label"]: r["count"] for r in rows.where("NOT is_test").groupBy("churn_label").count().collect()}
    assert weight == pytest.approx(counts[0] / counts[1])
    scored = classifier.churn_scores(rows, model)
    low, high = scored.agg(F.min("churn_prob"), F.max("churn_prob")).first()
    assert 0 < low < high < 1
    assert evaluation.ranking_metrics(scored, "churn_label", "churn_prob").first()["auroc"] > 0.55


def test_contributions_add_up_to_the_margin(fitted):
    rows, model, _ = fitted
    names = attribution.model_features(model)
    parts = by_key(attribution.contributions(rows, model))
    for row in model.transform(rows).select("customer_id", "rawPrediction").collect():
        found = parts[row["customer_id"]]
        total = found["expected_margin"] + sum(found[n] for n in names)
        assert total == pytest.approx(row["rawPrediction"][1], abs=1e-9)


def test_contributions_against_all_feature_orders(fitted):
    """Shapley values by definition, from the value of every set of known features."""
    from itertools import combinations

    rows, model, _ = fitted
    leaves = attribution.ensemble_leaves(rows.sparkSession, model)
    names = attribution.model_features(model)
    scaled = model.stages[0].transform(rows.limit(3)).select(*[f"{n}_scaled" for n in names]).toPandas().to_numpy()
    found = attribution.shapley_values(scaled, leaves)

    def worth(values, known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for s in leaf.steps:
                part *= float(s.low < values[s.feature] <= s.high) if s.feature in known else s.share
            total += part
        return total

    n = len(names)
    for values, mine in zip(scaled, found):
        worths = {frozenset(c): worth(values, c) for k in range(n + 1) for c in combinations(range(n), k)}
        for i in range(n):
            expected = sum(
                math.factorial(len(s)) * math.factorial(n - 1 - len(s)) / math.factorial(n) * (worths[s | {i}] - w)
                for s, w in worths.items()
                if i not in s
            )
            assert mine[i] == pytest.approx(expected, abs=1e-9)


def test_attribution_table(fitted):
    rows, model, _ = fitted
    table = attribution.feature_attribution(rows, model).collect()
    assert [r["feature"] for r in table] == attribution.model_features(model)
    assert sum(r["split_importance"] for r in table) == pytest.approx(1.0)


def scored_table(spark, rows):
    schema = (
        "customer_id long, churn_prob double, clv_12m double, rfm_segment string, recency long, "
        "frequency long, monetary double"
    )
    return spark.createDataFrame([(i, p, v, "111", 1, 1, 2.675) for i, (p, v) in enumerate(rows)], schema)


def test_export_bands_tiers_and_rounding(spark):
    scores = [0.70, 0.699, 0.40, 0.399, None, float("nan"), 0.999]
    values = [1.0, None, 3.0, 3.0, 2.0, float("nan"), 9.0]
    out = by_key(export.export_customers(scored_table(spark, list(zip(scores, values)))), "Customer ID")
    assert [out[i]["Churn Risk Band"] for i in range(7)] == ["High", "Medium", "Medium", "Low", "Low", "Low", "High"]
    assert out[1]["Churn Risk Score"] == 0.7
    tiers = [out[i]["CLV Tier"] for i in range(7)]
    assert tiers == ["Low Value", None, "Mid Value", "High Value", "Low Value", None, "High Value"]
    assert out[0]["Total Revenue"] == 2.68
    assert list(out[0].asDict()) == [*export.EXPORT_NAMES.values(), "Churn Risk Band", "CLV Tier"]


def test_export_summaries(spark):
    out = stage(export.export_customers(scored_table(spark, [(0.9, 1000.0), (0.8, 500.5), (0.1, 2.0)])), "test_export")
    counts = {r["risk_band"]: r["customers"] for r in export.risk_band_counts(out).collect()}
    assert counts == {"High": 2, "Low": 1, "Total": 3}
    revenue = {r["risk_band"]: r["revenue_text"] for r in export.risk_band_revenue(out).collect()}
    assert revenue == {"High": "£1,500.50", "Low": "£2.00"}


def test_metrics_over_many_slices(spark):
    """Enough distinct scores for a sort in several slices."""
    df = spark.range(200_000).select(
        F.col("id").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(1_000_003.0)).alias("s"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3).cast("int").alias("y"),
    )
    row = evaluation.ranking_metrics(df, "y", "s").first()
    local = df.toPandas()
    ranks = local["s"].rank()
    p, n = int(local.y.sum()), int((1 - local.y).sum())
    assert row["auroc"] == pytest.approx((ranks[local.y == 1].sum() - p * (p + 1) / 2) / (p * n), abs=1e-12)
    ordered = ranking.ordered_rows(df.select("s", "k"), ["s", "k"], "test_slices")
    assert ordered.select(ranking.slice_of(F.col("position"))).distinct().count() > 1
