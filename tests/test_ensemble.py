"""Given and fitted trees: margins after every round, areas, the best number of rounds, and lost rounds."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import by_key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_scoring import feature_rows, naive_metrics  # noqa: F401

from patronlens.config import ClassifierConfig
from patronlens.operators import attribution, classifier, ensemble, evaluation, splits
from patronlens.plans.catalog import TREE_FEATURES, fixed_trees
from patronlens.schemas import FEATURES
from patronlens.sources.staging import stage

INPUTS = [n for n in FEATURES if n not in ("recency", "R_score")]


def walk(nodes, values):
    node = nodes[0]
    while not node.is_leaf:
        node = nodes[node.left if values[node.feature] <= node.cut else node.right]
    return node.value


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.random() < 0.4), *map(float, (rng.integers(0, 500), rng.integers(1, 20), rng.integers(0, 3) * 1e6, 15e4))) for k in range(700)]
    # A value on a cut, a null, not a number, and infinities.
    rows += [(700, 1, 90.0, 8.0, 1e6, 15e4), (701, 0, None, 8.0, 1e6, 1.0), (702, 0, math.nan, math.inf, -math.inf, 0.0)]
    return stage(spark.createDataFrame(rows, "customer_id long, y int, " + ", ".join(f"{n} double" for n in TREE_FEATURES)).repartition(5), "trees_test")


def test_margins_equal_a_walk_down_each_tree(table):
    trees = fixed_trees()
    found = by_key(ensemble.margins(table, trees, TREE_FEATURES, "customer_id"))
    for row in table.collect():
        values = [math.nan if row[n] is None else row[n] for n in TREE_FEATURES]
        parts = [w * walk(t, values) for t, w in zip(trees.trees, trees.weights)]
        assert found[row["customer_id"]]["margins"] == np.cumsum(parts).tolist()


def test_areas_of_all_rounds_equal_all_pairs(table):
    trees = fixed_trees()
    margins = by_key(ensemble.margins(table, trees, TREE_FEATURES, "customer_id"))
    rows = table.collect()
    found = {r["round"]: r["auroc"] for r in ensemble.auroc_by_round(table, trees, TREE_FEATURES, "y").collect()}
    assert sorted(found) == [1, 2, 3]
    for k in found:
        expected, _ = naive_metrics([r["y"] for r in rows], [margins[r["customer_id"]]["margins"][k - 1] for r in rows])
        assert found[k] == pytest.approx(expected, abs=1e-12)
    one_class = ensemble.auroc_by_round(table.where("y = 1"), trees, TREE_FEATURES, "y").collect()
    assert [r["auroc"] for r in one_class] == [None] * 3
    assert ensemble.auroc_by_round(table.where("y = 7"), trees, TREE_FEATURES, "y").collect() == []


def test_areas_of_groups_over_many_slices(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(5_003)) / 7).alias("score"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) < 3).cast("long").alias("positives"),
    )
    df = stage(df.withColumn("negatives", 1 - F.col("positives")).groupBy("g", "score").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")), "areas_test")
    found = {r["g"]: r["auroc"] for r in evaluation.grouped_auroc(df, "g").collect()}
    for g in (0, 1, 2):
        rows = sorted((r["score"], r["positives"], r["negatives"]) for r in df.where(F.col("g") == g).collect())
        below = pairs = 0
        for _, p, n in rows:
            pairs += p * (2 * below + n)
            below += n
        assert found[g] == pytest.approx(pairs / (2 * below * sum(p for _, p, _ in rows)), abs=1e-14)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 8))
def test_best_prefix(areas, patience):
    kept, done = ensemble.best_prefix(areas, patience)
    best, since = 0, 0
    for k in range(1, len(areas)):
        if areas[k] > areas[best]:
            best, since = k, 0
        else:
            since += 1
        if since == patience:
            assert (kept, done) == (best + 1, True)
            return
    assert (kept, done) == (best + 1, False)


def test_contributions_of_given_trees_add_up(table):
    rows = table.where("customer_id < 50")
    margins = by_key(ensemble.margins(rows, fixed_trees(), TREE_FEATURES, "customer_id"))
    for key, row in by_key(attribution.ensemble_contributions(rows, fixed_trees(), TREE_FEATURES)).items():
        assert row["expected_margin"] + sum(row[n] for n in TREE_FEATURES) == pytest.approx(margins[key]["margins"][-1], abs=1e-12)


def test_untabled_paths_give_the_same(monkeypatch):
    leaves = ensemble.leaves_of(fixed_trees())
    values = np.random.default_rng(2).uniform(0, 1e6, (40, 4))
    tabled = attribution.shapley_values(values, leaves)
    monkeypatch.setattr(attribution, "TABLED_BYTES", 0)
    assert np.allclose(attribution.shapley_values(values, leaves), tabled, atol=1e-12)
    monkeypatch.setattr(attribution, "LEAVES", 2)
    monkeypatch.setattr(attribution, "CELLS", 8)
    assert np.allclose(attribution.shapley_values(values, leaves), tabled, atol=1e-12)


@pytest.fixture(scope="module")
def long_fit(spark, feature_rows, cfg):  # noqa: F811
    rows = stage(splits.stratified_split(feature_rows, cfg), "ensemble_split")
    train = rows.where(~F.col("is_test"))
    budget = ClassifierConfig(trees=12, depth=3, patience=3)
    return rows, train, budget, classifier.fit_classifier(train, cfg, budget, INPUTS)[0]


def test_fitted_nodes_give_the_models_margins(spark, long_fit):
    rows, _, _, model = long_fit
    trees = attribution.model_ensemble(spark, model)
    scored = model.transform(rows).select("customer_id", *[f"{n}_scaled" for n in INPUTS], vector_to_array("rawPrediction")[1].alias("raw"))
    found = by_key(ensemble.margins(scored, trees, [f"{n}_scaled" for n in INPUTS], "customer_id"))
    assert all(found[r["customer_id"]]["margins"][-1] == pytest.approx(r["raw"], abs=1e-9) for r in scored.collect())


def test_the_fit_keeps_the_best_rounds(spark, long_fit, cfg):
    """All rounds without a slice of validation begin with the same trees; the kept ones end at the best area."""
    rows, train, budget, model = long_fit
    from dataclasses import replace

    flagged = splits.stratified_split(stage(train, "ensemble_train"), replace(cfg, seed=cfg.seed + 1), budget.validation_share, "is_validation")
    scaled = model.stages[1].transform(model.stages[0].transform(flagged))
    weight = splits.class_weight(train).first()["scale_pos_weight"]
    learned = scaled.where(~F.col("is_validation")).withColumn("row_weight", F.when(F.col("churn_label") == 1, weight).otherwise(1.0))
    whole = classifier._trees(cfg, budget, 12).fit(learned)
    trees = ensemble.from_model(spark, whole, INPUTS)
    areas = [r["auroc"] for r in ensemble.auroc_by_round(scaled.where("is_validation"), trees, [f"{n}_scaled" for n in INPUTS], "churn_label").orderBy("round").collect()]
    kept, _ = ensemble.best_prefix(areas, 3)
    mine = attribution.model_ensemble(spark, model)
    assert len(mine.trees) == kept == model.stages[-1].getNumTrees and len(areas) == 12
    for one, two in zip(mine.trees, trees.trees):
        assert {k: (n.feature, n.left, n.right) for k, n in one.items()} == {k: (n.feature, n.left, n.right) for k, n in two.items()}


def test_cut_off_models_survive_storing(spark, long_fit, tmp_path):
    rows, _, _, model = long_fit
    short = ensemble.first_rounds(model.stages[-1], 1)
    assert short.getNumTrees == 1 and ensemble.first_rounds(short, 5) is short
    from pyspark.ml import PipelineModel

    cut = PipelineModel(stages=[*model.stages[:-1], short])
    classifier.save_model(cut, str(tmp_path / "m"))
    again = classifier.load_model(str(tmp_path / "m"))
    assert by_key(classifier.churn_scores(rows, again)) == by_key(classifier.churn_scores(rows, cut))
