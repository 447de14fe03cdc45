"""The stages of a run, the full run and retraining.

Every stage reads stored tables and stores its own, so a failed run can be picked
up at any stage and an external scheduler may call the stages one by one. The
order is that of ``STAGES``: the churn stage joins the value scores, so the value
stage comes before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.config import ClassifierConfig, JdbcSource, RunConfig, SyntheticSource
from patronlens.operators import clv, evaluation, features, quality
from patronlens.operators.attribution import attribution_means, contributions
from patronlens.operators.classifier import churn_scores, fit_classifier, save_model
from patronlens.operators.export import export_customers
from patronlens.operators.splits import KEY, LABEL, model_rows, stratified_split, time_split
from patronlens.schemas import FEATURES
from patronlens.sources import sinks, versions
from patronlens.sources.orders import read_orders
from patronlens.sources.staging import scope, stage

# What the classifier learns from: the rest of the random split, or of the split by time.
FIT_PARTS = ("random", "time")


@dataclass(frozen=True)
class Run:
    """One run: where its tables are, what it reads, and its settings."""

    spark: SparkSession
    root: str
    source: JdbcSource | SyntheticSource | str | None = None
    cfg: RunConfig = RunConfig()
    budget: ClassifierConfig = ClassifierConfig()
    inputs: list[str] = field(default_factory=lambda: list(FEATURES))
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    fit_part: str = FIT_PARTS[0]

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        """The latest committed version of a table."""
        if versions.current(self.spark, self.path(name)) is None:
            return self.spark.read.parquet(self.path(name))
        return versions.read(self.spark, self.path(name))

    def write(self, df: DataFrame, name: str, key: str = "") -> DataFrame:
        """Store a table as its next version, committed when it is complete, and return it as read back.

        Tables of customers are stored by ``key``, so later stages join them without a shuffle.
        """
        versions.publish(df, self.path(name), self.run_id, key=key)
        return self.read(name)

    def finished(self, stage_name: str) -> bool:
        """Whether this run (by its id) has ended a stage."""
        told = versions.current(self.spark, self.path(f"_stages/{self.run_id}/{stage_name}"))
        return told is not None

    def finish(self, stage_name: str) -> None:
        """Note that a stage has ended; the last thing it does."""
        note = self.spark.createDataFrame([(stage_name,)], "stage string").coalesce(1)
        versions.publish(note, self.path(f"_stages/{self.run_id}/{stage_name}"), self.run_id)

    def log(self, stage_name: str, kind: str, values: dict[str, float | None]) -> None:
        """Append settings or metrics to the run table."""
        rows = [(stage_name, kind, name, value) for name, value in values.items()]
        sinks.append_metrics(sinks.metric_rows(self.spark, self.run_id, rows), self.path("run_metrics"))


def score_table(features_table: DataFrame, clv_table: DataFrame) -> DataFrame:
    """Churn scores with the value columns; a customer without one keeps nulls."""
    return features_table.join(clv.clv_columns(clv_table), KEY, "left")


def ingest(run: Run) -> DataFrame:
    """Land the orders; the checks are counted in the same pass and stored with them."""
    orders, told = quality.watched(read_orders(run.spark, run.source, run.cfg), run.cfg)
    stored = run.write(orders, "orders")
    run.write(quality.observed_report(told, stored, run.cfg).coalesce(1), "validation_report")
    return stored


def validate(run: Run) -> None:
    """Raise if a check of the landed orders failed. Orders that another program has put there are read and checked."""
    orders, report = (versions.current(run.spark, run.path(n)) for n in ("orders", "validation_report"))
    if orders and report and orders.run_id == report.run_id:
        quality.enforce(run.read("validation_report"))
    else:
        quality.run_validation(run.read("orders"), run.cfg)


def build_features(run: Run) -> DataFrame:
    """The churn feature table and, as its first columns, the RFM table."""
    table = run.write(features.customer_features(run.read("orders"), run.cfg), "churn_features", KEY)
    run.write(table.select(*features.RFM_COLUMNS), "rfm", KEY)
    return table


def fit_values(run: Run) -> DataFrame:
    """Fit both value models, store parameters and metrics, score everybody."""
    rfm_table = run.read("rfm")
    purchase = clv.fit_purchase_model(rfm_table, run.cfg)
    value = clv.fit_value_model(rfm_table, run.cfg)
    parameters = sinks.parameter_table(run.spark, "purchases", purchase.params, purchase.errors).unionByName(
        sinks.parameter_table(run.spark, "values", value.params, value.errors)
    )
    run.write(parameters.coalesce(1), "clv_parameters")
    scored = run.write(clv.score_clv(rfm_table, purchase.params, value.params, run.cfg), "clv_scores", KEY)
    settings = {"penalizer_coef": run.cfg.penalizer, "horizon_months": run.cfg.horizon_months}
    fitted = {f"purchases_{n}": v for n, v in purchase.params.items()}
    fitted |= {f"values_{n}": v for n, v in value.params.items()}
    run.log("clv_model", "param", settings | fitted)
    run.log("clv_model", "metric", clv.clv_summary(scored).first().asDict())
    return scored


def fit_churn(run: Run) -> DataFrame:
    """Train, evaluate on both test parts, explain, store the model and scores.

    With ``fit_part="time"`` no row of the time test part is learned from, so that part is an honest test.
    """
    # Both flags are comparisons with a few literals, so they are added as the rows are read.
    rows = time_split(stratified_split(model_rows(run.read("churn_features")), run.cfg), run.cfg)
    held_out = "is_time_test" if run.fit_part == "time" else "is_test"
    model, weight = fit_classifier(rows.where(~F.col(held_out)), run.cfg, run.budget, run.inputs)
    save_model(model, run.path("churn_model"))

    scored = stage(churn_scores(rows, model), "churn_scores", KEY)
    tested = {
        flag: stage(scored.where(flag).select(KEY, LABEL, "churn_prob"), flag) for flag in ("is_test", "is_time_test")
    }
    by_random, by_time = (evaluation.ranking_metrics(t, LABEL, "churn_prob").first() for t in tested.values())
    top = evaluation.precision_at_top(tested["is_test"], LABEL, "churn_prob", KEY, run.cfg.top_share).first()
    run.write(evaluation.classification_report(tested["is_test"], LABEL, "churn_prob"), "classification_report")
    parts = run.write(contributions(rows.where("is_test"), model), "customer_contributions")
    run.write(attribution_means(parts, model), "feature_attribution")
    settings = {
        "trees": run.budget.trees,
        "trees_kept": model.stages[-1].getNumTrees,
        "depth": run.budget.depth,
        "learning_rate": run.budget.learning_rate,
        "row_share": run.budget.row_share,
        "feature_share": run.budget.feature_share,
        "class_weight": round(weight, 4),
        "fitted_on_time_part": float(run.fit_part == "time"),
    }
    metrics = {
        "auroc_random_split": by_random["auroc"],
        "auroc_time_split": by_time["auroc"],
        "ks_statistic": by_random["ks"],
        "precision_at_top_decile": top["precision"],
    }
    run.log("churn_model", "param", settings)
    run.log("churn_model", "metric", metrics)
    scores = scored.drop("is_test", "is_time_test")
    return run.write(score_table(scores, run.read("clv_scores")), "scored_customers", KEY)


def export(run: Run) -> DataFrame:
    """The business table, as Parquet and CSV."""
    exported = run.write(export_customers(run.read("scored_customers")), "customers")
    sinks.write_csv(exported, run.path("customers_csv"))
    return exported


STAGES: dict[str, Callable[[Run], DataFrame | None]] = {
    "ingest": ingest,
    "validate": validate,
    "features": build_features,
    "values": fit_values,
    "churn": fit_churn,
    "export": export,
}


def perform(run: Run, names: Iterable[str], resume: bool = False) -> DataFrame | None:
    """The named stages in order; returns the last one's table.

    Intermediate tables are removed after each stage, whether it ends well or not: only named tables stay. With
    ``resume``, stages that a run with this id has ended are left out; nothing is returned if that is all of them.
    """
    result = None
    for name in names:
        if resume and run.finished(name):
            continue
        with scope(run.spark):
            result = STAGES[name](run)
        run.finish(name)
    return result


def train(run: Run) -> DataFrame:
    """Fit both models again from the stored feature tables."""
    return perform(run, ["values", "churn"])


def run_all(run: Run, resume: bool = False) -> DataFrame:
    """All stages in order, or those that are left of a run that failed; returns the business table."""
    perform(run, STAGES, resume)
    return run.read("customers")
