"""The churn classifier: boosted trees on scaled features, stored as one model."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.config import ClassifierConfig, RunConfig
from patronlens.operators.ensemble import auroc_by_round, best_prefix, first_rounds, from_model
from patronlens.operators.scaling import Scaler, fit_scaler
from patronlens.operators.splits import LABEL, class_weight, stratified_split
from patronlens.schemas import FEATURES
from patronlens.sources.staging import shared_folder, stage

SUFFIX = "_scaled"
VECTOR = "model_input"


def scaled_vector_stages(scaler: Scaler) -> list:
    """Scale as plain SQL and assemble the feature vector, in a fixed order."""
    scaled = ", ".join(scaler.sql_expressions(SUFFIX))
    return [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{n}{SUFFIX}" for n in scaler.means], outputCol=VECTOR),
    ]


def fit_classifier(
    train: DataFrame, cfg: RunConfig, budget: ClassifierConfig = ClassifierConfig(), features: list[str] = FEATURES
) -> tuple[PipelineModel, float]:
    """Fit scaler and trees on the train part; return model and class weight.

    Churned rows are weighted by retained / churned. A slice of the train part is
    held out, so the test part stays unseen: boosting goes on until
    ``budget.patience`` rounds bring no higher area under the slice's curve, and
    the rounds up to the best one are kept. Fits of twice as many rounds follow
    each other until one is long enough; as draws depend on the round alone, a
    longer fit begins with the rounds of a shorter one. Without a slice, or with
    one class in it, all rounds are kept. The
    label follows from recency; pass ``features`` without it for a model that
    does not see its own label.
    """
    scaler = fit_scaler(train, features)
    weight = class_weight(train).first()["scale_pos_weight"]
    if not weight:
        raise ValueError("the train part needs both churned and retained customers")
    rows = train.select("customer_id", LABEL, *features).withColumn(
        "row_weight", F.when(F.col(LABEL) == 1, F.lit(weight)).otherwise(F.lit(1.0))
    )
    watched = budget.validation_share > 0
    if watched:
        rows = stratified_split(rows, replace(cfg, seed=cfg.seed + 1), budget.validation_share, "is_validation")
    else:
        rows = rows.withColumn("is_validation", F.lit(False))
    shared_folder(train.sparkSession)
    scaled = PipelineModel(stages=scaled_vector_stages(scaler))
    rows = stage(scaled.transform(stage(rows, "train_rows")), "train_vectors")
    learned, held_out = rows.where(~F.col("is_validation")), rows.where("is_validation")
    rounds = min(budget.trees, 2 * budget.patience) if watched else budget.trees
    while True:
        model = _trees(cfg, budget, rounds).fit(learned)
        if not watched:
            break
        ensemble = from_model(train.sparkSession, model, features)
        areas = auroc_by_round(held_out, ensemble, [f"{n}{SUFFIX}" for n in features], LABEL).orderBy("round").collect()
        kept, done = best_prefix([r["auroc"] for r in areas], budget.patience)
        if done or model.getNumTrees < rounds or rounds == budget.trees:
            model = first_rounds(model, kept)
            break
        rounds = min(budget.trees, 2 * rounds)
    return PipelineModel(stages=[*scaled.stages, model]), weight


def _trees(cfg: RunConfig, budget: ClassifierConfig, rounds: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol=LABEL,
        weightCol="row_weight",
        maxIter=rounds,
        maxDepth=budget.depth,
        stepSize=budget.learning_rate,
        subsamplingRate=budget.row_share,
        featureSubsetStrategy=str(budget.feature_share),
        checkpointInterval=budget.checkpoint_interval,
        maxMemoryInMB=budget.max_memory_mb,
        seed=cfg.seed,
    )


def churn_scores(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """``rows`` with the probability of churn."""
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(rows).select(*rows.columns, probability.alias("churn_prob"))


def save_model(model: PipelineModel, path: str) -> None:
    """Replace the stored model at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A model stored by :func:`save_model`."""
    return PipelineModel.load(path)
