"""Feature attribution of the boosted trees (path-dependent Shapley values).

Every leaf of every tree gives each feature on its path a share of the leaf's
value (Lundberg et al. 2018). Rows are independent, so Spark maps over its
partitions; what travels to the tasks is the model's list of leaves, bounded by
trees times 2^depth.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.operators.classifier import SUFFIX
from patronlens.operators.ensemble import Ensemble, Leaf, from_model, leaves_of


def model_features(model: PipelineModel) -> list[str]:
    """The feature names of the model's vector, in order."""
    return [name.removesuffix(SUFFIX) for name in model.stages[1].getInputCols()]


def model_ensemble(spark: SparkSession, model: PipelineModel) -> Ensemble:
    """The trees of a fitted pipeline."""
    return from_model(spark, model.stages[-1], model_features(model))


def ensemble_leaves(spark: SparkSession, model: PipelineModel) -> list[Leaf]:
    """Leaves of all trees of a fitted pipeline."""
    return leaves_of(model_ensemble(spark, model))


def expected_margin(leaves: list[Leaf]) -> float:
    """The margin of a row about which nothing is known."""
    return sum(leaf.value * math.prod(step.share for step in leaf.steps) for leaf in leaves)


# Up to so many steps on a path, all outcomes of its tests are worked out beforehand, within so many bytes.
TABLED_STEPS = 10
TABLED_BYTES = 64_000_000
# Leaves handled at a time.
LEAVES = 512
# Rows times leaves handled at a time.
CELLS = 2_000_000


@dataclass(frozen=True)
class LeafGroup:
    """Leaves whose paths test equally many features, side by side: arrays of leaves by steps."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def credit(self, passed: np.ndarray) -> np.ndarray:
        """Contribution of each step, given which tests are passed (arrays of any rows by leaves by steps)."""
        count = self.feature.shape[1]
        order = [math.factorial(k) * math.factorial(count - 1 - k) / math.factorial(count) for k in range(count)]
        out = np.zeros(passed.shape)
        for i in range(count):
            # Coefficient k sums over the sets of k other features that are known.
            known = [np.ones(passed.shape[:-1])]
            for j in range(count):
                if j != i:
                    grown = [c * self.share[:, j] for c in known] + [np.zeros(passed.shape[:-1])]
                    for k, c in enumerate(known):
                        grown[k + 1] = grown[k + 1] + c * passed[..., j]
                    known = grown
            total = sum(weight * c for weight, c in zip(order, known))
            out[..., i] = self.value * (passed[..., i] - self.share[:, i]) * total
        return out

    def outcomes(self) -> np.ndarray:
        """``credit`` for every outcome of the tests: outcomes by leaves by steps. Bit j tells whether test j is passed."""
        count = self.feature.shape[1]
        bits = (np.arange(2**count)[:, None] >> np.arange(count)) & 1
        return self.credit(np.broadcast_to(bits[:, None, :].astype(float), (2**count, *self.feature.shape)))

    def part(self, start: int, stop: int) -> LeafGroup:
        return LeafGroup(*(getattr(self, f)[start:stop] for f in ("feature", "low", "high", "share", "value")))


def leaf_groups(leaves: list[Leaf]) -> list[LeafGroup]:
    """The leaves by the length of their paths; a tree of one leaf credits no feature."""
    by_length: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        by_length.setdefault(len(leaf.steps), []).append(leaf)
    return [
        LeafGroup(
            *(np.array([[getattr(s, name) for s in leaf.steps] for leaf in same]) for name in ("feature", "low", "high", "share")),
            np.array([leaf.value for leaf in same]),
        )
        for length, same in sorted(by_length.items())
        if length
    ]


class Attributor:
    """Contributions of many batches. What depends on the leaves alone is worked out once: their groups, and all outcomes
    of short paths while these take up to ``TABLED_BYTES``."""

    def __init__(self, leaves: list[Leaf]):
        self.parts: list[tuple[LeafGroup, np.ndarray | None]] = []
        left = TABLED_BYTES
        for group in leaf_groups(leaves):
            size, count = group.feature.shape
            for start in range(0, size, LEAVES):
                part = group.part(start, start + LEAVES)
                need = 8 * 2**count * part.feature.size
                tabled = count <= TABLED_STEPS and need <= left
                left -= need if tabled else 0
                self.parts.append((part, part.outcomes() if tabled else None))

    def values(self, values: np.ndarray) -> np.ndarray:
        """Contributions of one batch, rows by features."""
        result = np.zeros(values.shape)
        rows = max(1, CELLS // LEAVES)
        for start in range(0, len(values), rows):
            some = values[start : start + rows]
            for part, credit in self.parts:
                result[start : start + rows] += self._credits(some, part, credit)
        return result

    @staticmethod
    def _credits(values: np.ndarray, part: LeafGroup, credit: np.ndarray | None) -> np.ndarray:
        """Rows by features. For tabled paths a row's contributions are looked up by the tests it passes."""
        several, count = range(len(part.value)), part.feature.shape[1]
        tests = [
            (values[:, part.feature[:, j]] > part.low[:, j]) & (values[:, part.feature[:, j]] <= part.high[:, j])
            for j in range(count)
        ]
        if credit is not None:
            outcome = sum(test.astype(np.int64) << j for j, test in enumerate(tests))
            found = credit[outcome, several]
        else:
            found = part.credit(np.stack(tests, axis=-1).astype(float))
        result = np.zeros(values.shape)
        for j in range(count):
            owner = np.zeros((len(part.value), values.shape[1]))
            owner[several, part.feature[:, j]] = 1.0
            result += found[..., j] @ owner
        return result


def shapley_values(values: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Contributions of one batch, rows by features."""
    return Attributor(leaves).values(values)


def ensemble_contributions(rows: DataFrame, ensemble: Ensemble, columns: list[str], key: str = "customer_id") -> DataFrame:
    """Per row: the key, one contribution per feature, and the expected margin.

    Contributions and expected margin add up to the ensemble's margin. ``columns`` hold its features in order.
    """
    spark, features = rows.sparkSession, list(ensemble.features)
    leaves = leaves_of(ensemble)
    base = expected_margin(leaves)
    shipped = spark.sparkContext.broadcast(leaves)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attributor = Attributor(shipped.value)
        for batch in batches:
            out = pd.DataFrame(attributor.values(batch.iloc[:, 1:].to_numpy(dtype=float)), columns=features)
            out.insert(0, key, batch[key].to_numpy())
            out["expected_margin"] = base
            yield out

    fields = [T.StructField(key, rows.schema[key].dataType)]
    fields += [T.StructField(n, T.DoubleType()) for n in [*features, "expected_margin"]]
    return rows.select(key, *columns).mapInPandas(attribute, T.StructType(fields))


def contributions(rows: DataFrame, model: PipelineModel, key: str = "customer_id") -> DataFrame:
    """The same for a fitted pipeline, on rows with unscaled features."""
    ensemble = model_ensemble(rows.sparkSession, model)
    return ensemble_contributions(model.stages[0].transform(rows), ensemble, [f"{n}{SUFFIX}" for n in ensemble.features], key)


def feature_attribution(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Mean absolute contribution per feature, beside Spark's own importance."""
    return attribution_means(contributions(rows, model), model)


def attribution_means(parts: DataFrame, model: PipelineModel) -> DataFrame:
    """The same from given contributions."""
    features = model_features(model)
    importance = model.stages[-1].featureImportances
    means = parts.agg(*[F.avg(F.abs(F.col(n))).alias(n) for n in features])
    entries = [
        F.struct(
            F.lit(n).alias("feature"),
            F.col(n).alias("mean_abs_contribution"),
            F.lit(float(importance[i])).alias("split_importance"),
        )
        for i, n in enumerate(features)
    ]
    return means.select(F.inline(F.array(*entries)))
