"""Boosted trees as a table of nodes: outputs, margins after every round, the best number of rounds, paths to leaves.

An ensemble is as large as its trees times 2^depth, whatever the table it is applied to, so it travels to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.operators.evaluation import grouped_auroc
from patronlens.sources.staging import new_path

# Rows times trees handled at a time.
CELLS = 2_000_000


@dataclass(frozen=True)
class Node:
    """A test ``feature <= cut`` with its two children, or a leaf (feature -1) with its value."""

    feature: int
    cut: float
    left: int
    right: int
    value: float
    cover: float

    @property
    def is_leaf(self) -> bool:
        return self.feature < 0


@dataclass(frozen=True)
class Ensemble:
    """Trees as nodes by their number, the weight of each tree, and the features in the order in which they are numbered."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    trees: tuple[dict[int, Node], ...]

    def first(self, rounds: int) -> Ensemble:
        return Ensemble(self.features, self.weights[:rounds], self.trees[:rounds])


@dataclass(frozen=True)
class PathStep:
    """All tests of one feature on a path: low < value <= high, and the share of
    training rows that pass them, given the other tests."""

    feature: int
    low: float
    high: float
    share: float


@dataclass(frozen=True)
class Leaf:
    """A leaf's weighted value and the features on its path."""

    value: float
    steps: tuple[PathStep, ...]


def from_rows(features: Sequence[str], weights: Sequence[float], rows: Sequence[tuple]) -> Ensemble:
    """An ensemble from (tree, node, feature name or None, cut, left, right, value, cover)."""
    trees: dict[int, dict[int, Node]] = {}
    for tree, node, feature, cut, left, right, value, cover in rows:
        place = -1 if feature is None else list(features).index(feature)
        trees.setdefault(tree, {})[node] = Node(place, cut, left, right, value, cover)
    return Ensemble(tuple(features), tuple(weights), tuple(trees[t] for t in sorted(trees)))


def from_model(spark: SparkSession, model: GBTClassificationModel, features: Sequence[str]) -> Ensemble:
    """The trees of a fitted model, read from the node table that Spark stores with it."""
    path = new_path(spark, "trees")
    model.write().overwrite().save(path)
    trees: list[dict[int, Node]] = [{} for _ in model.treeWeights]
    for row in spark.read.parquet(f"{path}/data").collect():
        n, split = row["nodeData"], row["nodeData"]["split"]
        leaf = n["leftChild"] < 0
        trees[row["treeID"]][n["id"]] = Node(
            -1 if leaf else split["featureIndex"],
            math.nan if leaf else split["leftCategoriesOrThreshold"][0],
            n["leftChild"],
            n["rightChild"],
            n["prediction"],
            n["impurityStats"][0],
        )
    return Ensemble(tuple(features), tuple(model.treeWeights), tuple(trees))


def leaves_of(ensemble: Ensemble) -> list[Leaf]:
    """Leaves of all trees; tests of one feature on a path are one step."""
    found = []
    for nodes, weight in zip(ensemble.trees, ensemble.weights, strict=True):
        pending: list[tuple[Node, dict[int, PathStep]]] = [(nodes[0], {})]
        while pending:
            node, steps = pending.pop()
            if node.is_leaf:
                found.append(Leaf(weight * node.value, tuple(steps.values())))
                continue
            seen = steps.get(node.feature, PathStep(node.feature, -math.inf, math.inf, 1.0))
            for child, low, high in (
                (nodes[node.left], seen.low, min(seen.high, node.cut)),
                (nodes[node.right], max(seen.low, node.cut), seen.high),
            ):
                share = seen.share * child.cover / node.cover
                pending.append((child, {**steps, node.feature: PathStep(node.feature, low, high, share)}))
    return found


class Packed:
    """All trees side by side in arrays. A leaf is its own child, so every row may take as many steps as the deepest needs."""

    def __init__(self, ensemble: Ensemble):
        shape = len(ensemble.trees), max((len(t) for t in ensemble.trees), default=1)
        self.feature, self.cut = np.zeros(shape, np.int64), np.full(shape, np.inf)
        self.left, self.right = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.value, self.depth = np.zeros(shape), 0
        for t, (nodes, weight) in enumerate(zip(ensemble.trees, ensemble.weights, strict=True)):
            place = {name: k for k, name in enumerate(sorted(nodes, key=lambda name: (name != 0, name)))}
            level = {0: 0}
            for name in sorted(nodes):
                node, k = nodes[name], place[name]
                if node.is_leaf:
                    self.left[t, k] = self.right[t, k] = k
                    self.value[t, k] = weight * node.value
                    continue
                self.feature[t, k], self.cut[t, k] = node.feature, node.cut
                self.left[t, k], self.right[t, k] = place[node.left], place[node.right]
                level[node.left] = level[node.right] = level.get(name, 0) + 1
            self.depth = max(self.depth, *level.values())

    def outputs(self, values: np.ndarray) -> np.ndarray:
        """Weighted value of the leaf each row reaches: rows by trees."""
        trees = np.arange(self.feature.shape[0])
        at = np.zeros((len(values), len(trees)), np.int64)
        row = np.arange(len(values))[:, None]
        for _ in range(self.depth):
            passed = values[row, self.feature[trees, at]] <= self.cut[trees, at]
            at = np.where(passed, self.left[trees, at], self.right[trees, at])
        return self.value[trees, at]

    def margins(self, values: np.ndarray) -> Iterator[np.ndarray]:
        """Margins after every round, rows by rounds, for some rows at a time."""
        step = max(1, CELLS // max(1, len(self.feature)))
        for start in range(0, len(values), step):
            yield np.cumsum(self.outputs(values[start : start + step]), axis=1)


def _values(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """Columns of a batch as a matrix; null is not a number and goes right at every test."""
    arrays = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in columns]
    return np.column_stack([a.astype(float) for a in arrays]) if arrays else np.zeros((batch.num_rows, 0))


def margins(rows: DataFrame, ensemble: Ensemble, columns: Sequence[str], key: str) -> DataFrame:
    """Per row: key and ``margins``, the margin after every round. ``columns`` hold the ensemble's features in order."""
    shipped = rows.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packed(shipped.value)
        for batch in batches:
            at = 0
            for part in packed.margins(_values(batch, columns)):
                ends = np.arange(0, part.size + 1, part.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), lists], [key, "margins"])
                at += len(part)

    fields = [T.StructField(key, rows.schema[key].dataType), T.StructField("margins", T.ArrayType(T.DoubleType()))]
    return rows.select(key, *columns).mapInArrow(run, T.StructType(fields))


def probability(margin):
    """Probability of class 1 from a margin."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def auroc_by_round(rows: DataFrame, ensemble: Ensemble, columns: Sequence[str], label: str) -> DataFrame:
    """``round`` (from 1) and exact ``auroc`` of the ensemble cut off after it; null without both classes.

    One pass over the rows gives the margins after every round. Tasks count rows per round and distinct margin, and the
    areas of all rounds come from one global sort of these counts.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(ensemble)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packed(shipped.value)
        for batch in batches:
            churned = _values(batch, [label])[:, 0] == 1
            at = 0
            for part in packed.margins(_values(batch, columns)):
                mine = churned[at : at + len(part)]
                at += len(part)
                for k in range(part.shape[1]):
                    scores, which = np.unique(part[:, k], return_inverse=True)
                    positives = np.bincount(which, mine, len(scores)).astype(np.int64)
                    every = np.bincount(which, minlength=len(scores))
                    found = [np.full(len(scores), k + 1), scores, positives, every - positives]
                    yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["round", "score", "positives", "negatives"])

    each = rows.select(label, *columns).mapInArrow(run, "round long, score double, positives long, negatives long")
    counts = each.groupBy("round", "score").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    return grouped_auroc(counts, "round")


def best_prefix(areas: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """How many rounds to keep, and whether ``patience`` rounds after them brought no gain. Without areas, all."""
    if not areas or areas[0] is None:
        return len(areas), False
    best = 0
    for k, area in enumerate(areas):
        if area > areas[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model cut off after some rounds."""
    if rounds >= model.getNumTrees:
        return model
    gateway, java = SparkContext._gateway, model._java_obj
    jvm = gateway.jvm
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = java.trees()[k], float(model.treeWeights[k])
    kept = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), 2)
    return GBTClassificationModel(kept).setFeaturesCol(model.getFeaturesCol())
