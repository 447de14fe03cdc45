"""Whitening of vectors with MLlib's BlockMatrix.

Entries become whole numbers first, ``floor(SCALE * entry) + SHIFT``, so sums are exact and independent of the order of rows. Per
task numpy adds up the entries; the sums of tasks meet in an aggregate. Centred rows ``(n * x - S) / n`` are numbered and
put into a BlockMatrix whose blocks hold ``BLOCK_BYTES``; its transpose times itself is the scatter. The product is cut along
the rows into as many parts as there are shuffle partitions, so no task meets more than its share of blocks. The
scatter has the square of the vectors' length; its eigenvectors are found on the driver. A second product of the blocks
with the matrix of scaled eigenvectors gives the whitened rows, whose covariance is checked in the same way.

MLlib keeps the list of block numbers on the driver to plan a product: one pair of numbers for each ``BLOCK_BYTES`` of centred
rows.

Defined cases: vectors that are null or hold null or non-finite entries are dropped, and so are empty ones and those whose
length is not the most frequent one (the longest among equals). Components without variance (an eigenvalue of at most
``RANK_TOLERANCE`` of the largest) cannot be whitened and have no rows; a table of one vector, or of equal ones, has none at all. ``deviation``
is null where it does not fit in 64 bits. Repeated rows and repeated or null keys are rows like any other. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import quoted
from patronlens.llm.numbering import numbered
from patronlens.sources.staging import stage

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
BLOCK_BYTES = 4_000_000
RANK_TOLERANCE = 1e-12


def whole_numbers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Stored: ``key`` and ``x``, the whole-number entries of every vector that is kept."""
    entry = F.col(quoted(vector)).cast("array<double>")
    rows = vectors.select(F.col(quoted(key)).alias("key"), entry.alias("v")).where(F.size("v") > 0)
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(good, F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(SHIFT).cast("long"))
    rows = stage(rows.select("key", x.alias("x"), F.size("v").alias("size")), "whole-numbers")
    # As many rows as there are lengths; one number comes to the driver.
    usual = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.col("size") == (usual["size"] if usual else 0)).select("key", "x")


def _matrix(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """A list column whose rows are of one length."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(batch.num_rows, -1)


def sums(rows: DataFrame, name: str, kind: str) -> tuple[int, np.ndarray]:
    """Number of rows and the sum of each entry; ``kind`` is long or double."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                part = _matrix(batch, name, dtype).sum(axis=0)
                n, total = n + batch.num_rows, part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "total": total.tolist()}])

    parts = rows.select(name).mapInArrow(run, f"n long, total array<{kind}>")
    each = parts.select("n", F.posexplode("total").alias("at", "part"))
    found = each.groupBy("at").agg(F.sum("n").alias("n"), F.sum("part").alias("total")).orderBy("at").collect()
    return (found[0]["n"], np.array([r["total"] for r in found], dtype)) if found else (0, np.zeros(0, dtype))


def centred_rows(rows: DataFrame, n: int, total: np.ndarray) -> DataFrame:
    """Per row: key, deviation (sum of the exact squares of n * x - S) and centred (the row minus the mean)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = _matrix(batch, "x", np.int64) * n - total
            large = (off.astype(np.float64) ** 2).sum(axis=1) > 2.0**62
            deviation = (np.where(large[:, None], 0, off) ** 2).sum(axis=1).tolist()
            for k in np.nonzero(large)[0].tolist():
                exact = sum(int(v) ** 2 for v in off[k])
                deviation[k] = exact if exact < 2**63 else None
            centred = off / float(n)
            ends = np.arange(0, centred.size + 1, centred.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(centred.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], ["key", "deviation", "centred"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, deviation long, centred array<double>")


def blocks_of(rows: DataFrame, name: str, n: int, size: int) -> BlockMatrix:
    """Rows (pos, ``name``) as a matrix in blocks of some rows and all columns."""
    vectors = rows.select("pos", array_to_vector(name).alias("row"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "row")
    return IndexedRowMatrix(vectors, n, size).toBlockMatrix(max(1, BLOCK_BYTES // (8 * size)), size)


def scatter(blocks: BlockMatrix, parts: int) -> np.ndarray:
    """Transpose times matrix, whose rows are dealt out in ``parts`` on the way."""
    turned = blocks.transpose()
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, parts)
    found = BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()
    return (found + found.T) / 2


def times(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """Rows of ``blocks`` times a matrix of the driver: pos, z."""
    rows, columns = matrix.shape
    context = blocks.blocks.context
    local = DenseMatrix(rows, columns, matrix.ravel(order="F"))
    product = blocks.multiply(BlockMatrix(context.parallelize([((0, 0), local)], 1), rows, columns, rows, columns))
    # Rows stay in the JVM.
    found = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = MLUtils.convertVectorColumnsToML(found, "vector")
    return found.select(F.col("index").alias("pos"), vector_to_array("vector").alias("z"))


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down, ``most`` at most, and their unit vectors as columns; only those with variance."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:most]
    order = order[values[order] > RANK_TOLERANCE * max(values.max(initial=0.0), 0.0)]
    return values[order], vectors[:, order]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """Rows (key, deviation, z: the whitened entries) and what was fitted: n, mean, values, components, explained,
    identity_error (largest difference of the covariance of z from the identity)."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = whole_numbers(vectors, key, vector)
    n, total = sums(x, "x", "long")
    kind = x.schema["key"].dataType.simpleString()
    nothing = spark.createDataFrame([], f"key {kind}, deviation long, z array<double>")
    fitted = {"n": n, "mean": total / n if n else total, "values": np.zeros(0), "components": None, "explained": np.zeros(0), "identity_error": 0.0}
    if not n:
        return nothing, fitted
    rows = numbered(centred_rows(x, n, total), [])
    blocks = blocks_of(rows, "centred", n, len(total))
    covariance = scatter(blocks, parts) / n
    values, directions = components(covariance, most)
    if not len(values):
        return nothing, fitted
    z = stage(times(blocks, directions / np.sqrt(values)), "whitened")
    middle = F.array(*[F.lit(float(m)) for m in sums(z, "z", "double")[1] / n])
    centred = z.select("pos", F.zip_with("z", middle, lambda a, b: a - b).alias("z"))
    again = scatter(blocks_of(centred, "z", n, len(values)), parts) / n
    fitted |= {
        "values": values,
        "components": directions,
        "explained": values / np.trace(covariance),
        "identity_error": float(np.abs(again - np.eye(len(values))).max()),
    }
    return rows.drop("n").join(z, "pos").select("key", "deviation", "z"), fitted


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Per vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    rows, fitted = whiten(vectors, key, vector, most)
    shares = F.array(*[F.lit(float(e)) for e in fitted["explained"]]) if len(fitted["explained"]) else F.array(F.lit(0.0))
    each = rows.select("key", "deviation", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        F.col("key").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(fitted["n"]).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(fitted["identity_error"]).alias("identity_error"),
    )
