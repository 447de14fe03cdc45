"""Table writers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from patronlens.schemas import METRICS

PARAMETERS = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("standard_error", T.DoubleType()),
    ]
)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the CSV files at ``path``; each part file has a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def parameter_table(
    spark: SparkSession, model: str, values: dict[str, float], errors: dict[str, float | None] | None = None
) -> DataFrame:
    """Fitted parameters as rows, with their standard errors where these are known."""
    errors = errors or {}
    return spark.createDataFrame([(model, name, float(v), errors.get(name)) for name, v in values.items()], PARAMETERS)


def read_parameters(spark: SparkSession, path: str, model: str) -> dict[str, float]:
    """Parameters of one model, as written by :func:`parameter_table`."""
    rows = spark.read.schema(PARAMETERS).parquet(path).where(f"model = '{model}'").collect()
    return {row["name"]: row["value"] for row in rows}


def metric_rows(
    spark: SparkSession, run_id: str, entries: Iterable[tuple[str, str, str, float | None]]
) -> DataFrame:
    """Rows ``(stage, kind, name, value)`` of one run, kind being param or metric."""
    rows = [(run_id, s, k, n, None if v is None else float(v)) for s, k, n, v in entries]
    return spark.createDataFrame(rows, METRICS)


def append_metrics(rows: DataFrame, path: str) -> None:
    """Add the rows of a run to the metrics table."""
    rows.coalesce(1).write.mode("append").parquet(path)
