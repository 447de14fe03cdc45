"""Orders readers: Parquet, a database over JDBC, or generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.config import JdbcSource, RunConfig, SyntheticSource
from patronlens.functions.columns import on_or_before
from patronlens.schemas import ORDERS
from patronlens.sources.splits import bound_predicates, bounds_question, hash_predicates
from patronlens.sources.synthetic import synthetic_orders


def conform(df: DataFrame) -> DataFrame:
    """Select the six order columns in their declared types.

    Customer ids may be text or numbers; every other column is cast.
    """
    missing = [name for name in ORDERS.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"orders lack the columns {missing}")
    columns = []
    for field in ORDERS.fields:
        kind = df.schema[field.name].dataType
        keep = field.name in ("customer_id", "order_id") and isinstance(kind, T.StringType)
        column = F.col(field.name) if keep or kind == field.dataType else F.col(field.name).cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def orders_until(orders: DataFrame, cfg: RunConfig) -> DataFrame:
    """Orders on or before the snapshot; nothing later may reach a feature."""
    return orders.filter(on_or_before(orders, "order_date", cfg.snapshot))


def parquet_orders(spark: SparkSession, path: str) -> DataFrame:
    """Orders stored as Parquet."""
    return conform(spark.read.parquet(path))


def jdbc_bounds(spark: SparkSession, source: JdbcSource) -> tuple[str, str] | None:
    """The bounds of the split: those given, else asked of the database; none if the table is empty."""
    if source.lower_bound is not None and source.upper_bound is not None:
        return str(source.lower_bound), str(source.upper_bound)
    column = source.partition_column
    question = f"SELECT min({column}) AS low, max({column}) AS high FROM {source.table}"
    options = {"url": source.url, "query": question, "preferTimestampNTZ": "true"} | dict(source.properties)
    answer = spark.read.format("jdbc").options(**options).load().first()
    low, high = (given if given is not None else found for given, found in
                 zip((source.lower_bound, source.upper_bound), (answer[0], answer[1])))
    if low is None or high is None:
        return None
    if isinstance(answer[0], str):
        raise ValueError(f"{column} is text and cannot split the read by range; set split to hash or counts")
    return str(low), str(high)


def jdbc_options(source: JdbcSource, bounds: tuple[str, str] | None) -> dict[str, str]:
    """Reader options of a JDBC read, split between the bounds if there are any."""
    options = {
        "url": source.url,
        "dbtable": source.table,
        "fetchsize": str(source.fetch_size),
        "preferTimestampNTZ": "true",
    }
    if bounds:
        options |= {
            "partitionColumn": source.partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(source.num_partitions),
        }
    return options | dict(source.properties)


def jdbc_predicates(spark: SparkSession, source: JdbcSource) -> list[str]:
    """Conditions of the parts of a read that is split by hash or by counts."""
    column = source.partition_column
    if source.split == "hash":
        return hash_predicates(source.url, column, source.num_partitions)
    if source.split != "counts":
        raise ValueError(f"a read is split by range, hash or counts, not by {source.split!r}")
    question = bounds_question(source.table, column, source.num_partitions)
    options = {"url": source.url, "query": question, "preferTimestampNTZ": "true"} | dict(source.properties)
    # One value per part.
    return bound_predicates(column, [r[0] for r in spark.read.format("jdbc").options(**options).load().collect()])


def jdbc_orders(spark: SparkSession, source: JdbcSource, cfg: RunConfig) -> DataFrame:
    """Orders from a database; projection and date filter run in the database."""
    if source.split == "range":
        table = spark.read.format("jdbc").options(**jdbc_options(source, jdbc_bounds(spark, source))).load()
    else:
        settings = {"fetchsize": str(source.fetch_size), "preferTimestampNTZ": "true"} | dict(source.properties)
        table = spark.read.jdbc(source.url, source.table, predicates=jdbc_predicates(spark, source), properties=settings)
    wanted = table.select(*ORDERS.fieldNames())
    return conform(wanted.filter(on_or_before(wanted, "order_date", cfg.snapshot)))


def read_orders(
    spark: SparkSession, source: JdbcSource | SyntheticSource | str | None, cfg: RunConfig
) -> DataFrame:
    """Pick the reader: a database, a Parquet path, or generated orders."""
    if isinstance(source, JdbcSource) and source.url:
        return jdbc_orders(spark, source, cfg)
    if isinstance(source, str) and source:
        return parquet_orders(spark, source)
    size = source if isinstance(source, SyntheticSource) else SyntheticSource()
    return synthetic_orders(spark, size, cfg)
