"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever its case rules."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def same_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` in that order, odd names included."""
    return df.select(*[F.col(quoted(c)) for c in columns])


def quoted(name: str) -> str:
    """``name`` as one identifier, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column with null as empty text."""
    return F.coalesce(F.col(quoted(name)), F.lit(""))
