"""Standard scaling with statistics of the train part."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.schemas import FEATURES


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column."""

    means: dict[str, float]
    deviations: dict[str, float]

    def scaled(self, name: str) -> Column:
        """The scaled column; a constant column is only centred."""
        deviation = self.deviations[name] or 1.0
        return (F.col(name).cast("double") - F.lit(self.means[name])) / F.lit(deviation)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Scale every column, replacing it unless a suffix is given."""
        return df.withColumns({f"{name}{suffix}": self.scaled(name) for name in self.means})

    def sql_expressions(self, suffix: str) -> list[str]:
        """The same columns as SQL text, for a stored model."""
        return [
            f"(CAST(`{n}` AS DOUBLE) - ({self.means[n]!r}D)) / {self.deviations[n] or 1.0!r}D AS `{n}{suffix}`"
            for n in self.means
        ]


def scaler_stats(train: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Mean and population deviation of every column, one row per column.

    The columns are stacked before they are aggregated: the groups are as few as
    the columns and shrink where they are read, and the generated code stays
    small enough to be compiled, which it would not with all columns side by side.
    """
    values = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    stacked = values.unpivot([], columns, "feature", "value")
    return stacked.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))


def fit_scaler(train: DataFrame, columns: list[str] = FEATURES) -> Scaler:
    """Collect the statistics, one row per column."""
    stats = {r["feature"]: r for r in scaler_stats(train, columns).collect()}
    return Scaler({n: stats[n]["mean"] for n in columns}, {n: stats[n]["deviation"] for n in columns})
