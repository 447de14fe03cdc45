"""Consecutive numbers for the rows of a table that is stored in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.sources.staging import stage

_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """``df`` with ``pos``, each row's place from 0 in the order of its group, and ``n``, the rows of the group.

    One range shuffle by group and order; its last key tells equal rows apart, so that a value of many rows is spread as
    well. Each row's partition and place in it are stored; what is counted and joined afterwards has a row per partition and
    group in it. With neither order nor group, rows keep the place they have and nothing is shuffled. ``group`` has no
    nulls. ``df`` has no columns named pos, n, spot or slice.
    """
    keys = [*([group] if group else []), *order]
    if keys:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.withColumn("spot", F.monotonically_increasing_id())
        df = df.repartitionByRange(parts, *keys, "spot").sortWithinPartitions(*keys, "spot").drop("spot")
    rows = stage(df.withColumn("spot", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("slice", F.shiftright("spot", _PLACE_BITS))
    within = ["slice", *([group] if group else [])]
    whole = Window.partitionBy(group if group else F.lit(0))
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy(*within).agg(F.count(F.lit(1)).alias("size"), F.min("spot").alias("first"))
    starts = held.select(
        *within,
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(whole).alias("n"),
    )
    joined = rows.join(stage(starts, "starts"), within)
    return joined.withColumn("pos", F.col("spot") + F.col("shift")).drop("spot", "slice", "shift")
