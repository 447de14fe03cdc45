"""Session settings used by the tests, the bench and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution; a cluster sets its own sizes."""
    builder = (
        SparkSession.builder.appName("patronlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot key's partition even where that costs a further exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # One process does all the work here; a cluster sizes its executors itself.
            builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
