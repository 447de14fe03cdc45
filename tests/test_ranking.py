"""Exact ranks and quantile bins, on every path through the selection."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronlens.operators import ranking
from patronlens.operators.ranking import RankSpec, cuts_passed, quantile_last_ranks, quantile_spec, rank_cuts


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 3000), st.integers(2, 10))
def test_bins_equal_quantile_cut(rows, bins):
    ranks = np.arange(1, rows + 1)
    mine = sum((ranks > last).astype(int) for last in quantile_last_ranks(rows, bins))
    assert (mine == pd.qcut(pd.Series(ranks, dtype=float), bins, labels=False).to_numpy()).all()


def test_known_bins():
    def bins_of(rows, bins):
        return [sum(r > last for last in quantile_last_ranks(rows, bins)) for r in range(1, rows + 1)]

    assert bins_of(7, 5) == [0, 0, 1, 2, 3, 4, 4]
    assert bins_of(4, 3) == [0, 1, 2, 2]


def skewed(spark, rows=30_000):
    """A tied column with one value on most rows, a continuous one, and one with nulls."""
    frame = spark.range(rows).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 10 < 7, F.lit(3)).otherwise(F.pmod(F.xxhash64("id"), F.lit(9))).alias("tied"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)) / F.lit(7.0)).alias("wide"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)).cast("double")).alias("holes"),
    )
    return frame.repartition(6).cache()


@pytest.mark.parametrize("rows", [30_000, 700, 7])
def test_cuts_at_all_sizes(spark, rows):
    df = skewed(spark, rows)
    specs = [quantile_spec(c, F.col(c), 5) for c in ("tied", "wide", "holes")]
    specs.append(RankSpec("ends", -F.col("wide"), lambda n: [1, n // 2, n], F.col("tied") == 3))
    found = rank_cuts(df, "key", specs)
    local = df.toPandas()
    for spec, column in zip(specs, ("tied", "wide", "holes")):
        ordered = local.dropna(subset=[column]).sort_values([column, "key"])
        assert found[spec.name].rows == len(ordered)
        expected = [
            (float(ordered.iloc[r - 1][column]), int(ordered.iloc[r - 1]["key"]))
            for r in quantile_last_ranks(len(ordered), 5)
        ]
        assert list(found[spec.name].cuts) == expected
    chosen = local[local.tied == 3].assign(value=lambda d: -d.wide).sort_values(["value", "key"])
    places = [0, len(chosen) // 2 - 1, len(chosen) - 1]
    assert [k for _, k in found["ends"].cuts] == [int(chosen.iloc[p]["key"]) for p in places]


def test_passed_cuts_are_the_bins(spark):
    df = skewed(spark, 997)
    spec = quantile_spec("holes", F.col("holes"), 5)
    cuts = rank_cuts(df, "key", [spec])["holes"]
    out = df.withColumn("bin", cuts_passed(spec, "key", cuts)).toPandas().sort_values("key")
    known = out.dropna(subset=["holes"])
    expected = pd.qcut(known["holes"].rank(method="first"), 5, labels=False)
    assert (known["bin"].astype(int) == expected).all()
    assert out[out.holes.isna()]["bin"].isna().all()


def test_a_wrong_sketch_is_not_trusted(spark, monkeypatch):
    df = skewed(spark, 5_000)
    spec = quantile_spec("wide", F.col("wide"), 5)
    exact = rank_cuts(df, "key", [spec])
    monkeypatch.setattr(ranking.F, "percentile_approx", lambda v, p, a: F.transform(p, lambda _: F.lit(1.0)))
    assert rank_cuts(df, "key", [spec]) == exact


def test_wanted_ranks_must_exist(spark):
    with pytest.raises(ValueError, match="outside"):
        rank_cuts(spark.range(3).withColumnRenamed("id", "key"), "key", [RankSpec("x", F.col("key"), lambda n: [4])])


def test_global_rank(spark):
    df = skewed(spark, 5_000)
    ranked = ranking.global_rank(df.select("key", "tied"), ["tied", "key"]).toPandas()
    ordered = ranked.sort_values(["tied", "key"])
    assert (ordered["rank"].to_numpy() == np.arange(1, 5_001)).all()


def test_global_rank_sorts_by_ranges(spark, monkeypatch):
    plans = []
    kept = ranking.stage

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(ranking, "stage", watched)
    ranked = ranking.global_rank(skewed(spark, 5_000).select("key", "wide"), ["wide", "key"])
    assert ["rangepartitioning(wide" in p and "SinglePartition" not in p for p in plans] == [True]
    # Of the stored rows only the list of slices is brought together.
    final = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in final and "rangepartitioning" not in final


def test_no_ranked_rows_have_no_cuts(spark):
    empty = spark.range(0).withColumnRenamed("id", "key")
    found = rank_cuts(empty, "key", [ranking.first_rows_spec("top", F.col("key"), lambda n: 1)])["top"]
    assert found.rows == 0 and found.cuts == ()
