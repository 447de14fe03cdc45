"""Tables that lie in buckets of their key, and the joins of the stages on them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from patronlens.config import SyntheticSource
from patronlens.operators import clv, features
from patronlens.plans import catalog, runs
from patronlens.sources import buckets, versions
from patronlens.sources.staging import discard, stage
from patronlens.sources.synthetic import synthetic_orders


@pytest.fixture
def no_broadcast(spark):
    """Joins as of large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df) -> int:
    """Shuffles in the plan that has been carried out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def left_and_right(spark):
    left = spark.range(500).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 7).alias("a"))
    right = spark.range(100, 600).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 5).alias("b"))
    return left, right


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_join_on_the_key_moves_nothing(spark, tmp_path, no_broadcast):
    left, right = left_and_right(spark)
    tables = []
    for name, df in (("left", left), ("right", right)):
        versions.publish(df, f"file://{tmp_path}/{name}", key="customer_id")
        tables.append(versions.read(spark, f"file://{tmp_path}/{name}"))
    joined = tables[0].join(tables[1], "customer_id", "left")
    assert shuffles(left.join(right, "customer_id", "left")) == 2 and shuffles(joined) == 0
    assert rows(joined) == rows(left.join(right, "customer_id", "left"))
    assert shuffles(tables[0].groupBy("customer_id").agg(F.sum("a").alias("a"))) == 0
    staged = stage(left, "left", "customer_id")
    assert shuffles(staged.join(tables[1], "customer_id")) == 0
    discard(staged)


def test_one_file_a_bucket_and_no_entry_left(spark, tmp_path):
    left, _ = left_and_right(spark)
    before = spark.catalog.listTables()
    commit = versions.publish(left.repartition(5), f"file://{tmp_path}/t", key="customer_id", buckets=3)
    files = list((tmp_path / "t/_versions" / commit.folder).glob("*.parquet"))
    assert (commit.key, commit.buckets, len(files)) == ("customer_id", 3, 3)
    assert rows(versions.read(spark.newSession(), f"file://{tmp_path}/t")) == rows(left)
    assert spark.catalog.listTables() == before


def test_a_copy_of_a_bucketed_table_is_not_dealt_again(spark, tmp_path):
    left, _ = left_and_right(spark)
    versions.publish(left, f"file://{tmp_path}/t", key="customer_id")
    table = versions.read(spark, f"file://{tmp_path}/t")
    copied = versions.publish(table.select("customer_id"), f"file://{tmp_path}/u", key="customer_id")
    files = list((tmp_path / "u/_versions" / copied.folder).glob("*.parquet"))
    assert len(files) == copied.buckets and rows(versions.read(spark, f"file://{tmp_path}/u")) == rows(left.select("customer_id"))


def test_odd_tables(spark, tmp_path, no_broadcast):
    left, right = left_and_right(spark)
    # No key, repeated keys, names with a dot or a quote, other numbers of buckets, and no rows at all.
    odd = left.unionByName(left.limit(3)).withColumn("customer_id", F.when(F.col("a") != 2, F.col("customer_id")))
    odd = odd.withColumnsRenamed({"customer_id": "the.key", "a": "it`s"})
    versions.publish(odd, f"file://{tmp_path}/it's odd", key="the.key", buckets=3)
    stored = versions.read(spark, f"file://{tmp_path}/it's odd")
    assert rows(stored) == rows(odd) and stored.columns == odd.columns
    versions.publish(right, f"file://{tmp_path}/r", key="customer_id", buckets=4)
    other = versions.read(spark, f"file://{tmp_path}/r")
    joined = stored.withColumnsRenamed({"the.key": "customer_id"}).join(other, "customer_id")
    assert rows(joined) == rows(odd.withColumnsRenamed({"the.key": "customer_id"}).join(right, "customer_id"))
    assert rows(stage(left.limit(0), "empty", "customer_id")) == []
    assert buckets.default_buckets(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_manifests_without_buckets_are_read(spark, tmp_path):
    versions.publish(spark.range(3), f"file://{tmp_path}/t")
    (manifest,) = (tmp_path / "t/_manifest").glob("*.json")
    told = json.loads(manifest.read_text())
    manifest.write_text(json.dumps({k: v for k, v in told.items() if k not in ("key", "buckets")}))
    for checksum in (tmp_path / "t/_manifest").glob(".*.crc"):
        checksum.unlink()
    assert rows(versions.read(spark, f"file://{tmp_path}/t")) == [(0,), (1,), (2,)]


def test_the_stages_join_without_a_shuffle(spark, tmp_path, cfg, no_broadcast):
    run = runs.Run(spark, str(tmp_path), None, cfg)
    table = run.write(features.customer_features(synthetic_orders(spark, SyntheticSource(3_000, 300), cfg), cfg), "churn_features", runs.KEY)
    rfm = run.write(table.select(*features.RFM_COLUMNS), "rfm", runs.KEY)
    values = clv.score_clv(rfm, catalog.PURCHASE_PARAMS, catalog.VALUE_PARAMS, cfg)
    values = run.write(values, "clv_scores", runs.KEY)
    scores = stage(catalog.fixed_score(table), "churn_scores", runs.KEY)
    joined = runs.score_table(scores, values)
    assert shuffles(joined) == 0 and joined.count() == table.count() > 0
    assert joined.where(F.col("clv_12m").isNull()).count() == values.where(F.col("clv_12m").isNull()).count()
