"""Readers, the generator, writers, staging and full runs."""

from __future__ import annotations

import math
from dataclasses import replace

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from patronlens.config import ClassifierConfig, JdbcSource, SyntheticSource
from patronlens.operators import classifier
from patronlens.plans import runs
from patronlens.schemas import CHURN_COLUMNS, CLV_COLUMNS, ORDERS
from patronlens.sources import orders as readers
from patronlens.sources import sinks, staging
from patronlens.sources.synthetic import CHANNELS, synthetic_orders


def test_generated_orders_have_the_stated_shape(spark, cfg):
    table = synthetic_orders(spark, SyntheticSource(), cfg).cache()
    assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in ORDERS.fields]
    row = table.agg(
        F.count("*"), F.min("customer_id"), F.max("customer_id"), F.min("order_date").cast("string"),
        F.max("order_date").cast("string"), F.avg("revenue"), F.stddev("revenue"), F.avg("is_returned"),
        F.min("revenue"),
    ).first()
    assert row[0] == 50_000 and row[1] >= 1 and row[2] <= 8_000
    assert (row[3], row[4]) == ("2021-12-31 00:00:00", "2024-12-31 00:00:00")
    assert row[5] == pytest.approx(45, rel=0.02) and row[6] == pytest.approx(30, rel=0.05)
    assert row[7] == pytest.approx(0.05, abs=0.005) and row[8] > 0
    shares = {r["channel"]: r["count"] / 50_000 for r in table.groupBy("channel").count().collect()}
    assert sorted(shares) == CHANNELS and all(s == pytest.approx(0.25, abs=0.01) for s in shares.values())


def test_generated_orders_do_not_depend_on_partitions(spark, cfg):
    def rows(partitions):
        return by_key(synthetic_orders(spark, SyntheticSource(500, 40, partitions), cfg), "order_id")

    assert rows(1) == rows(7)


def test_source_choice(spark, small_orders, cfg, tmp_path):
    sinks.write_parquet(small_orders, str(tmp_path / "orders"))
    assert readers.read_orders(spark, str(tmp_path / "orders"), cfg).count() == 10
    assert readers.read_orders(spark, SyntheticSource(100, 5), cfg).count() == 100
    assert readers.read_orders(spark, None, cfg).count() == 50_000


def test_jdbc_options_split_the_read():
    options = readers.jdbc_options(JdbcSource("jdbc:x", num_partitions=8, properties=(("user", "u"),)), ("0", "9"))
    assert options["url"] == "jdbc:x" and options["dbtable"] == "orders" and options["user"] == "u"
    assert (options["partitionColumn"], options["numPartitions"]) == ("order_id", "8")


def test_conform_casts_and_refuses(spark, small_orders):
    loose = small_orders.withColumn("order_date", F.col("order_date").cast("date")).withColumn(
        "revenue", F.col("revenue").cast("decimal(10,2)")
    )
    assert readers.conform(loose).schema.simpleString() == ORDERS.simpleString()
    with pytest.raises(ValueError, match="revenue"):
        readers.conform(small_orders.drop("revenue"))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_snapshot_filter_reaches_the_scan(spark, small_orders, cfg, tmp_path, kind):
    path = str(tmp_path / kind)
    small_orders.withColumn("order_date", F.col("order_date").cast(kind)).write.parquet(path)
    table = readers.orders_until(spark.read.parquet(path), replace(cfg, snapshot="2024-12-01")).select("order_id")
    assert table.count() == 8
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(order_date" in plan
    assert "revenue" not in plan.split("ReadSchema")[1]


def test_writers_round_trip(spark, small_orders, tmp_path):
    sinks.write_parquet(small_orders, str(tmp_path / "p"))
    sinks.write_parquet(small_orders, str(tmp_path / "p"))
    assert by_key(spark.read.parquet(str(tmp_path / "p")), "order_id") == by_key(small_orders, "order_id")
    sinks.write_csv(small_orders, str(tmp_path / "c"))
    again = spark.read.schema(ORDERS).option("header", True).csv(str(tmp_path / "c"))
    assert by_key(again, "order_id") == by_key(small_orders, "order_id")
    params = {"r": 0.25, "alpha": 1 / 3}
    sinks.write_parquet(sinks.parameter_table(spark, "m", params), str(tmp_path / "m"))
    assert sinks.read_parameters(spark, str(tmp_path / "m"), "m") == params


def test_metrics_are_appended(spark, tmp_path):
    for run in ("a", "b"):
        sinks.append_metrics(sinks.metric_rows(spark, run, [("s", "metric", "auroc", None)]), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("run_id").count().count() == 2


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A folder of this test alone in place of the session's."""
    monkeypatch.setattr(staging, "shared_folder", lambda spark: f"file://{tmp_path}/shared")
    return tmp_path / "shared"


def test_the_folder_is_the_one_that_is_named(spark):
    from types import SimpleNamespace

    named = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: "hdfs://cluster/scratch/"), sparkContext=None)
    assert staging.shared_folder(named) == "hdfs://cluster/scratch"
    context = SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))
    assert staging.new_path(spark, "x").startswith(staging.shared_folder(spark))


def test_staged_tables_lie_in_one_folder_per_application(spark, shared):
    stored = staging.stage(spark.range(3), "kept")
    assert stored.count() == 3 and list(shared.glob("patronlens/*/kept-*/part-*"))
    staging.remove(staging.application_folder(spark))
    assert not list(shared.glob("patronlens/*"))


def test_spent_tables_are_deleted_and_the_others_stay(spark, shared):
    spent, empty, kept = (staging.stage(spark.range(n), "table") for n in (5, 0, 3))
    result = staging.stage(spent.unionByName(kept), "result")
    staging.discard(spent, empty)
    assert result.count() == 8 and kept.count() == 3
    assert len(list(shared.glob("patronlens/*/table-*"))) == 1


def test_scoped_tables_go_when_the_block_ends_or_fails(spark, shared):
    with staging.scope(spark) as outer:
        staging.stage(spark.range(3), "a")
        with pytest.raises(KeyError), staging.scope(spark):
            staging.stage(spark.range(3), "b")
            raise KeyError
        assert [p.name[:1] for p in shared.glob("patronlens/*/run-*/*") if p.is_dir()] == ["a"]
        assert staging.new_path(spark, "c").startswith(outer)
    assert not list(shared.glob("patronlens/*/run-*"))


def test_a_folder_that_is_not_shared_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "_TRIAL_PARTS", 17)  # as if the files of one executor were not seen
    written = spark.range(0, 16, 1, 16).write
    monkeypatch.setattr(spark, "range", lambda *a: type("Frame", (), {"write": written})())
    with pytest.raises(RuntimeError, match="not shared"):
        staging._try_out(spark, f"file://{tmp_path}/trial")


def test_full_run_and_retraining(spark, cfg, tmp_path, shared):
    budget = ClassifierConfig(trees=4, depth=3)
    run = runs.Run(spark, str(tmp_path), SyntheticSource(3_000, 400), replace(cfg, min_customers=300), budget)
    exported = runs.run_all(run)
    scored = run.read("scored_customers")
    assert scored.columns == [*CHURN_COLUMNS, "churn_prob", *CLV_COLUMNS]
    assert exported.count() == scored.count() == run.read("rfm").count()
    assert scored.where("clv_12m IS NULL OR churn_prob IS NULL").count() == 0
    csv = spark.read.option("header", True).csv(run.path("customers_csv"))
    assert csv.columns == exported.columns and csv.count() == exported.count()
    metrics = {r["name"]: r["value"] for r in run.read("run_metrics").where("kind = 'metric'").collect()}
    assert metrics["auroc_random_split"] > 0.8 and metrics["ks_statistic"] > 0.35
    assert math.isfinite(metrics["mean_clv_12m"])
    settings = {r["name"]: r["value"] for r in run.read("run_metrics").where("kind = 'param'").collect()}
    assert 1 <= settings["trees_kept"] <= settings["trees"] == 4
    parts = run.read("customer_contributions")
    assert parts.count() == run.read("classification_report").where("name = 'accuracy'").first()["support"]
    assert not list(shared.glob("patronlens/*/run-*"))
    model = classifier.load_model(run.path("churn_model"))
    again = by_key(classifier.churn_scores(scored.drop("churn_prob"), model))
    first = by_key(scored)
    assert all(again[k]["churn_prob"] == first[k]["churn_prob"] for k in first)

    runs.train(replace(run, run_id="second"))
    assert run.read("run_metrics").select("run_id").distinct().count() == 2


def test_a_run_stops_at_failed_checks(spark, cfg, tmp_path):
    with pytest.raises(ValueError, match="at_least_1000"):
        runs.run_all(runs.Run(spark, str(tmp_path), SyntheticSource(100, 50), cfg))


class FakeReader:
    """Stands in for Spark's reader: records the options, returns a given table."""

    def __init__(self, table):
        self.table, self.options_seen = table, {}

    def format(self, name):
        self.options_seen["format"] = name
        return self

    def options(self, **options):
        self.options_seen |= options
        return self

    def load(self):
        return self.table


def test_jdbc_read_selects_and_filters(small_orders, orders_of, cfg):
    from types import SimpleNamespace

    late = orders_of([(1, 99, -3, 5.0, "email", 0)])
    reader = FakeReader(small_orders.unionByName(late).withColumn("extra", F.lit(1)))
    source = JdbcSource("jdbc:somewhere", lower_bound=1, upper_bound=9)
    table = readers.read_orders(SimpleNamespace(read=reader), source, cfg)
    assert table.columns == ORDERS.fieldNames() and table.count() == 10
    assert reader.options_seen == {"format": "jdbc", **readers.jdbc_options(source, ("1", "9"))}


def bounds_of(spark, source, low, high):
    from types import SimpleNamespace

    reader = FakeReader(spark.createDataFrame([(low, high)], source[1]))
    return readers.jdbc_bounds(SimpleNamespace(read=reader), source[0]), reader.options_seen


def test_jdbc_bounds_are_asked_of_the_database(spark):
    source = JdbcSource("jdbc:somewhere", table="shop.orders", partition_column="id", properties=(("user", "reader"),))
    found, options = bounds_of(spark, (source, "low long, high long"), 5, 2 * 10**9)
    assert found == ("5", "2000000000") and options["user"] == "reader"
    assert options["query"] == "SELECT min(id) AS low, max(id) AS high FROM shop.orders"
    assert readers.jdbc_options(source, found)["upperBound"] == "2000000000"
    assert bounds_of(spark, (replace(source, lower_bound=7), "low long, high long"), 5, 9)[0] == ("7", "9")
    empty, _ = bounds_of(spark, (source, "low long, high long"), None, None)
    assert empty is None and "partitionColumn" not in readers.jdbc_options(source, empty)
    with pytest.raises(ValueError, match="text"):
        bounds_of(spark, (source, "low string, high string"), "a", "b")


def test_command_line_names_a_database():
    from patronlens.__main__ import arguments, jdbc_source

    given = "ingest --root r --jdbc jdbc:x --jdbc-table t --jdbc-column c --jdbc-upper 9 --jdbc-property user=a=b".split()
    source = jdbc_source(arguments(given))
    assert source == JdbcSource("jdbc:x", "t", "c", None, "9", properties=(("user", "a=b"),))
