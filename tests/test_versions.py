"""Versioned tables, resumed runs, observed checks, parts of database reads, and merged states."""

from __future__ import annotations

import os
import time
from dataclasses import replace

import duckdb
import pytest
from conftest import by_key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_sources import FakeReader

from patronlens.config import ClassifierConfig, JdbcSource, SyntheticSource
from patronlens.operators import features, quality, state
from patronlens.plans import runs
from patronlens.sources import orders as readers
from patronlens.sources import splits, versions
from patronlens.sources.staging import stage
from patronlens.sources.synthetic import synthetic_orders


# ---------------------------------------------------------------- versions


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_whole_versions(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, table)
    assert versions.publish(spark.range(3), table, "a").number == 1
    old = versions.read(spark, table)
    second = versions.publish(versions.read(spark, table).select(F.col("id") + 10), table, "b", ("orders@1",))
    assert ids(versions.read(spark, table)) == [10, 11, 12] and ids(old) == [0, 1, 2]
    assert ids(versions.read(spark, table, 1)) == [0, 1, 2]
    assert versions.current(spark, table) == second and second.inputs == ("orders@1",)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    versions.publish(spark.range(3), table)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 60, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, table)
    assert ids(versions.read(spark, table)) == [0, 1, 2] and versions.current(spark, table).number == 1
    assert versions.publish(spark.range(1), table).number == 2


def test_a_writer_that_dies_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = f"file://{tmp_path}/t"
    versions.publish(spark.range(3), table)
    monkeypatch.setattr(versions, "_write_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        versions.publish(spark.range(9), table)
    assert ids(versions.read(spark, table)) == [0, 1, 2] and len(list((tmp_path / "t/_versions").iterdir())) == 2


def test_two_writers_cannot_commit_the_same_number(spark, tmp_path, monkeypatch):
    table = f"file://{tmp_path}/t"
    first = versions.publish(spark.range(3), table)
    monkeypatch.setattr(versions, "current", lambda *a: None)  # what a slow writer saw before the first one's commit
    with pytest.raises(versions.Conflict):
        versions.publish(spark.range(9), table)
    monkeypatch.undo()
    assert versions.current(spark, table) == first and ids(versions.read(spark, table)) == [0, 1, 2]


def test_old_and_abandoned_versions_are_removed(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    for k in range(4):
        versions.publish(spark.range(k + 1), table, keep=2)
    folder = tmp_path / "t/_versions"
    assert [c.number for c in versions.commits(spark, table)] == [3, 4] and len(list(folder.iterdir())) == 2
    for name, age in (("old", 3 * 24 * 3600), ("fresh", 0)):
        (folder / name).mkdir()
        os.utime(folder / name, (time.time() - age,) * 2)
    assert versions.forget(spark, table) == ["old"] and (folder / "fresh").exists()
    assert ids(versions.read(spark, table)) == [0, 1, 2, 3]


def test_a_run_goes_on_where_it_failed(spark, cfg, tmp_path, monkeypatch):
    run = runs.Run(spark, str(tmp_path), SyntheticSource(2_000, 300), replace(cfg, min_customers=200), ClassifierConfig(trees=2, depth=2))
    calls = []

    def counted(name, function):
        return lambda r: calls.append(name) or function(r)

    stages = {name: counted(name, f) for name, f in runs.STAGES.items()}
    monkeypatch.setattr(runs, "STAGES", stages | {"values": counted("values", lambda r: 1 / 0)})
    with pytest.raises(ZeroDivisionError):
        runs.run_all(run)
    assert run.read("rfm").count() == run.read("churn_features").count() > 0
    monkeypatch.setattr(runs, "STAGES", stages)
    calls.clear()
    exported = runs.run_all(run, resume=True)
    assert calls == ["values", "churn", "export"] and exported.count() == run.read("rfm").count()
    calls.clear()
    assert runs.run_all(run, resume=True).count() == exported.count() and calls == []


# ---------------------------------------------------------------- observed checks


def test_observed_checks_equal_the_counted_ones(spark, cfg, orders_of):
    bad = orders_of([(None, 1, 3, 5.0, "e", 0), (1, 2, -1, 5.0, "e", 0), (2, 3, 4, float("nan"), "e", 0), (3, 4, None, 0.0, "e", 0)])
    many = synthetic_orders(spark, SyntheticSource(3_000, 900), cfg)
    for table, least in ((bad, 5), (bad, 3), (bad.limit(0), 1), (many, 10), (many, 800), (many, 5_000)):
        few = replace(cfg, min_customers=least)
        orders, told = quality.watched(table, few)
        stored = stage(orders, "observed_test")
        mine = sorted(map(tuple, quality.observed_report(told, stored, few).collect()))
        assert mine == sorted(map(tuple, quality.validation_report(table, few).collect()))


def test_validation_uses_what_was_observed(spark, cfg, tmp_path, monkeypatch):
    run = runs.Run(spark, str(tmp_path), SyntheticSource(500, 50), cfg)
    runs.ingest(run)
    monkeypatch.setattr(quality, "run_validation", lambda *a: pytest.fail("read again"))
    with pytest.raises(ValueError, match="at_least_1000"):
        runs.validate(run)


# ---------------------------------------------------------------- parts of a database read


def covered(predicates, values, kind):
    """How many of the conditions each row fulfils, as a database counts it."""
    con = duckdb.connect()
    con.execute("CREATE MACRO hashtext(x) AS ((hash(x) % 4294967296)::BIGINT - 2147483648)")
    con.execute(f"CREATE TABLE t (c {kind})")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    hits = " + ".join(f"coalesce(({p})::INT, 0)" for p in predicates)
    return [r[0] for r in con.execute(f"SELECT {hits} FROM t").fetchall()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab'Z9é ", max_size=4)), min_size=1, max_size=30), st.integers(1, 6))
def test_every_row_is_in_one_part(values, parts):
    assert set(covered(splits.hash_predicates("jdbc:postgresql://h/d", "c", parts), values, "VARCHAR")) == {1}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (c VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    lows = [r[0] for r in con.execute(splits.bounds_question("t", "c", parts)).fetchall()]
    predicates = splits.bound_predicates("c", lows)
    assert set(covered(predicates, values, "VARCHAR")) == {1} and len(predicates) <= parts


def test_parts_by_counts_are_even_on_a_skewed_column():
    values = [1] * 500 + list(range(2, 502)) + [None] * 10
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1) AS c", [values])
    lows = [r[0] for r in con.execute(splits.bounds_question("t", "c", 10)).fetchall()]
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in splits.bound_predicates("c", lows)]
    assert sum(sizes) == len(values) and sorted(sizes)[:-1] == [100] * 5 and max(sizes) == 510


def test_dialects():
    assert splits.dialect("jdbc:mysql://h/d") == "mysql" and splits.dialect("jdbc:x") == ""
    assert len(splits.hash_predicates("jdbc:oracle:thin:@h", "c", 4)) == 4
    with pytest.raises(ValueError, match="no hash"):
        splits.hash_predicates("jdbc:unknown:h", "c", 4)
    assert splits.quoted_value("o'k") == "'o''k'" and splits.quoted_value(2.5) == "2.5"


def test_reads_by_hash_and_counts(small_orders, spark, cfg):
    from types import SimpleNamespace

    class Reader(FakeReader):
        def jdbc(self, url, table, predicates, properties):
            self.options_seen |= {"predicates": predicates, "fetch": properties["fetchsize"], "user": properties.get("user")}
            return self.rows

    reader = Reader(spark.createDataFrame([("a",), ("f",), ("q",)], "low string"))
    reader.rows = small_orders.withColumn("extra", F.lit(1))
    source = JdbcSource("jdbc:postgresql://h/d", partition_column="customer_id", num_partitions=3, split="counts", properties=(("user", "u"),))
    table = readers.read_orders(SimpleNamespace(read=reader), source, cfg)
    assert table.count() == 10 and reader.options_seen["user"] == "u"
    assert reader.options_seen["predicates"] == ["customer_id < 'f' OR customer_id IS NULL", "customer_id >= 'f' AND customer_id < 'q'", "customer_id >= 'q'"]
    readers.read_orders(SimpleNamespace(read=reader), replace(source, split="hash"), cfg)
    assert len(reader.options_seen["predicates"]) == 3 and "hashtext" in reader.options_seen["predicates"][0]
    with pytest.raises(ValueError, match="range, hash or counts"):
        readers.read_orders(SimpleNamespace(read=reader), replace(source, split="luck"), cfg)


# ---------------------------------------------------------------- merged states


def test_merged_states_equal_the_whole_history(spark, cfg, orders_of):
    rows = [(c, o % 37, o % 300 + 1, None if o % 11 == 0 else o * 1.1 + (c or 0), "e", None if o % 7 == 0 else o % 2) for c in (1, 2, None) for o in range(90)]
    rows += [(3, 900, 5, 1e9, "e", 0), (3, 901, 6, 1e9 + 1e-3, "e", 1), (4, 1, 9, None, "e", None), (5, None, 2, 3.0, "e", 0), (6, 8, -4, 1.0, "e", 0)]
    orders = stage(orders_of(rows).repartition(4), "state_test")
    part = F.pmod(F.hash("order_id", "order_date"), F.lit(3))
    parts = [state.part_state(orders.where(part == k), cfg) for k in range(3)]
    whole = by_key(state.state_features(state.part_state(orders, cfg), cfg))
    base, values = by_key(features.customer_base(orders, cfg)), by_key(features.order_value_stats(orders, cfg))
    for merged in (state.merge(*parts), state.merge(state.merge(parts[2], parts[0]), parts[1])):
        got = by_key(state.state_features(merged, cfg))
        assert set(got) == set(whole) == set(base)
        for key, row in got.items():
            for name in ("frequency", "recency", "T"):
                assert row[name] == whole[key][name] == base[key][name]
            for name, source in (("monetary", base), ("avg_monetary", base), ("avg_order_value", values), ("std_order_value", values), ("return_rate", values)):
                expected = source[key][name]
                assert row[name] == (None if expected is None else pytest.approx(expected, rel=1e-9, abs=1e-6))
    with pytest.raises(ValueError):
        state.merge()
