"""Partitions replaced by change sets equal a full rebuild and leave the others alone."""

from pathlib import Path

import pytest

from cartwright.plans import activity, incremental
from cartwright.plans.arrivals import change_sets
from cartwright.plans.incremental import BEHAVIORS, ORDERS, PartitionedLayers
from cartwright.plans.warehouse import Warehouse
from cartwright.sources import fixture, folders


@pytest.fixture(scope="module")
def facts(spark):
    w = Warehouse(spark, fixture.fixture_sources(spark, 60))
    return {ORDERS: w.fact_order.drop("source_file", "ingested_at").cache(), BEHAVIORS: w.fact_behavior.drop("source_file", "ingested_at").cache()}


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=str)


def files(folder, table):
    found = {}
    for path in Path(folder, table).rglob("part-*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def test_change_sets_equal_a_rebuild(spark, folder, facts):
    layers = PartitionedLayers(spark, folder, incremental.MONTH)
    for fact, rows in facts.items():
        sets = change_sets(rows, fact)
        layers.apply(fact, "one", sets.first, sets.first.select(fact.key))
        before = {d.name: files(folder, d.name) for d in (fact, *fact.dependents)}
        parts = layers.apply(fact, "two", sets.second, sets.second_keys)
        assert parts and rows_of(layers.read(fact.name).drop("part")) == rows_of(rows)
        for name, old in before.items():
            now = files(folder, name)
            same = {p for p in now if p.removeprefix("part=") not in parts}
            assert same and all(now[p] == old[p] for p in same)
            assert all(now[p] != old.get(p) for p in now if p not in same)
        again = layers.apply(fact, "two", sets.second, sets.second_keys)
        assert again and rows_of(layers.read(fact.name).drop("part")) == rows_of(rows)
    assert rows_of(layers.daily_commerce()) == rows_of(activity.daily_commerce(facts[ORDERS]))
    assert rows_of(layers.order_status_summary()) == rows_of(activity.order_status_summary(facts[ORDERS]))
    assert rows_of(layers.hourly_behavior()) == rows_of(activity.hourly_behavior(facts[BEHAVIORS]))


def test_withdrawn_rows_take_their_partition_along(spark, folder, facts):
    layers = PartitionedLayers(spark, folder)
    rows = facts[ORDERS].filter("order_id <= 'O00000005'")
    layers.apply(ORDERS, "all", rows, rows.select("order_id"))
    days = {r["part"] for r in layers.read("fact_order").select("part").distinct().collect()}
    layers.apply(ORDERS, "gone", rows.limit(0), rows.filter("order_id = 'O00000003'").select("order_id"))
    assert rows_of(layers.read("fact_order").drop("part")) == rows_of(rows.filter("order_id <> 'O00000003'"))
    assert {r["part"] for r in layers.read("fact_order").select("part").distinct().collect()} <= days
    assert {p.name for p in Path(folder, "daily_commerce").glob("part=*")} == {
        f"part={r['order_date']}" for r in rows.filter("order_id <> 'O00000003'").select("order_date").distinct().collect()
    }
    # A change set of keys that nobody knows touches nothing.
    assert layers.apply(ORDERS, "unknown", rows.limit(0), spark.sql("SELECT 'O99999999' AS order_id")) == []


def test_a_broken_replacement_is_finished(spark, folder, facts, monkeypatch):
    layers = PartitionedLayers(spark, folder, incremental.MONTH)
    sets = change_sets(facts[ORDERS], ORDERS)
    layers.apply(ORDERS, "one", sets.first, sets.first.select("order_id"))
    real, calls = PartitionedLayers._replace, []

    def breaks(self, name, rows, parts):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("stopped between fact and dependents")
        real(self, name, rows, parts)

    monkeypatch.setattr(PartitionedLayers, "_replace", breaks)
    with pytest.raises(OSError):
        layers.apply(ORDERS, "two", sets.second, sets.second_keys)
    assert folders.exists(spark, f"{folder}/pending.json")
    monkeypatch.undo()
    PartitionedLayers(spark, folder, incremental.MONTH).recover()
    assert not folders.exists(spark, f"{folder}/pending.json")
    assert rows_of(layers.daily_commerce()) == rows_of(activity.daily_commerce(facts[ORDERS]))


def test_sketches_merge_over_days(spark, folder):
    """Distinct users over 40 days in which most users order many times, within four standard errors."""
    rows = spark.range(60000).selectExpr(
        "concat('O', id) AS order_id", "concat('U', pmod(xxhash64(id), 20000)) AS user_id", "'paid' AS status_code",
        "date_add(DATE '2024-01-01', CAST(id % 40 AS INT)) AS order_date",
    )
    fact = incremental.PartitionedFact("fact_order", "order_id", "order_date", (incremental.Dependent("customer_sketches", incremental._customer_sketches),))
    layers = PartitionedLayers(spark, folder, incremental.MONTH)
    layers.apply(fact, "one", rows, rows.select("order_id"))
    for first, last in ((None, None), ("2024-01-05", "2024-01-20"), ("2024-02-01", None)):
        span = rows.filter(f"order_date BETWEEN '{first or '2024-01-01'}' AND '{last or '2025-01-01'}'")
        exact = span.select("user_id").distinct().count()
        estimate = layers.approximate_customers(first, last).first()["customers"]
        assert abs(estimate - exact) <= 4 * incremental.SKETCH_ERROR * exact


def test_first_change_set_is_written_once_and_replacing_shuffles_nothing(spark, folder, facts, monkeypatch):
    layers, rows, kept, plans = PartitionedLayers(spark, folder, incremental.MONTH), facts[ORDERS], [], []
    keep, replace = incremental.ParquetStore.keep, PartitionedLayers._replace

    def noted(store, name, *args, **options):
        kept.append(name)
        return keep(store, name, *args, **options)

    def planned(self, name, rows, parts):
        with monkeypatch.context() as patch:
            hint = type(rows).hint
            patch.setattr(type(rows), "hint", lambda *args: plans.append(name) or hint(*args))
            replace(self, name, rows, parts)

    monkeypatch.setattr(incremental.ParquetStore, "keep", noted)
    monkeypatch.setattr(PartitionedLayers, "_replace", planned)
    layers.apply(ORDERS, "one", rows, rows.select("order_id"))
    assert kept == ["fact_order", *[d.name for d in ORDERS.dependents]] and not plans
    assert rows_of(layers.read("fact_order").drop("part")) == rows_of(rows)


def test_an_empty_first_change_set_leaves_nothing(spark, folder, facts):
    layers, none = PartitionedLayers(spark, folder, incremental.MONTH), facts[ORDERS].limit(0)
    assert layers.apply(ORDERS, "none", none, none.select("order_id")) == []
    assert not layers.exists("fact_order") and not Path(folder, "pending-none").exists()
