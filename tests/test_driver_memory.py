"""What bounds the driver's memory in a release: one layer at a time, checks measured part by part, freed memory given back."""

import threading
import time
from datetime import datetime

import pytest

import __spark_entry__ as entry
from cartwright import contract as c
from cartwright.plans import arrivals, quality, release
from cartwright.plans.warehouse import Warehouse
from cartwright.session import give_back
from cartwright.sources import fixture
from cartwright.sources.store import scratch_store


class Meter:
    """How many jobs ran at once, and their names in order."""

    def __init__(self, spark):
        self.spark, self.names, self.now, self.most, self.lock = spark, [], 0, 0, threading.Lock()

    def run(self, name):
        with self.lock:
            self.names.append(name)
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(0.02)
        with self.lock:
            self.now -= 1


def test_layers_are_made_one_after_the_other(spark):
    meter = Meter(spark)

    class Layers:
        def __getattr__(self, name):
            meter.run(name)

    layers = Layers()
    layers.spark = spark
    Warehouse.build(layers)
    assert meter.most == 1
    assert meter.names == [name for wave in Warehouse.FACT_WAVES + Warehouse.REPORT_WAVES for name in wave]


def test_inputs_are_kept_one_after_the_other(spark):
    meter = Meter(spark)
    meter.keep = lambda name, rows: meter.run(name) or rows
    assert release._kept_inputs(meter, {"a": 1, "b": 2, "c": 3}) == {"a": 1, "b": 2, "c": 3}
    assert (meter.most, meter.names) == (1, ["src_a", "src_b", "src_c"])


def test_text_files_are_written_one_after_the_other(spark):
    meter = Meter(spark)

    class Rows:
        sparkSession = spark

        def __getattr__(self, name):
            return self if name == "write" else lambda *_: self

        def csv(self, path):
            meter.run(path.rsplit("/", 1)[1])

    arrivals.write_text_files({name: Rows() for name in c.HEADERS}, "in")
    assert (meter.most, meter.names) == (1, [f"{name}.csv" for name in c.HEADERS])


@pytest.fixture(scope="module")
def built(spark):
    w = Warehouse(spark, fixture.fixture_sources(spark), store=scratch_store(spark), run_at=datetime(2026, 4, 1))
    w.build()
    return w


def test_measured_in_parts_is_the_measurement(built):
    whole, parts = quality.measurement(built), quality.measured(built)
    assert parts.schema.simpleString() == whole.schema.simpleString()
    assert parts.collect() == whole.collect()


def test_measured_row_reads_no_layer_again(built):
    plan = quality.measured(built)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan


def test_give_back_leaves_the_session_as_it_is(spark):
    assert isinstance(give_back(spark), bool)
    assert spark.range(3).count() == 3


def test_republished_outputs_are_compared_one_after_the_other(spark, monkeypatch):
    changed, *equal = c.SERVING_SORT_KEYS
    rows = {output: spark.range(7, 10).selectExpr("id", "IF(id = 8, NULL, 'a') AS text") for output in (changed, *equal)}
    releases = iter([rows, rows | {changed: spark.range(8, 11).selectExpr("id", "IF(id = 8, NULL, 'a') AS text")}])
    monkeypatch.setattr(entry, "_publication", lambda *_, **__: "root")
    monkeypatch.setattr(entry, "_release", lambda *_: None)
    monkeypatch.setattr(entry.release, "current_release", lambda *_: "folder")
    monkeypatch.setattr(entry.release, "read_release", lambda *_: (next(releases), []))
    found = entry.republished_outputs(spark, "")
    assert "Range (7" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(row) for row in found.collect()] == [(changed, 3, 2), *[(output, 3, 0) for output in equal]]
