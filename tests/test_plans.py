"""Plan shape: no Python workers, no pair products, pruned scans."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartwright.operators.relations import ranked
from cartwright.sources.store import scratch_store

LAZY = [
    "order_status_summary", "daily_commerce", "hourly_behavior", "customer_summary", "customer_segments", "sequential_funnel",
    "category_ranking", "executive_kpis", "orders_validated", "quarantine_rows", "user_feature_mismatches", "orphan_rows",
]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_products(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|Scan ExistingRDD", text)


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["hourly_behavior"](spark, SMALL))
    assert "props" not in text
    assert "l_tax" not in plan(entry.queries()["fact_order"](spark, SMALL))


def test_no_expand_for_distinct_counts(spark):
    assert "Expand" not in plan(entry.queries()["daily_commerce"](spark, SMALL))


def test_large_parents_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()["fact_order"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one broadcast left is the seven-row status dimension.
    assert len(re.findall(r"BroadcastHashJoin", text)) == 1


def test_ranking_needs_no_single_task(spark):
    """Ranks of many categories, most of one amount, equal a plain count; no window runs over all rows."""
    rows = spark.range(3000).selectExpr(
        "concat('name ', conv(id * 7919 % 3000, 10, 36), IF(id % 2 = 0, 'é', '')) AS name", "CAST(IF(id % 3 = 0, id % 400 - 50, 0) / 4 AS DECIMAL(18,2)) AS amount"
    )
    written = scratch_store(spark).keep("rows", rows.unionAll(spark.sql("SELECT 'last', CAST(NULL AS DECIMAL(18,2))")))
    found = ranked(written, "place", "amount", "name")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    got = [(r["name"], r["amount"]) for r in sorted(found.collect(), key=lambda r: r["place"])]
    expected = sorted(((r["name"], r["amount"]) for r in written.collect()), key=lambda r: (r[1] is None, -(r[1] or 0), r[0].encode()))
    assert got == expected and [r["place"] for r in found.orderBy("place").collect()] == list(range(1, 3002))
    assert ranked(written.limit(0), "place", "amount", "name").count() == 0
    # The rows of the most common amount lie in several ranges.
    common = found.filter("amount = 0").select(F.min("place").alias("low"), F.max("place").alias("high")).first()
    assert common["high"] - common["low"] > 1000
