"""Mergeable measures against plain COUNT(DISTINCT) aggregates."""

import random

import pytest

from cartwright.functions import measures as m
from cartwright.operators.relations import duplicate_keys, orphans, side_by_side


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice("xyz"), None if rng.random() < 0.05 else rng.randrange(20), rng.randrange(1, 9), rng.random() < 0.4)
        for _ in range(500)
    ] + [("hot", 3, 1, True)] * 300
    frame = spark.createDataFrame(rows, "kind STRING, buyer INT, n INT, good BOOLEAN").selectExpr(
        "kind", "buyer", "n", "good", "CAST(n * 1.25 AS DECIMAL(18,2)) AS amount"
    )
    frame.createOrReplaceTempView("sales")
    return frame


MEASURES = {
    "n_rows": m.row_count(), "buyers": m.entities(), "good_rows": m.rows_where("good"),
    "good_buyers": m.entities_where("good"), "repeat_buyers": m.entities_where("good", at_least=2),
    "amount_sum": m.total("amount"), "good_amount": m.total_where("good", "amount"),
    "mean_amount": m.mean("amount"), "mean_good": m.mean("n", "good"),
    "least": m.earliest("n"), "most": m.latest("n"),
}
SQL = """SELECT {key} count(*) n_rows, count(DISTINCT buyer) buyers, sum(IF(good, 1, 0)) good_rows,
    count(DISTINCT IF(good, buyer, NULL)) good_buyers, round(sum(amount), 2) amount_sum,
    round(sum(IF(good, amount, 0)), 2) good_amount, round(avg(amount), 2) mean_amount,
    round(avg(IF(good, n, NULL)), 2) mean_good, min(n) least, max(n) most FROM {source} {group}"""


def test_grouped(spark, sales):
    found = {r["kind"]: r.asDict() for r in m.report(sales, ["kind"], "buyer", MEASURES).collect()}
    for row in spark.sql(SQL.format(key="kind,", source="sales", group="GROUP BY kind")).collect():
        for name, value in row.asDict().items():
            assert found[row["kind"]][name] == value, (row["kind"], name)
    repeat = spark.sql(
        "SELECT kind, count(*) n FROM (SELECT kind, buyer FROM sales WHERE good AND buyer IS NOT NULL"
        " GROUP BY kind, buyer HAVING count(*) >= 2) GROUP BY kind"
    )
    assert {r["kind"]: r["n"] for r in repeat.collect()} == {k: v["repeat_buyers"] for k, v in found.items()}


@pytest.mark.parametrize("condition", ["true", "false"])
def test_global_even_when_empty(spark, sales, condition):
    found = m.report(sales.filter(condition), [], "buyer", MEASURES).first().asDict()
    expected = spark.sql(SQL.format(key="", source="sales", group=f"WHERE {condition}")).first().asDict()
    assert {name: found[name] for name in expected} == expected


def test_entity_may_be_a_key(sales):
    rows = m.report(sales, ["kind"], "kind", {"kinds": m.entities()}).collect()
    assert {r["kinds"] for r in rows} == {1}


def test_side_by_side_keeps_nulls(spark):
    one, two = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), spark.sql("SELECT DATE '2024-01-01' AS d")
    row = side_by_side([one, two]).first()
    assert (row["a"], row["b"], str(row["d"])) == (1, None, "2024-01-01")


def test_duplicates_and_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), ("z",), (None,)], "k STRING")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k STRING")
    found = {r["source_table"]: r["duplicate_rows"] for r in duplicate_keys({"c": (child, "k"), "p": (parent, "k")}).collect()}
    assert found == {"c": 3, "p": 1}  # COUNT(*) - COUNT(DISTINCT k) also counts the NULL key
    assert orphans([("c", child, "k", "p")], {"p": (parent, "k")}).first()["orphan_rows"] == 3
