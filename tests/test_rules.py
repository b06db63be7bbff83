"""Row rules: every code can fire, order of codes, three-valued logic, text guards."""

import pytest

from cartwright import contract as c
from cartwright.operators.validation import judge
from cartwright.plans.rulebook import RULEBOOK, raw_contract
from cartwright.plans.warehouse import Warehouse
from cartwright.sources.star_schema import StarSources
from conftest import SMALL

GOOD = {
    "users": ("U000001", "30", "男", "东", "东城", "2024-01-01 00:00:00", "普通会员", "10.00", "700"),
    "products": ("P000001", "thing", "kind", "maker", "9.99", "3"),
    "orders": (
        "O00000001", "U000001", "P000001", "2", "2024-02-01 10:00:00", "已完成", "card", "5.00", "10.00", "1.00",
        "9.00", "2024-02-03 10:00:00", "2024-02-05 10:00:00", "5", "fine",
    ),
    "user_behaviors": ("B00000001", "U000001", "P000001", "浏览", "2024-02-01 09:00:00", "30"),
    "user_features": ("U000001", "9.00", "1.0", "1", "9.00", "1", "0", "0", "0", "3", "1", "0", "0.5", "中", "1"),
    "product_features": ("P000001", "9.00", "1", "1", "0", "0", "0", "1", "0", "1.0", "", "0.02"),
}


def reasons(spark, table, ids=c.STRICT_IDS, corrupt=None, **changes):
    row = dict(zip(c.HEADERS[table], GOOD[table], strict=True)) | changes | {"_corrupt_record": corrupt}
    schema = ", ".join(f"`{name}` STRING" for name in row)
    raw = raw_contract(spark.createDataFrame([tuple(row.values())], schema), table)
    return judge(raw, RULEBOOK[table](ids)).first()["local_reasons"]


@pytest.mark.parametrize("table", list(c.HEADERS))
def test_sound_row_has_no_reason(spark, table):
    assert reasons(spark, table) == []


@pytest.mark.parametrize(
    "table, changes, expected",
    [
        ("users", {"age": "abc"}, ["invalid_age_parse"]),
        ("users", {"age": "12"}, ["invalid_age"]),
        ("users", {"age": None, "credit_score": "x"}, ["invalid_age_parse", "invalid_credit_score_parse"]),
        ("users", {"user_id": " U000001 "}, []),
        ("users", {"user_id": "U0000012"}, ["invalid_user_id"]),
        ("users", {"user_id": None}, ["invalid_user_id"]),
        ("users", {"gender": "  "}, ["invalid_gender"]),
        ("users", {"city": "\t"}, []),
        ("users", {"account_balance": "-0.01"}, ["invalid_account_balance"]),
        ("orders", {"quantity": "0"}, ["invalid_quantity"]),
        ("orders", {"quantity": "1.5"}, ["invalid_quantity_parse"]),
        ("orders", {"actual_payment": "9.01"}, []),
        ("orders", {"actual_payment": "9.02"}, ["amount_equation_mismatch"]),
        ("orders", {"discount": "-1.00", "actual_payment": "11.00"}, ["invalid_amount"]),
        ("orders", {"delivery_date": " ", "receive_date": None, "review_score": ""}, []),
        ("orders", {"delivery_date": "later", "review_score": "6"}, ["invalid_delivery_date", "invalid_review_score"]),
        ("user_features", {"order_count": "6.5"}, ["invalid_order_count"]),
        ("user_features", {"order_count": "-1.0"}, ["invalid_feature_value"]),
        ("user_features", {"purchase_intent": "NaN"}, ["invalid_purchase_intent"]),
        ("user_features", {"repurchase_indicator": "2"}, ["invalid_repurchase_indicator"]),
        ("product_features", {"avg_review_score": "0.5"}, ["invalid_review_score"]),
    ],
)
def test_codes(spark, table, changes, expected):
    assert reasons(spark, table, **changes) == expected


def test_malformed_comes_first(spark):
    assert reasons(spark, "products", corrupt="P,1", price="x") == ["malformed_csv", "invalid_price_parse"]
    assert reasons(spark, "products", corrupt="  ") == []


def test_wide_ids_accept_longer_keys(spark):
    assert reasons(spark, "users", c.WIDE_IDS, user_id="U1234567") == []
    assert reasons(spark, "users", c.WIDE_IDS, user_id="U12345") == ["invalid_user_id"]


def test_every_code_fires_on_damaged_tables(spark):
    folder = SMALL.replace("0.001", "0.01")
    sources = StarSources(spark, folder, spoiled=True)
    total = 0
    for name, table in RULEBOOK.items():
        rules = table(c.WIDE_IDS)
        rows = judge(raw_contract(sources[name], name), rules).selectExpr("explode(local_reasons) AS r").distinct()
        assert {row["r"] for row in rows.collect()} == {rule.code for rule in rules.rules}, name
        total += len(rules.rules)
    assert total == 87


def small_warehouse(spark, **tables):
    frames = {}
    for name, headers in c.HEADERS.items():
        schema = ", ".join(f"`{h}` STRING" for h in headers)
        frames[name] = spark.createDataFrame(tables.get(name, [GOOD[name]]), schema)
    return Warehouse(spark, frames)


def changed(table, **changes):
    return tuple((dict(zip(c.HEADERS[table], GOOD[table], strict=True)) | changes).values())


def test_invalid_parent_breaks_the_key_and_its_time_still_counts(spark):
    w = small_warehouse(
        spark,
        users=[changed("users", age="abc", registration_date="2024-03-01 00:00:00")],
        orders=[GOOD["orders"]],
    )
    assert w.staged_orders.first()["reasons"] == ["broken_user_fk", "event_before_registration"]


def test_absent_parents(spark):
    w = small_warehouse(spark, orders=[changed("orders", user_id="U999999", product_id="P999999")])
    assert w.staged_orders.first()["reasons"] == ["broken_user_fk", "broken_product_fk"]


def test_repeated_parent_repeats_the_child(spark):
    w = small_warehouse(spark, users=[GOOD["users"], GOOD["users"]])
    assert w.staged_orders.count() == 2


def test_order_and_split(spark):
    w = small_warehouse(spark, orders=[GOOD["orders"], changed("orders", order_id="O00000002", quantity="x", user_id="U9")])
    assert w.valid("orders").count() == 1
    row = w.quarantine.filter("source_table = 'orders'").first()
    assert row["record_key"] == "O00000002"
    assert row["rejection_reasons"] == "invalid_user_id;invalid_quantity_parse;broken_user_fk"
