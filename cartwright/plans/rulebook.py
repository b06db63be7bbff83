"""Parsing and rejection rules of the six input tables.

Rule codes are fixed values and stand in evaluation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright import contract as c
from cartwright.functions.parsing import (
    MONEY,
    WHOLE_DECIMAL,
    any_of,
    blank,
    blank_to_null,
    differs,
    has_fraction,
    listed,
    literal,
    parsed,
    parsed_if_present,
    trimmed,
    whole_number,
)
from cartwright.operators.validation import Rule, TableRules

CORRUPT = "corrupt_record"
LINEAGE = ("source_file", "ingested_at")


def raw(name: str) -> str:
    return f"{name}_raw"


def raw_contract(source: DataFrame, table: str) -> DataFrame:
    """Text projection under stable ``*_raw`` names, plus corrupt text and lineage.

    A source without corrupt-record or lineage columns gets NULLs for them.
    """

    def extra(name: str, target: str, dtype: str) -> str:
        return f"CAST({name if name in source.columns else 'NULL'} AS {dtype}) AS {target}"

    return source.selectExpr(
        *[f"CAST(`{h}` AS STRING) AS {raw(c.ASCII_NAMES.get(h, h))}" for h in c.HEADERS[table]],
        extra("_corrupt_record", CORRUPT, "STRING"),
        extra("_source_file", "source_file", "STRING"),
        extra("_ingested_at", "ingested_at", "TIMESTAMP"),
    )


def _malformed() -> Rule:
    return Rule("malformed_csv", f"NOT {blank(CORRUPT)}")


def _bad_id(name: str, pattern: str) -> Rule:
    return Rule(f"invalid_{name}", f"{blank(raw(name))} OR NOT {name} RLIKE {literal(pattern)}")


def _unparsed(value: str, code: str | None = None) -> Rule:
    return Rule(code or f"invalid_{value}_parse", f"{value} IS NULL")


def _outside(value: str, low: int, high: int) -> Rule:
    return Rule(f"invalid_{value}", f"{value} NOT BETWEEN {low} AND {high}")


def _negative(code: str, *values: str) -> Rule:
    return Rule(code, any_of(f"{v} < 0" for v in values))


def _not_listed(name: str, allowed: tuple[str, ...]) -> Rule:
    return Rule(f"invalid_{name}", f"{blank(raw(name))} OR {name} NOT IN ({listed(allowed)})")


def _missing(code: str, *names: str) -> Rule:
    return Rule(code, any_of(blank(raw(n)) for n in names))


def _bad_optional(code: str, name: str, value: str, outside: tuple[int, int] | None = None) -> Rule:
    bad = [f"{value} IS NULL"]
    if outside:
        bad.append(f"{value} NOT BETWEEN {outside[0]} AND {outside[1]}")
    return Rule(code, f"NOT {blank(raw(name))} AND {any_of(bad)}")


def _texts(*names: str) -> dict[str, str]:
    return {name: trimmed(raw(name)) for name in names}


def _typed(dtype: str, *names: str) -> dict[str, str]:
    return {name: parsed(raw(name), dtype) for name in names}


def _as_is(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def users(ids: c.IdFormats) -> TableRules:
    return TableRules(
        name="users",
        key="user_id",
        parse={
            **_texts("user_id", "gender", "province", "city", "member_level"),
            **_typed("INT", "age", "credit_score"),
            **_typed(MONEY, "account_balance"),
            "registration_ts": parsed(raw("registration_date"), "TIMESTAMP"),
        },
        rules=[
            _malformed(),
            _bad_id("user_id", ids.user),
            _unparsed("age"),
            _outside("age", 13, 100),
            _not_listed("gender", c.GENDERS),
            _missing("missing_region", "province", "city"),
            _unparsed("registration_ts", "invalid_registration_date"),
            _not_listed("member_level", c.MEMBER_LEVELS),
            _unparsed("account_balance"),
            _negative("invalid_account_balance", "account_balance"),
            _unparsed("credit_score"),
            _outside("credit_score", 0, 1000),
        ],
        keep=_as_is(
            "user_id", "age", "gender", "province", "city", "registration_ts",
            "member_level", "account_balance", "credit_score",
        ),
    )


def products(ids: c.IdFormats) -> TableRules:
    return TableRules(
        name="products",
        key="product_id",
        parse={
            **_texts("product_id", "product_name", "category", "brand"),
            **_typed(MONEY, "price"),
            **_typed("BIGINT", "sales_count"),
        },
        rules=[
            _malformed(),
            _bad_id("product_id", ids.product),
            _missing("missing_product_name", "product_name"),
            _missing("missing_category", "category"),
            _missing("missing_brand", "brand"),
            _unparsed("price"),
            _negative("invalid_price", "price"),
            _unparsed("sales_count"),
            _negative("invalid_sales_count", "sales_count"),
        ],
        keep=_as_is("product_id", "product_name", "category", "brand", "price", "sales_count"),
    )


def orders(ids: c.IdFormats) -> TableRules:
    amounts = ("unit_price", "total_amount", "discount", "actual_payment")
    return TableRules(
        name="orders",
        key="order_id",
        parse={
            **_texts("order_id", "user_id", "product_id", "order_status", "payment_method"),
            **_typed("INT", "quantity"),
            **_typed(MONEY, *amounts),
            "order_ts": parsed(raw("order_date"), "TIMESTAMP"),
            "delivery_ts": parsed_if_present(raw("delivery_date"), "TIMESTAMP"),
            "receive_ts": parsed_if_present(raw("receive_date"), "TIMESTAMP"),
            "review_score": parsed_if_present(raw("review_score"), "INT"),
            "review_content": blank_to_null(raw("review_content")),
        },
        rules=[
            _malformed(),
            _bad_id("order_id", ids.order),
            _bad_id("user_id", ids.user),
            _bad_id("product_id", ids.product),
            _unparsed("quantity"),
            Rule("invalid_quantity", "quantity <= 0"),
            _unparsed("order_ts", "invalid_order_date"),
            _not_listed("order_status", tuple(s.source_status for s in c.ORDER_STATUSES)),
            _missing("missing_payment_method", "payment_method"),
            *[_unparsed(amount) for amount in amounts],
            _negative("invalid_amount", *amounts),
            Rule(
                "amount_equation_mismatch",
                differs("total_amount - discount", "actual_payment", c.AMOUNT_TOLERANCE),
            ),
            _bad_optional("invalid_delivery_date", "delivery_date", "delivery_ts"),
            _bad_optional("invalid_receive_date", "receive_date", "receive_ts"),
            _bad_optional("invalid_review_score", "review_score", "review_score", (1, 5)),
        ],
        keep=_as_is(
            "order_id", "user_id", "product_id", "quantity", "order_ts", "order_status",
            "payment_method", "unit_price", "total_amount", "discount", "actual_payment",
            "delivery_ts", "receive_ts", "review_score", "review_content",
        ),
    )


def user_behaviors(ids: c.IdFormats) -> TableRules:
    return TableRules(
        name="user_behaviors",
        key="behavior_id",
        parse={
            **_texts("behavior_id", "user_id", "product_id", "behavior_type"),
            **_typed("INT", "duration_seconds"),
            "behavior_ts": parsed(raw("behavior_time"), "TIMESTAMP"),
        },
        rules=[
            _malformed(),
            _bad_id("behavior_id", ids.behavior),
            _bad_id("user_id", ids.user),
            _bad_id("product_id", ids.product),
            _not_listed("behavior_type", tuple(b.source_behavior for b in c.BEHAVIORS)),
            _unparsed("behavior_ts", "invalid_behavior_time"),
            _unparsed("duration_seconds", "invalid_duration_parse"),
            _negative("invalid_duration", "duration_seconds"),
        ],
        keep=_as_is(
            "behavior_id", "user_id", "product_id", "behavior_type", "behavior_ts", "duration_seconds"
        ),
    )


def user_features(ids: c.IdFormats) -> TableRules:
    order_counts = ("order_count", "completed_orders")
    behavior_counts = ("browse_count", "click_count", "favorite_count", "cart_count")
    counts = order_counts + behavior_counts

    def integral(name: str) -> list[Rule]:
        return [_unparsed(name), Rule(f"invalid_{name}", has_fraction(name))]

    return TableRules(
        name="user_features",
        key="user_id",
        parse={
            **_texts("user_id", "consumption_level"),
            **_typed(MONEY, "total_spent"),
            **_typed(WHOLE_DECIMAL, *counts),
            **_typed("DECIMAL(18,4)", "avg_order_amount"),
            **_typed("INT", "days_since_last_order", "repurchase_indicator", "member_level_score"),
            **_typed("DOUBLE", "order_frequency", "purchase_intent"),
        },
        rules=[
            _malformed(),
            _bad_id("user_id", ids.user),
            _unparsed("total_spent"),
            *[rule for name in order_counts for rule in integral(name)],
            _unparsed("avg_order_amount"),
            *[rule for name in behavior_counts for rule in integral(name)],
            _unparsed("days_since_last_order"),
            _unparsed("order_frequency"),
            _unparsed("repurchase_indicator"),
            _unparsed("purchase_intent"),
            _unparsed("member_level_score"),
            _negative("invalid_feature_value", "total_spent", "avg_order_amount", *counts),
            Rule("invalid_repurchase_indicator", "repurchase_indicator NOT IN (0, 1)"),
            _outside("purchase_intent", 0, 1),
            _not_listed("consumption_level", c.CONSUMPTION_LEVELS),
        ],
        keep={
            **_as_is("user_id", "total_spent"),
            **{name: whole_number(name) for name in order_counts},
            **_as_is("avg_order_amount"),
            **{name: whole_number(name) for name in behavior_counts},
            **_as_is(
                "days_since_last_order", "order_frequency", "repurchase_indicator",
                "purchase_intent", "consumption_level", "member_level_score",
            ),
        },
    )


def product_features(ids: c.IdFormats) -> TableRules:
    counts = (
        "total_sales", "completed_count", "cancel_count", "cart_count",
        "favorite_count", "browse_count", "click_count",
    )
    return TableRules(
        name="product_features",
        key="product_id",
        parse={
            **_texts("product_id"),
            **_typed(MONEY, "total_revenue"),
            **_typed("BIGINT", *counts),
            **_typed("DOUBLE", "conversion_rate", "popularity_score"),
            "avg_review_score": parsed_if_present(raw("avg_review_score"), "DOUBLE"),
        },
        rules=[
            _malformed(),
            _bad_id("product_id", ids.product),
            _unparsed("total_revenue"),
            *[_unparsed(name) for name in counts],
            _unparsed("conversion_rate"),
            _unparsed("popularity_score"),
            _negative("invalid_feature_value", "total_revenue", *counts),
            _outside("conversion_rate", 0, 1),
            _bad_optional("invalid_review_score", "avg_review_score", "avg_review_score", (1, 5)),
        ],
        keep=_as_is(
            "product_id", "total_revenue", *counts, "conversion_rate",
            "avg_review_score", "popularity_score",
        ),
    )


RULEBOOK = {
    "users": users,
    "products": products,
    "orders": orders,
    "user_behaviors": user_behaviors,
    "user_features": user_features,
    "product_features": product_features,
}
