"""A small shop made of hash draws: six consistent tables of any size.

Every attribute is drawn from a hash of its table, column and row number, so a table does
not depend on the order in which it is computed.  The two feature tables and the sales of
a product are counted from the drawn orders and behaviors.  All checks hold but two that
only warn: some orders have a coupon taken off before the total, and some users never order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.functions.parsing import MONEY, exprs, literal

OPENING = "TIMESTAMP_NTZ '2026-01-05 00:00:00'"
SEASON_DAYS, SEASON_MINUTES = 60, 60 * 24 * 60
CITIES = {"north": ("Aldhaven", "Brookmoor"), "south": ("Cliffden", "Dunmere"), "coast": ("Eastport",)}
CATEGORIES, MAKERS, PAYMENTS = 5, 7, ("card", "transfer", "voucher")


def sizes(users: int) -> dict[str, int]:
    """Rows per table; products and events follow the number of users."""
    if users < 3:
        raise ValueError("at least three users are needed")
    products = 5 + users // 4
    return {
        "users": users, "products": products, "orders": 2 * users, "user_behaviors": 5 * users, "user_features": users,
        "product_features": products,
    }


def fixture_sources(spark: SparkSession, users: int = 40) -> dict[str, DataFrame]:
    size = sizes(users)
    sold, seen = _sold(spark, size), _seen(spark, size)
    return {
        "users": _users(spark, size),
        "products": _products(spark, size, sold),
        "orders": _orders(sold),
        "user_behaviors": _behaviors(seen),
        "user_features": _user_features(spark, size, sold, seen),
        "product_features": _product_features(spark, size, sold, seen),
    }


def write_fixture(spark: SparkSession, folder: str, users: int = 40) -> None:
    for name, rows in fixture_sources(spark, users).items():
        written = rows.select(*[f"`{h}`" for h in c.HEADERS[name]]).write
        written.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")


# --- drawing ------------------------------------------------------------------------------------


def _draw(label: str, below: int) -> str:
    """A whole number from 0 to ``below - 1`` for the row."""
    return f"CAST(pmod(xxhash64({literal(label)}, id), {below}) AS INT)"


def _pick(label: str, values) -> str:
    return f"element_at(array({', '.join(literal(v) for v in values)}), {_draw(label, len(values))} + 1)"


def _id(prefix: str, number: str, digits: int) -> str:
    return f"concat('{prefix}', lpad({number}, {digits}, '0'))"


def _rows(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(1, count + 1)


def _text(rows: DataFrame, **columns: str) -> DataFrame:
    return rows.selectExpr(*[f"coalesce(CAST({value} AS STRING), '') AS `{name}`" for name, value in columns.items()])


def _coded(texts: dict[str, str], column: str) -> str:
    arms = " ".join(f"WHEN {literal(code)} THEN {literal(text)}" for code, text in texts.items())
    return f"CASE {column} {arms} END"


# --- tables -------------------------------------------------------------------------------------


def _users(spark: SparkSession, size: dict[str, int]) -> DataFrame:
    towns = [f"{region}/{town}" for region, all_towns in CITIES.items() for town in all_towns]
    town = _pick("town", towns)
    return _text(
        _rows(spark, size["users"]),
        user_id=_id("U", "id", 6),
        age=f"16 + {_draw('age', 70)}",
        gender=_pick("gender", c.GENDERS),
        province=f"split_part({town}, '/', 1)",
        city=f"split_part({town}, '/', 2)",
        registration_date=f"{OPENING} - make_dt_interval({_draw('joined', 700)} + 1)",
        member_level=_pick("level", c.MEMBER_LEVELS),
        account_balance=f"CAST({_draw('balance', 250_000)} / 100 AS {MONEY})",
        credit_score=f"350 + {_draw('credit', 550)}",
    )


def _price(number: str) -> str:
    return f"CAST((199 + pmod(xxhash64('price', {number}), 90000)) / 100 AS {MONEY})"


def _sold(spark: SparkSession, size: dict[str, int]) -> DataFrame:
    numbered = _rows(spark, size["orders"]).selectExpr(
        "id",
        f"CAST({_draw('buyer', size['users'])} + 1 AS BIGINT) AS buyer",
        f"CAST({_draw('bought', size['products'])} + 1 AS BIGINT) AS product",
        f"1 + {_draw('pieces', 4)} AS pieces",
        f"{_pick('status', c.STATUS_TEXT)} AS status",
        f"{OPENING} + make_dt_interval(0, 0, {_draw('ordered', SEASON_MINUTES)}) AS at",
        f"{_draw('coupon', 3)} = 0 AS coupon",
        f"{_draw('rebate', 4)} AS rebate",
        f"IF({_draw('rated', 3)} > 0, 1 + {_draw('stars', 5)}, NULL) AS stars",
    )
    priced = numbered.selectExpr("*", f"{_price('product')} AS price")
    # A coupon takes one off the price of every piece, down to nothing.
    each = "IF(coupon, greatest(price - 1, 0), price)"
    totalled = priced.selectExpr("*", f"CAST({each} * pieces AS {MONEY}) AS total")
    rebated = totalled.selectExpr("*", f"CAST(total * rebate / 20 AS {MONEY}) AS discount")
    return rebated.selectExpr("*", f"CAST(total - discount AS {MONEY}) AS paid")


def _orders(sold: DataFrame) -> DataFrame:
    sent = "status IN ('shipped', 'received', 'completed')"
    arrived = "status IN ('received', 'completed')"
    travel = _draw("travel", 48)
    return _text(
        sold,
        order_id=_id("O", "id", 8), user_id=_id("U", "buyer", 6), product_id=_id("P", "product", 6),
        quantity="pieces", order_date="at", order_status=_coded(c.STATUS_TEXT, "status"), payment_method=_pick("payment", PAYMENTS),
        unit_price="price", total_amount="total", discount="discount", actual_payment="paid",
        delivery_date=f"IF({sent}, at + make_dt_interval(0, 6 + {travel}), NULL)",
        receive_date=f"IF({arrived}, at + make_dt_interval(1, 12 + {travel}), NULL)",
        review_score="IF(status = 'completed', stars, NULL)",
        review_content="IF(status = 'completed' AND stars IS NOT NULL, concat('\"', stars, '\" stars, as drawn'), NULL)",
    )


def _seen(spark: SparkSession, size: dict[str, int]) -> DataFrame:
    # Looking is more frequent than wanting.
    kinds = [code for code, weight in zip(c.BEHAVIOR_TEXT, (4, 3, 2, 2), strict=True) for _ in range(weight)]
    return _rows(spark, size["user_behaviors"]).selectExpr(
        "id",
        f"CAST({_draw('visitor', size['users'])} + 1 AS BIGINT) AS visitor",
        f"CAST({_draw('looked', size['products'])} + 1 AS BIGINT) AS product",
        f"{_pick('kind', kinds)} AS kind",
        f"{OPENING} + make_dt_interval(0, 0, {_draw('visited', SEASON_MINUTES)}) AS at",
        f"{_draw('stayed', 900)} AS seconds",
    )


def _behaviors(seen: DataFrame) -> DataFrame:
    return _text(
        seen, behavior_id=_id("B", "id", 8), user_id=_id("U", "visitor", 6), product_id=_id("P", "product", 6),
        behavior_type=_coded(c.BEHAVIOR_TEXT, "kind"), behavior_time="at", duration_seconds="seconds",
    )


def _facts(entities: DataFrame, sold: DataFrame, seen: DataFrame, in_orders: str, in_behaviors: str) -> DataFrame:
    """Totals of every entity, 0 where it has none."""
    totals = {
        "orders": "count(1)", "spent": "sum(paid)", "finished": "count_if(status = 'completed')",
        "undone": f"count_if(status IN ({', '.join(literal(s) for s in c.CANCELLED_OR_REFUNDED)}))",
        "latest": "max(at)", "rating": "avg(IF(status = 'completed', stars, NULL))",
    }

    def grouped(rows: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
        return rows.groupBy(F.col(key).alias("id")).agg(*exprs(*[f"{measure} AS {name}" for name, measure in measures.items()]))

    kinds = {code: f"count_if(kind = '{code}')" for code in c.BEHAVIOR_TEXT}
    joined = entities.join(grouped(sold, in_orders, totals), "id", "left").join(grouped(seen, in_behaviors, kinds), "id", "left")
    kept = ("id", "latest", "rating")
    return joined.selectExpr(*kept, *[f"coalesce({n}, 0) AS {n}" for n in joined.columns if n not in kept])


def _products(spark: SparkSession, size: dict[str, int], sold: DataFrame) -> DataFrame:
    pieces = sold.groupBy("product").count().selectExpr("product AS id", "count AS times")
    return _text(
        _rows(spark, size["products"]).join(pieces, "id", "left"),
        product_id=_id("P", "id", 6), product_name="concat('article, no. ', id)", category=f"concat('group ', {_draw('category', CATEGORIES)})",
        brand=f"concat('maker ', {_draw('maker', MAKERS)})", price=_price("id"), sales_count="coalesce(times, 0)",
    )


def _user_features(spark: SparkSession, size: dict[str, int], sold: DataFrame, seen: DataFrame) -> DataFrame:
    closing = f"({OPENING} + make_dt_interval({SEASON_DAYS}))"
    visits, wishes = "(browse + click + favorite + cart)", "(favorite + cart)"
    low, middle, high = c.CONSUMPTION_LEVELS
    return _text(
        _facts(_rows(spark, size["users"]), sold, seen, "buyer", "visitor"),
        user_id=_id("U", "id", 6), total_spent="spent", order_count="orders", completed_orders="finished",
        avg_order_amount="round(coalesce(try_divide(spent, orders), 0), 2)",
        **{f"{code}_count": code for code in c.BEHAVIOR_TEXT},
        days_since_last_order=f"coalesce(timestampdiff(DAY, latest, {closing}), {c.LAST_ORDER_SENTINEL})",
        order_frequency=f"round(orders / {SEASON_DAYS}, 4)", repurchase_indicator="IF(orders > 1, 1, 0)",
        purchase_intent=f"round(coalesce(try_divide({wishes}, {visits}), 0), 3)",
        consumption_level=f"CASE WHEN spent > 2500 THEN {literal(high)} WHEN spent > 500 THEN {literal(middle)} ELSE {literal(low)} END",
        member_level_score=f"1 + {_draw('level', len(c.MEMBER_LEVELS))}",
    )


def _product_features(spark: SparkSession, size: dict[str, int], sold: DataFrame, seen: DataFrame) -> DataFrame:
    chinese = {code: f"{text}_count" for code, text in c.BEHAVIOR_TEXT.items()}
    return _text(
        _facts(_rows(spark, size["products"]), sold, seen, "product", "product"),
        product_id=_id("P", "id", 6), total_revenue="spent", total_sales="orders", completed_count="finished", cancel_count="undone",
        **{chinese[code]: code for code in c.BEHAVIOR_TEXT},
        conversion_rate="round(coalesce(try_divide(finished, orders), 0), 3)", avg_review_score="round(rating, 2)",
        popularity_score="round(ln(1 + orders + browse + click), 3)",
    )
