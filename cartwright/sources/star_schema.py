"""The six logical tables out of a star schema with an event log.

Everything is rendered to text under the contract headers, so the rule book parses
and judges it exactly like file input.  Whole tables are used; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.functions.parsing import MONEY, exprs, listed, literal, named
from cartwright.sources import folders
from cartwright.sources.store import LazyStore

KEY = "_k"
DELIVERED = ("shipped", "received", "completed")
RECEIVED = ("received", "completed")

MEMBER_LEVEL_OF_SEGMENT = dict(
    zip(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), c.MEMBER_LEVELS, strict=True)
)
BEHAVIOR_OF_EVENT = {"view": "browse", "click": "click", "signup": "favorite", "purchase": "cart"}

# Text damage for the rule queries: (header, modulus, remainder, replacement).  A row
# whose key leaves the remainder gets the replacement; all other rows stay as they are.
SPOILS: dict[str, list[tuple[str, int, int, str | None]]] = {
    "users": [
        ("_corrupt_record", 101, 1, "U1,broken"), ("user_id", 101, 2, "X12"), ("user_id", 101, 3, "  "),
        ("age", 101, 4, "abc"), ("age", 101, 5, " 12 "), ("age", 101, 6, None), ("gender", 101, 7, "?"),
        ("gender", 101, 8, ""), ("province", 101, 9, " "), ("city", 101, 10, None),
        ("registration_date", 101, 11, "2024-13-40 00:00:00"), ("registration_date", 101, 12, ""),
        ("member_level", 101, 13, "gold"), ("account_balance", 101, 14, "n/a"),
        ("account_balance", 101, 15, " 10.50 "), ("credit_score", 101, 16, "bad"),
        ("credit_score", 101, 17, "1001"), ("age", 103, 9, "xx"), ("credit_score", 103, 9, "-1"),
    ],
    "products": [
        ("_corrupt_record", 101, 1, "P1"), ("product_id", 101, 2, "P12"), ("product_id", 101, 3, ""),
        ("product_name", 101, 4, "  "), ("category", 101, 5, None), ("brand", 101, 6, " "),
        ("price", 101, 7, "free"), ("price", 101, 8, "-0.01"), ("sales_count", 101, 9, "many"),
        ("sales_count", 101, 10, "-5"), ("price", 103, 4, ""), ("sales_count", 103, 4, None),
    ],
    "orders": [
        ("_corrupt_record", 301, 1, "O1"), ("order_id", 301, 2, "12"), ("user_id", 301, 3, "U1"),
        ("user_id", 301, 4, "U99999999"), ("product_id", 301, 5, " "), ("product_id", 301, 6, "P99999999"),
        ("quantity", 301, 7, "abc"), ("quantity", 301, 8, "0"), ("quantity", 301, 9, " 3 "),
        ("order_date", 301, 10, "soon"), ("order_status", 301, 11, "lost"), ("order_status", 301, 12, ""),
        ("payment_method", 301, 13, " "), ("unit_price", 301, 14, "x"), ("total_amount", 301, 15, "x"),
        ("discount", 301, 16, "x"), ("actual_payment", 301, 17, "x"), ("unit_price", 301, 18, "-1"),
        ("actual_payment", 301, 19, "1.00"), ("delivery_date", 301, 20, "later"),
        ("receive_date", 301, 21, "later"), ("review_score", 301, 22, "9"), ("review_score", 301, 23, "good"),
        ("review_score", 301, 24, " 5 "), ("review_content", 301, 25, "  "), ("discount", 307, 13, "-2.00"),
    ],
    "user_behaviors": [
        ("_corrupt_record", 301, 1, "B1"), ("behavior_id", 301, 2, ""), ("user_id", 301, 3, None),
        ("user_id", 301, 4, "U99999999"), ("product_id", 301, 5, "Q000001"), ("behavior_type", 301, 6, ""),
        ("behavior_time", 301, 7, "not-a-timestamp"), ("duration_seconds", 301, 8, "abc"),
        ("duration_seconds", 301, 9, "-1"), ("duration_seconds", 301, 10, " 7 "),
        ("behavior_time", 307, 8, None),
    ],
    "user_features": [
        ("_corrupt_record", 101, 1, "F1"), ("user_id", 101, 2, "U7"), ("total_spent", 101, 3, "abc"),
        ("order_count", 101, 4, "6.5"), ("order_count", 101, 5, "six"), ("completed_orders", 101, 6, "1.25"),
        ("completed_orders", 101, 7, ""), ("avg_order_amount", 101, 8, "?"), ("browse_count", 101, 9, "0.1"),
        ("browse_count", 101, 10, "?"), ("click_count", 101, 11, "2.000001"), ("click_count", 101, 12, "?"),
        ("favorite_count", 101, 13, "3.3"), ("favorite_count", 101, 14, "?"), ("cart_count", 101, 15, "4.4"),
        ("cart_count", 101, 16, "?"), ("days_since_last_order", 101, 17, "?"),
        ("order_frequency", 101, 18, "?"), ("repurchase_indicator", 101, 19, "?"),
        ("purchase_intent", 101, 20, "?"), ("member_level_score", 101, 21, "?"),
        ("total_spent", 101, 22, "-1.00"), ("order_count", 101, 23, "-2.0"),
        ("repurchase_indicator", 101, 24, "2"), ("purchase_intent", 101, 25, "1.5"),
        ("consumption_level", 101, 26, ""), ("consumption_level", 101, 27, "max"),
    ],
    "product_features": [
        ("_corrupt_record", 101, 1, "F1"), ("product_id", 101, 2, "P7"), ("total_revenue", 101, 3, "?"),
        ("total_sales", 101, 4, "?"), ("completed_count", 101, 5, "?"), ("cancel_count", 101, 6, "?"),
        ("加购_count", 101, 7, "?"), ("收藏_count", 101, 8, "?"), ("浏览_count", 101, 9, "?"),
        ("点击_count", 101, 10, "?"), ("conversion_rate", 101, 11, "?"), ("popularity_score", 101, 12, "?"),
        ("total_sales", 101, 13, "-3"), ("conversion_rate", 101, 14, "1.01"),
        ("avg_review_score", 101, 15, "5.5"), ("avg_review_score", 101, 16, "?"),
        ("avg_review_score", 101, 17, " "),
    ],
}


# Parents that come twice in the variant with repeated keys: every so many-th.
REPEATS = {"users": 199, "products": 211}


# Values that replace faulty ones where the tables are wanted sound: every row stays, and what a rule or check would
# object to gets a value that it accepts.
REPAIRS: dict[str, dict[str, str]] = {
    "users": {
        "age": f"CAST(least({KEY} % 90 + 13, 100) AS STRING)",
        "account_balance": "replace(account_balance, '-', '')",
    },
    "products": {"brand": f"IF(trim(brand) = '', concat('Brand#', {KEY}), brand)"},
    "orders": {
        "delivery_date": f"IF(delivery_date = '' AND receive_date <> '', receive_date, IF(delivery_date = '' AND {KEY} % 211 = 0"
                         f" AND order_status = {literal(c.STATUS_TEXT['shipped'])}, order_date, delivery_date))",
    },
    "user_features": {
        # Takes back the offset by which some snapshots disagree with the facts.
        "total_spent": f"IF({KEY} % 97 = 0, CAST(CAST(total_spent AS {MONEY}) - 1 AS STRING), total_spent)",
    },
    "product_features": {"total_sales": f"IF({KEY} % 89 = 1, CAST(CAST(total_sales AS BIGINT) - 1 AS STRING), total_sales)"},
}


TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


def files_state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the tables' files: equal as long as nobody rewrites them."""
    found = []
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        whole = folders.entry(spark, path)
        found.append((table, whole, *(folders.entries(spark, path) if whole and whole.is_folder else ())))
    return tuple(found)


class StarSources(Mapping):
    """The six source tables, all text, keyed by logical name and planned on first use."""

    def __init__(self, spark: SparkSession, folder: str, spoiled: bool = False, repeated: bool = False, repaired: bool = False, store=None) -> None:
        """With a ``store`` the order and event rows, which several tables are made of, are written once."""
        self._spark = spark
        self._folder = folder
        self._spoiled = spoiled
        self._repeated = repeated
        self._repaired = repaired
        self._store = store or LazyStore()
        self._planned: dict[str, DataFrame] = {}
        self._lock = Lock()

    def __iter__(self) -> Iterator[str]:
        return iter(c.HEADERS)

    def __len__(self) -> int:
        return len(c.HEADERS)

    def __getitem__(self, name: str) -> DataFrame:
        # Tables built side by side share what is written once.
        with self._lock:
            if name not in self._planned:
                rows = getattr(self, f"_{name}")()
                if self._repeated and name in REPEATS:
                    rows = rows.unionByName(rows.filter(f"{KEY} % {REPEATS[name]} = 0"))
                self._planned[name] = _spoil(rows, SPOILS[name]) if self._spoiled else rows
            return self._planned[name]

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def _order_rows(self) -> DataFrame:
        rows = _order_rows(self._table("orders"), self._table("lineitem"))
        return self._store.keep("src_order_rows", _with_lines(rows, self._table("part")) if self._repaired else rows)

    @cached_property
    def _event_rows(self) -> DataFrame:
        rows = _event_rows(self._table("events"), self._table("part"))
        rows = rows.withColumn("behavior", F.coalesce("behavior", F.lit("browse"))) if self._repaired else rows
        return self._store.keep("src_event_rows", rows)

    def _users(self) -> DataFrame:
        return self._mended("users", _users(self._table("customer"), self._table("nation")))

    def _products(self) -> DataFrame:
        return self._mended("products", _products(self._table("part")))

    def _orders(self) -> DataFrame:
        return self._mended("orders", _orders(self._order_rows))

    def _user_behaviors(self) -> DataFrame:
        return _behaviors(self._event_rows)

    def _user_features(self) -> DataFrame:
        return self._mended("user_features", _user_features(self._table("customer"), self._order_rows, self._event_rows))

    def _product_features(self) -> DataFrame:
        return self._mended("product_features", _product_features(self._table("part"), self._order_rows, self._event_rows))

    def _mended(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumns({header: F.expr(text) for header, text in REPAIRS[name].items()}) if self._repaired else rows


def _spoil(rows: DataFrame, spoils: list[tuple[str, int, int, str | None]]) -> DataFrame:
    damaged: dict[str, str] = {}
    for header, modulus, remainder, replacement in spoils:
        before = damaged.get(header, "CAST(NULL AS STRING)" if header == "_corrupt_record" else f"`{header}`")
        damaged[header] = f"CASE WHEN {KEY} % {modulus} = {remainder} THEN {literal(replacement)} ELSE {before} END"
    untouched = [f"`{name}`" for name in rows.columns if name not in damaged]
    return rows.selectExpr(*untouched, *named(damaged))


def _padded_id(prefix: str, key: str, width: int) -> str:
    digits = f"CAST({key} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def _lookup(values: dict[str, str], key: str, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {literal(source)} THEN {literal(target)}" for source, target in values.items())
    return f"CASE {key} {arms} ELSE {otherwise} END"


def _fixed_point(units: str, digits: int) -> str:
    """Non-negative units of the last digit as decimal text."""
    base = 10**digits
    return f"concat(({units}) DIV {base}, '.', lpad(CAST(({units}) % {base} AS STRING), {digits}, '0'))"


def _as_text(key: str, columns: dict[str, str]) -> list[str]:
    return [f"{key} AS {KEY}", *named({name: f"CAST({text} AS STRING)" for name, text in columns.items()})]


def _users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").selectExpr(
        *_as_text(
            "c_custkey",
            {
                "user_id": _padded_id("U", "c_custkey", 6),
                "age": "13 + c_custkey % 90",
                "gender": f"element_at(array({listed(c.GENDERS)}), CAST(c_custkey % 3 + 1 AS INT))",
                "province": "n_name",
                "city": "concat('CITY_', c_nationkey)",
                "registration_date":
                    "concat(date_add(DATE '2020-01-01', CAST(c_custkey * 37 % 1500 AS INT)), ' 00:00:00')",
                "member_level": _lookup(MEMBER_LEVEL_OF_SEGMENT, "c_mktsegment", "c_mktsegment"),
                "account_balance": f"CAST(c_acctbal AS {MONEY})",
                "credit_score": "300 + c_custkey * 13 % 700",
            },
        )
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        *_as_text(
            "p_partkey",
            {
                "product_id": _padded_id("P", "p_partkey", 6),
                "product_name": "p_name",
                "category": "p_type",
                "brand": "CASE WHEN p_partkey % 97 = 0 THEN ' ' ELSE p_brand END",
                "price": f"CAST(p_retailprice AS {MONEY})",
                "sales_count": "p_size * 10",
            },
        )
    )


def _order_rows(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Typed orders with their line totals in cents; an order without lines keeps NULL totals."""
    lines = (
        lineitem.selectExpr(
            "l_orderkey", "l_partkey", "CAST(l_quantity AS BIGINT) AS pieces",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS price",
            "CAST(round(l_discount * 100) AS BIGINT) AS percent",
        )
        .groupBy("l_orderkey")
        .agg(
            *exprs(
                "min(l_partkey) AS product", "sum(pieces) AS quantity", "max(price) AS unit_price",
                "sum(price) AS total", "sum((price * percent + 50) DIV 100) AS discount",
            )
        )
    )
    status = """CASE
        WHEN o_orderstatus = 'O' THEN IF(o_orderpriority = '5-LOW', 'pending_payment', 'paid')
        WHEN o_orderstatus = 'P' THEN IF(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'shipped', 'received')
        WHEN o_orderpriority = '5-LOW' THEN 'refunded'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'cancelled'
        ELSE 'completed' END"""
    return (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .selectExpr(
            "o_orderkey AS k",
            # Orders of every tenth customer go to the neighbor, so some users never order.
            "o_custkey - IF(o_custkey % 10 = 9, 1, 0) AS buyer",
            "CAST(o_orderdate AS TIMESTAMP_NTZ) + INTERVAL '25' YEAR AS at",
            f"{status} AS status",
            "product", "quantity", "unit_price", "total", "discount", "total - discount AS paid",
        )
        .selectExpr("*", "CASE WHEN status = 'completed' AND k % 2 = 0 THEN 1 + k % 5 END AS score")
    )


def _orders(order_rows: DataFrame) -> DataFrame:
    return order_rows.selectExpr(
        *_as_text(
            "k",
            {
                "order_id": _padded_id("O", "k", 8),
                "user_id": _padded_id("U", "buyer", 6),
                "product_id": _padded_id("P", "product", 6),
                "quantity": "quantity",
                "order_date": "at",
                "order_status": _lookup(c.STATUS_TEXT, "status", "status"),
                "payment_method": "concat('method_', k % 5)",
                "unit_price": _fixed_point("unit_price", 2),
                "total_amount": _fixed_point("total", 2),
                "discount": _fixed_point("discount", 2),
                "actual_payment": _fixed_point("paid", 2),
                "delivery_date": f"CASE WHEN status IN ({listed(DELIVERED)}) AND k % 211 <> 0"
                                 " THEN CAST(at + INTERVAL '2' DAY AS STRING) ELSE '' END",
                "receive_date": f"CASE WHEN status IN ({listed(RECEIVED)})"
                                " THEN CAST(at + INTERVAL '4' DAY AS STRING) ELSE '' END",
                "review_score": "coalesce(CAST(score AS STRING), '')",
                "review_content": "CASE WHEN score IS NOT NULL THEN concat('review ', k) ELSE '' END",
            },
        )
    )


def _with_lines(order_rows: DataFrame, part: DataFrame) -> DataFrame:
    """Orders without lines get one piece of some product, for nothing."""
    parts = part.agg(*exprs("count(1) AS parts")).scalar()
    filled = {"product": "coalesce(product, k % parts)", "quantity": "coalesce(quantity, 1)"}
    filled |= {name: f"coalesce({name}, 0)" for name in ("unit_price", "total", "discount", "paid")}
    return order_rows.withColumn("parts", parts).withColumns({name: F.expr(text) for name, text in filled.items()}).drop("parts")


def _event_rows(events: DataFrame, part: DataFrame) -> DataFrame:
    parts = part.agg(*exprs("count(1) AS parts")).scalar()
    return events.withColumn("parts", parts).selectExpr(
        "event_id AS k",
        "user_id AS visitor",
        "event_id % parts AS product",
        "CAST(ts AS TIMESTAMP_NTZ) AS at",
        f"{_lookup(BEHAVIOR_OF_EVENT, 'event_type')} AS behavior",
        "event_type",
        "floor(value) AS seconds",
    )


def _behaviors(event_rows: DataFrame) -> DataFrame:
    return event_rows.selectExpr(
        *_as_text(
            "k",
            {
                "behavior_id": _padded_id("B", "k", 8),
                "user_id": _padded_id("U", "visitor", 6),
                "product_id": _padded_id("P", "product", 6),
                "behavior_type": _lookup(c.BEHAVIOR_TEXT, "behavior", "event_type"),
                "behavior_time": "at",
                "duration_seconds": "seconds",
            },
        )
    )


def _per(entity: DataFrame, key: str, order_rows: DataFrame, event_rows: DataFrame, buyer: str, visitor: str) -> DataFrame:
    """Order and behavior totals per entity over the rows that carry no local fault."""
    ordered = (
        order_rows.filter("product IS NOT NULL")
        .groupBy(F.col(buyer).alias("ordered_by"))
        .agg(
            *exprs(
                "count(1) AS orders", "count_if(status = 'completed') AS completed",
                f"count_if(status IN ({listed(c.CANCELLED_OR_REFUNDED)})) AS cancelled", "sum(paid) AS cents",
                "max(at) AS last_at", "sum(score) AS scores", "count(score) AS scored",
            )
        )
    )
    behaved = (
        event_rows.filter("behavior IS NOT NULL")
        .groupBy(F.col(visitor).alias("seen_by"))
        .agg(*exprs(*[f"count_if(behavior = '{b}') AS {b}" for b in c.BEHAVIOR_TEXT]))
    )
    counts = ("orders", "completed", "cancelled", "cents", "scored", *c.BEHAVIOR_TEXT)
    rows = entity.select(F.col(key).alias("k"))
    joined = rows.join(ordered, rows["k"] == ordered["ordered_by"], "left")
    return joined.join(behaved, rows["k"] == behaved["seen_by"], "left").selectExpr(
        "k", "last_at", "scores", *[f"coalesce({name}, 0L) AS {name}" for name in counts]
    )


_SEEN = "(" + " + ".join(c.BEHAVIOR_TEXT) + ")"


def _user_features(customer: DataFrame, order_rows: DataFrame, event_rows: DataFrame) -> DataFrame:
    return _per(customer, "c_custkey", order_rows, event_rows, "buyer", "visitor").selectExpr(
        *_as_text(
            "k",
            {
                "user_id": _padded_id("U", "k", 6),
                # An offset on some users lets the snapshot disagree with the facts.
                "total_spent": _fixed_point("cents + IF(k % 97 = 0, 100, 0)", 2),
                "order_count": "concat(orders, '.0')",
                "completed_orders": "concat(completed, '.0')",
                "avg_order_amount": _fixed_point("coalesce(cents DIV nullif(orders, 0), 0)", 2),
                **{f"{b}_count": f"concat({b}, '.0')" for b in c.BEHAVIOR_TEXT},
                # A fixed later day keeps the feature independent of the run date.
                "days_since_last_order":
                    f"coalesce(datediff(DATE '2030-01-01', to_date(last_at)), {c.LAST_ORDER_SENTINEL})",
                "order_frequency": "concat(completed, '.0')",
                "repurchase_indicator": "IF(orders >= 2, 1, 0)",
                "purchase_intent": _fixed_point(f"coalesce((favorite + cart) * 10000 DIV nullif({_SEEN}, 0), 0)", 4),
                "consumption_level": "CASE WHEN cents >= 500000000 THEN '高' WHEN cents >= 100000000 THEN '中' ELSE '低' END",
                "member_level_score": "1 + k % 5",
            },
        )
    )


def _product_features(part: DataFrame, order_rows: DataFrame, event_rows: DataFrame) -> DataFrame:
    return _per(part, "p_partkey", order_rows, event_rows, "product", "product").selectExpr(
        *_as_text(
            "k",
            {
                "product_id": _padded_id("P", "k", 6),
                "total_revenue": _fixed_point("cents", 2),
                "total_sales": "orders + IF(k % 89 = 1, 1, 0)",
                "completed_count": "completed",
                "cancel_count": "cancelled",
                **{f"{text}_count": b for b, text in c.BEHAVIOR_TEXT.items()},
                "conversion_rate": _fixed_point("coalesce(completed * 10000 DIV nullif(orders, 0), 0)", 4),
                "avg_review_score": f"CASE WHEN scored > 0 THEN {_fixed_point('scores * 100 DIV scored', 2)} ELSE '' END",
                "popularity_score": _fixed_point(f"orders + {_SEEN}", 2),
            },
        )
    )
