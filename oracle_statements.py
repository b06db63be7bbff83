"""The SQL twin of every registered query, for DuckDB over the same Parquet tables.

Statements are composed from named relations: each relation is one SELECT, and a query
takes along the relations it mentions, directly or through others.
"""

from __future__ import annotations

import re

from cartwright import contract as c
from cartwright.plans.arrivals import DAYS_PER_FILE, DELAY, LAST_FILE, LATE_EVERY
from cartwright.plans.consumption import KPI_CARDS
from cartwright.sources.catalog import GRAINS
from cartwright.sources.star_schema import REPEATS, SPOILS

RELATIONS: dict[str, str] = {}


# --- small expression helpers ------------------------------------------------------------------


def _num(column: str, dtype: str) -> str:
    return f"TRY_CAST(trim({column}) AS {dtype})"


def _opt(column: str, dtype: str) -> str:
    return f"CASE WHEN NOT {_blank(column)} THEN {_num(column, dtype)} END"


def _blank(column: str) -> str:
    return f"(coalesce(trim({column}), '') = '')"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _fixed(units: str, digits: int) -> str:
    base = 10**digits
    return f"((({units}) // {base}) || '.' || lpad(CAST(({units}) % {base} AS VARCHAR), {digits}, '0'))"


def _ratio(n: str, d: str) -> str:
    """Half-up at four decimals in integer arithmetic; NULL over zero."""
    return f"CAST((20000 * CAST({n} AS HUGEINT) + ({d})) // nullif(2 * CAST({d} AS HUGEINT), 0) AS DOUBLE) / 10000"


def _mean(total: str, n: str) -> str:
    """Half-up at two decimals from an exact sum."""
    units = f"CAST(round(({total}) * 100) AS HUGEINT)"
    return f"CAST((2 * {units} + ({n})) // nullif(2 * CAST({n} AS HUGEINT), 0) AS DOUBLE) / 100"


def _big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def _dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def _case(column: str, values: dict[str, str], otherwise: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


# --- the adapter ---------------------------------------------------------------------------------

RELATIONS["o_lines"] = """
SELECT l_orderkey, min(l_partkey) AS product, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
       max(cents) AS unit_price, CAST(sum(cents) AS BIGINT) AS total,
       CAST(sum((cents * percent + 50) // 100) AS BIGINT) AS discount
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
             CAST(round(l_discount * 100) AS BIGINT) AS percent FROM lineitem)
GROUP BY l_orderkey"""

RELATIONS["o_rows"] = """
SELECT *, total - discount AS paid,
       CASE WHEN status = 'completed' AND k % 2 = 0 THEN 1 + k % 5 END AS score
FROM (SELECT o_orderkey AS k, CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 1 ELSE o_custkey END AS buyer,
             o_orderdate + INTERVAL 25 YEAR AS at_ts,
             CASE o_orderstatus
               WHEN 'O' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'pending_payment' ELSE 'paid' END
               WHEN 'P' THEN CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'shipped' ELSE 'received' END
               ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'refunded' WHEN '4-NOT SPECIFIED' THEN 'cancelled'
                    ELSE 'completed' END
             END AS status,
             product, quantity, unit_price, total, discount
      FROM orders LEFT JOIN o_lines ON o_orderkey = l_orderkey)"""

RELATIONS["e_rows"] = """
SELECT event_id AS k, user_id AS visitor, event_id % (SELECT count(*) FROM part) AS product, ts AS at_ts,
       CASE event_type WHEN 'view' THEN 'browse' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'favorite'
            WHEN 'purchase' THEN 'cart' END AS behavior,
       event_type, CAST(floor(value) AS BIGINT) AS seconds
FROM events"""

_LEVELS = dict(zip(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), c.MEMBER_LEVELS))

RELATIONS["raw_users"] = f"""
SELECT c_custkey AS k, NULL AS corrupt, printf('U%06d', c_custkey) AS user_id,
       CAST(13 + c_custkey % 90 AS VARCHAR) AS age, ['{"', '".join(c.GENDERS)}'][c_custkey % 3 + 1] AS gender,
       n_name AS province, 'CITY_' || c_nationkey AS city,
       strftime(DATE '2020-01-01' + CAST(c_custkey * 37 % 1500 AS INT), '%Y-%m-%d') || ' 00:00:00' AS registration_date,
       {_case('c_mktsegment', _LEVELS, 'c_mktsegment')} AS member_level,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS account_balance,
       CAST(300 + c_custkey * 13 % 700 AS VARCHAR) AS credit_score
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

RELATIONS["raw_products"] = """
SELECT p_partkey AS k, NULL AS corrupt, printf('P%06d', p_partkey) AS product_id, p_name AS product_name,
       p_type AS category, CASE WHEN p_partkey % 97 = 0 THEN ' ' ELSE p_brand END AS brand,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(p_size * 10 AS VARCHAR) AS sales_count
FROM part"""

RELATIONS["raw_orders"] = f"""
SELECT k, NULL AS corrupt, printf('O%08d', k) AS order_id, printf('U%06d', buyer) AS user_id,
       CASE WHEN product IS NOT NULL THEN printf('P%06d', product) END AS product_id,
       CAST(quantity AS VARCHAR) AS quantity, CAST(at_ts AS VARCHAR) AS order_date,
       {_case('status', c.STATUS_TEXT, 'status')} AS order_status, 'method_' || (k % 5) AS payment_method,
       {_fixed('unit_price', 2)} AS unit_price, {_fixed('total', 2)} AS total_amount,
       {_fixed('discount', 2)} AS discount, {_fixed('paid', 2)} AS actual_payment,
       CASE WHEN status IN ('shipped', 'received', 'completed') AND k % 211 <> 0
            THEN CAST(at_ts + INTERVAL 2 DAY AS VARCHAR) ELSE '' END AS delivery_date,
       CASE WHEN status IN ('received', 'completed') THEN CAST(at_ts + INTERVAL 4 DAY AS VARCHAR) ELSE '' END AS receive_date,
       coalesce(CAST(score AS VARCHAR), '') AS review_score,
       CASE WHEN score IS NOT NULL THEN 'review ' || k ELSE '' END AS review_content
FROM o_rows"""

RELATIONS["raw_user_behaviors"] = f"""
SELECT k, NULL AS corrupt, printf('B%08d', k) AS behavior_id, printf('U%06d', visitor) AS user_id,
       printf('P%06d', product) AS product_id, {_case('behavior', c.BEHAVIOR_TEXT, 'event_type')} AS behavior_type,
       CAST(at_ts AS VARCHAR) AS behavior_time, CAST(seconds AS VARCHAR) AS duration_seconds
FROM e_rows"""


def _feature_totals(buyer: str, visitor: str) -> tuple[str, str]:
    ordered = f"""(SELECT {buyer} AS key, count(*) AS n, count(*) FILTER (status = 'completed') AS done,
       count(*) FILTER (status IN ('cancelled', 'refunded')) AS off, CAST(sum(paid) AS BIGINT) AS cents,
       max(at_ts) AS last_at, CAST(sum(score) AS BIGINT) AS scores, count(score) AS scored
       FROM o_rows WHERE product IS NOT NULL GROUP BY 1)"""
    counts = ", ".join(f"count(*) FILTER (behavior = '{b}') AS {b}" for b in c.BEHAVIOR_TEXT)
    behaved = f"(SELECT {visitor} AS key, {counts} FROM e_rows WHERE behavior IS NOT NULL GROUP BY 1)"
    return ordered, behaved


_O, _B = _feature_totals("buyer", "visitor")
_ZEROS = ", ".join(f"coalesce(b.{b}, 0) AS {b}" for b in c.BEHAVIOR_TEXT)
RELATIONS["u_totals"] = f"""
SELECT c_custkey AS k, coalesce(n, 0) AS n, coalesce(done, 0) AS done, coalesce(cents, 0) AS cents, last_at, {_ZEROS}
FROM customer LEFT JOIN {_O} o ON o.key = c_custkey LEFT JOIN {_B} b ON b.key = c_custkey"""
_PO, _PB = _feature_totals("product", "product")
RELATIONS["p_totals"] = f"""
SELECT p_partkey AS k, coalesce(n, 0) AS n, coalesce(done, 0) AS done, coalesce(off, 0) AS off,
       coalesce(cents, 0) AS cents, scores, coalesce(scored, 0) AS scored, {_ZEROS}
FROM part LEFT JOIN {_PO} o ON o.key = p_partkey LEFT JOIN {_PB} b ON b.key = p_partkey"""

_SEEN = "(" + " + ".join(c.BEHAVIOR_TEXT) + ")"
RELATIONS["raw_user_features"] = f"""
SELECT k, NULL AS corrupt, printf('U%06d', k) AS user_id,
       {_fixed('cents + CASE WHEN k % 97 = 0 THEN 100 ELSE 0 END', 2)} AS total_spent,
       n || '.0' AS order_count, done || '.0' AS completed_orders,
       {_fixed('coalesce(cents // nullif(n, 0), 0)', 2)} AS avg_order_amount,
       {', '.join(f"{b} || '.0' AS {b}_count" for b in c.BEHAVIOR_TEXT)},
       CAST(coalesce(date_diff('day', CAST(last_at AS DATE), DATE '2030-01-01'), 999) AS VARCHAR) AS days_since_last_order,
       done || '.0' AS order_frequency, CASE WHEN n >= 2 THEN '1' ELSE '0' END AS repurchase_indicator,
       {_fixed(f'coalesce((favorite + cart) * 10000 // nullif({_SEEN}, 0), 0)', 4)} AS purchase_intent,
       CASE WHEN cents >= 500000000 THEN '高' WHEN cents >= 100000000 THEN '中' ELSE '低' END AS consumption_level,
       CAST(1 + k % 5 AS VARCHAR) AS member_level_score
FROM u_totals"""

RELATIONS["raw_product_features"] = f"""
SELECT k, NULL AS corrupt, printf('P%06d', k) AS product_id, {_fixed('cents', 2)} AS total_revenue,
       CAST(n + CASE WHEN k % 89 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS total_sales,
       CAST(done AS VARCHAR) AS completed_count, CAST(off AS VARCHAR) AS cancel_count,
       {', '.join(f'CAST({b} AS VARCHAR) AS {b}_count' for b in c.BEHAVIOR_TEXT)},
       {_fixed('coalesce(done * 10000 // nullif(n, 0), 0)', 4)} AS conversion_rate,
       CASE WHEN scored > 0 THEN {_fixed('scores * 100 // scored', 2)} ELSE '' END AS avg_review_score,
       {_fixed(f'n + {_SEEN}', 2)} AS popularity_score
FROM p_totals"""


def _spoiled(table: str) -> str:
    by_column: dict[str, str] = {}
    for header, modulus, remainder, replacement in SPOILS[table]:
        name = "corrupt" if header == "_corrupt_record" else c.ASCII_NAMES.get(header, header)
        value = "NULL" if replacement is None else f"'{replacement}'"
        by_column[name] = (
            f"CASE WHEN k % {modulus} = {remainder} THEN {value} ELSE {by_column.get(name, name)} END"
        )
    replaced = ", ".join(f"{sql} AS {name}" for name, sql in by_column.items())
    return f"SELECT * REPLACE ({replaced}) FROM raw_{table}"


# --- typed rows and local reasons ------------------------------------------------------------------

_MONEY, _WHOLE = "DECIMAL(18,2)", "DECIMAL(20,6)"


def _typed(table: str) -> dict[str, tuple[str, str]]:
    """Output column -> (source text column, DuckDB type; '' for text, '?' prefix for optional)."""
    plain = {name: (name, "") for name in ()}
    if table == "users":
        plain = {
            "user_id": ("user_id", ""), "age": ("age", "INT"), "gender": ("gender", ""), "province": ("province", ""),
            "city": ("city", ""), "registration_ts": ("registration_date", "TIMESTAMP"),
            "member_level": ("member_level", ""), "account_balance": ("account_balance", _MONEY),
            "credit_score": ("credit_score", "INT"),
        }
    elif table == "products":
        plain = {n: (n, "") for n in ("product_id", "product_name", "category", "brand")}
        plain |= {"price": ("price", _MONEY), "sales_count": ("sales_count", "BIGINT")}
    elif table == "orders":
        plain = {n: (n, "") for n in ("order_id", "user_id", "product_id")}
        plain |= {"quantity": ("quantity", "INT"), "order_ts": ("order_date", "TIMESTAMP")}
        plain |= {n: (n, "") for n in ("order_status", "payment_method")}
        plain |= {n: (n, _MONEY) for n in ("unit_price", "total_amount", "discount", "actual_payment")}
        plain |= {"delivery_ts": ("delivery_date", "?TIMESTAMP"), "receive_ts": ("receive_date", "?TIMESTAMP"),
                  "review_score": ("review_score", "?INT"), "review_content": ("review_content", "?")}
    elif table == "user_behaviors":
        plain = {n: (n, "") for n in ("behavior_id", "user_id", "product_id", "behavior_type")}
        plain |= {"behavior_ts": ("behavior_time", "TIMESTAMP"), "duration_seconds": ("duration_seconds", "INT")}
    elif table == "user_features":
        plain = {"user_id": ("user_id", ""), "total_spent": ("total_spent", _MONEY)}
        plain |= {n: (n, _WHOLE) for n in ("order_count", "completed_orders")}
        plain |= {"avg_order_amount": ("avg_order_amount", "DECIMAL(18,4)")}
        plain |= {f"{b}_count": (f"{b}_count", _WHOLE) for b in c.BEHAVIOR_TEXT}
        plain |= {"days_since_last_order": ("days_since_last_order", "INT"), "order_frequency": ("order_frequency", "DOUBLE"),
                  "repurchase_indicator": ("repurchase_indicator", "INT"), "purchase_intent": ("purchase_intent", "DOUBLE"),
                  "consumption_level": ("consumption_level", ""), "member_level_score": ("member_level_score", "INT")}
    else:
        plain = {"product_id": ("product_id", ""), "total_revenue": ("total_revenue", _MONEY)}
        plain |= {n: (n, "BIGINT") for n in ("total_sales", "completed_count", "cancel_count", "cart_count",
                                             "favorite_count", "browse_count", "click_count")}
        plain |= {"conversion_rate": ("conversion_rate", "DOUBLE"), "avg_review_score": ("avg_review_score", "?DOUBLE"),
                  "popularity_score": ("popularity_score", "DOUBLE")}
    return plain


def _value(source: str, dtype: str) -> str:
    if dtype == "":
        return f"trim(t.{source})"
    if dtype == "?":
        return f"nullif(trim(t.{source}), '')"
    if dtype.startswith("?"):
        return _opt(f"t.{source}", dtype[1:])
    return _num(f"t.{source}", dtype)


def _reasons(table: str) -> list[tuple[str, str]]:
    """(code, predicate) in order; ``r.`` is the text row, ``v.`` the typed row."""

    def unread(name: str, code: str | None = None):
        return (code or f"invalid_{name}_parse", f"v.{name} IS NULL")

    def id_rule(name: str, letter: str, width: int):
        return (f"invalid_{name}", f"NOT regexp_full_match(coalesce(v.{name}, ''), '{letter}[0-9]{{{width},}}')")

    def listed(name: str, values):
        return (f"invalid_{name}", f"coalesce(v.{name}, '') = '' OR NOT {_in('v.' + name, values)}")

    def below_zero(code: str, *names: str):
        return (code, "(" + " OR ".join(f"v.{n} < 0" for n in names) + ")")

    malformed = ("malformed_csv", f"NOT {_blank('r.corrupt')}")
    user, product = id_rule("user_id", "U", 6), id_rule("product_id", "P", 6)
    if table == "users":
        return [
            malformed, user, unread("age"), ("invalid_age", "v.age < 13 OR v.age > 100"), listed("gender", c.GENDERS),
            ("missing_region", f"{_blank('r.province')} OR {_blank('r.city')}"),
            unread("registration_ts", "invalid_registration_date"), listed("member_level", c.MEMBER_LEVELS),
            unread("account_balance"), below_zero("invalid_account_balance", "account_balance"), unread("credit_score"),
            ("invalid_credit_score", "v.credit_score < 0 OR v.credit_score > 1000"),
        ]
    if table == "products":
        return [
            malformed, product, *[(f"missing_{n}", _blank(f"r.{n}")) for n in ("product_name", "category", "brand")],
            unread("price"), below_zero("invalid_price", "price"), unread("sales_count"),
            below_zero("invalid_sales_count", "sales_count"),
        ]
    if table == "orders":
        amounts = ("unit_price", "total_amount", "discount", "actual_payment")
        return [
            malformed, id_rule("order_id", "O", 8), user, product, unread("quantity"),
            ("invalid_quantity", "v.quantity < 1"), unread("order_ts", "invalid_order_date"),
            listed("order_status", c.STATUS_TEXT.values()), ("missing_payment_method", _blank("r.payment_method")),
            *[unread(a) for a in amounts], below_zero("invalid_amount", *amounts),
            ("amount_equation_mismatch", "abs(v.total_amount - v.discount - v.actual_payment) > 0.01"),
            ("invalid_delivery_date", f"NOT {_blank('r.delivery_date')} AND v.delivery_ts IS NULL"),
            ("invalid_receive_date", f"NOT {_blank('r.receive_date')} AND v.receive_ts IS NULL"),
            ("invalid_review_score",
             f"NOT {_blank('r.review_score')} AND (v.review_score IS NULL OR v.review_score < 1 OR v.review_score > 5)"),
        ]
    if table == "user_behaviors":
        return [
            malformed, id_rule("behavior_id", "B", 8), user, product, listed("behavior_type", c.BEHAVIOR_TEXT.values()),
            unread("behavior_ts", "invalid_behavior_time"), unread("duration_seconds", "invalid_duration_parse"),
            below_zero("invalid_duration", "duration_seconds"),
        ]
    if table == "user_features":
        orders, seen = ("order_count", "completed_orders"), tuple(f"{b}_count" for b in c.BEHAVIOR_TEXT)

        def whole(name: str):
            return [unread(name), (f"invalid_{name}", f"v.{name} % 1 <> 0")]

        return [
            malformed, user, unread("total_spent"), *[x for n in orders for x in whole(n)], unread("avg_order_amount"),
            *[x for n in seen for x in whole(n)],
            *[unread(n) for n in ("days_since_last_order", "order_frequency", "repurchase_indicator", "purchase_intent",
                                  "member_level_score")],
            below_zero("invalid_feature_value", "total_spent", "avg_order_amount", *orders, *seen),
            ("invalid_repurchase_indicator", "v.repurchase_indicator NOT IN (0, 1)"),
            ("invalid_purchase_intent", "v.purchase_intent < 0 OR v.purchase_intent > 1"),
            listed("consumption_level", c.CONSUMPTION_LEVELS),
        ]
    counts = ("total_sales", "completed_count", "cancel_count", "cart_count", "favorite_count", "browse_count", "click_count")
    return [
        malformed, product, unread("total_revenue"), *[unread(n) for n in counts], unread("conversion_rate"),
        unread("popularity_score"), below_zero("invalid_feature_value", "total_revenue", *counts),
        ("invalid_conversion_rate", "v.conversion_rate < 0 OR v.conversion_rate > 1"),
        ("invalid_review_score", f"NOT {_blank('r.avg_review_score')} AND (v.avg_review_score IS NULL"
                                 " OR v.avg_review_score < 1 OR v.avg_review_score > 5)"),
    ]


def _staged(source: str, table: str) -> str:
    """Typed values and the text row travel together as structs of one row."""
    values = ", ".join(f"{name} := {_value(src, dtype)}" for name, (src, dtype) in _typed(table).items())
    arms = ", ".join(f"CASE WHEN {predicate} THEN '{code}' END" for code, predicate in _reasons(table))
    return f"""
SELECT unnest(v), concat_ws(';', {arms}) AS reasons
FROM (SELECT t AS r, struct_pack({values}) AS v FROM {source} t)"""


for _table in c.HEADERS:
    RELATIONS[f"bad_{_table}"] = _spoiled(_table)
    RELATIONS[f"stg_{_table}"] = _staged(f"raw_{_table}", _table)
    RELATIONS[f"stgbad_{_table}"] = _staged(f"bad_{_table}", _table)


# --- parents, valid rows, quarantine ------------------------------------------------------------------


def _with_parents(table: str, user_time: str | None, user: bool, product: bool) -> str:
    terms, joins = ["nullif(s.reasons, '')"], ""
    if user:
        joins += " LEFT JOIN stg_users u ON s.user_id = u.user_id"
        terms.append("CASE WHEN coalesce(u.reasons, 'absent') <> '' THEN 'broken_user_fk' END")
    if product:
        joins += " LEFT JOIN stg_products p ON s.product_id = p.product_id"
        terms.append("CASE WHEN coalesce(p.reasons, 'absent') <> '' THEN 'broken_product_fk' END")
    if user_time:
        terms.append(f"CASE WHEN s.{user_time} < u.registration_ts THEN 'event_before_registration' END")
    return f"SELECT s.*, concat_ws(';', {', '.join(terms)}) AS final_reasons FROM stg_{table} s{joins}"


RELATIONS["all_users"] = "SELECT *, reasons AS final_reasons FROM stg_users"
RELATIONS["all_products"] = "SELECT *, reasons AS final_reasons FROM stg_products"
RELATIONS["all_orders"] = _with_parents("orders", "order_ts", True, True)
RELATIONS["all_user_behaviors"] = _with_parents("user_behaviors", "behavior_ts", True, True)
RELATIONS["all_user_features"] = _with_parents("user_features", None, True, False)
RELATIONS["all_product_features"] = _with_parents("product_features", None, False, True)
for _table in c.HEADERS:
    RELATIONS[f"ok_{_table}"] = f"SELECT * EXCLUDE (reasons, final_reasons) FROM all_{_table} WHERE final_reasons = ''"
KEYS = {table: headers[0] for table, headers in c.HEADERS.items()}
RELATIONS["rejected"] = " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, {k} AS record_key, final_reasons AS rejection_reasons FROM all_{t} WHERE final_reasons <> ''"
    for t, k in KEYS.items()
)


# --- facts and dimensions --------------------------------------------------------------------------------


def _values(rows, columns) -> str:
    def lit(v):
        return str(v).lower() if isinstance(v, bool) else repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(columns)})"


RELATIONS["d_status"] = _values(c.ORDER_STATUSES, c.OrderStatus._fields)
RELATIONS["d_behavior"] = _values(c.BEHAVIORS, c.Behavior._fields)
RELATIONS["f_order"] = """
SELECT o.* EXCLUDE (order_status, review_content), CAST(order_ts AS DATE) AS order_date, order_status AS source_order_status,
       status_code, status_order, is_paid_lifecycle, is_completed,
       actual_payment * CAST(is_paid_lifecycle AS INT) AS paid_gmv
FROM ok_orders o JOIN d_status ON order_status = source_status"""
RELATIONS["f_behavior"] = """
SELECT b.* EXCLUDE (behavior_type), behavior_type AS source_behavior_type, behavior_code, behavior_group, stage_order,
       CAST(behavior_ts AS DATE) AS behavior_date, hour(behavior_ts) AS behavior_hour
FROM ok_user_behaviors b JOIN d_behavior ON behavior_type = source_behavior"""
RELATIONS["d_user"] = """
SELECT user_id, age, CASE WHEN age >= 55 THEN '55+' WHEN age >= 45 THEN '45-54' WHEN age >= 35 THEN '35-44'
                          WHEN age >= 25 THEN '25-34' ELSE '18-24' END AS age_band,
       gender, province, city, CAST(registration_ts AS DATE) AS registration_date, member_level, account_balance, credit_score
FROM ok_users"""

# --- metrics ----------------------------------------------------------------------------------------------

RELATIONS["m_daily"] = f"""
SELECT order_date, count(*) AS total_orders, count(DISTINCT user_id) AS ordering_customers, {_big('sum(quantity)', 'units')},
       sum(actual_payment) AS all_order_amount, sum(paid_gmv) AS paid_gmv,
       coalesce(sum(actual_payment) FILTER (is_completed), 0) AS completed_gmv, sum(discount) AS discount_amount,
       count(*) FILTER (is_paid_lifecycle) AS paid_orders, count(*) FILTER (is_completed) AS completed_orders,
       count(DISTINCT user_id) FILTER (is_completed) AS completed_customers,
       count(*) FILTER (status_code IN ('cancelled', 'refunded')) AS cancelled_or_refunded_orders,
       {_mean('sum(paid_gmv)', 'count(*) FILTER (is_paid_lifecycle)')} AS paid_aov,
       {_mean('sum(review_score) FILTER (is_completed)', 'count(review_score) FILTER (is_completed)')} AS avg_review_score
FROM f_order GROUP BY order_date"""
RELATIONS["m_status"] = f"""
SELECT *, {_ratio('order_count', '(sum(order_count) OVER ())')} AS order_share
FROM (SELECT source_order_status, status_code, status_order, count(*) AS order_count, count(DISTINCT user_id) AS customer_count,
             sum(actual_payment) AS order_amount, sum(paid_gmv) AS paid_gmv FROM f_order GROUP BY ALL)"""
_KINDS = ", ".join(f"count(*) FILTER (behavior_code = '{b}') AS {b}_events" for b in c.BEHAVIOR_TEXT)
RELATIONS["m_hourly"] = f"""
SELECT behavior_hour, count(*) AS behavior_events, count(DISTINCT user_id) AS active_users, {_KINDS},
       {_mean('sum(duration_seconds)', 'count(duration_seconds)')} AS avg_duration_seconds
FROM f_behavior GROUP BY behavior_hour"""
RELATIONS["m_customer"] = f"""
SELECT u.user_id, age_band, gender, province, city, member_level,
       {', '.join(f'coalesce(o.{n}, 0) AS {n}' for n in ('total_orders', 'paid_orders', 'completed_orders', 'all_order_amount', 'paid_gmv'))},
       first_order_ts, last_order_ts,
       {', '.join(f'coalesce(b.{n}, 0) AS {n}' for n in ('behavior_events', *[f'{b}_events' for b in c.BEHAVIOR_TEXT]))},
       first_behavior_ts, last_behavior_ts,
       CASE WHEN o.paid_orders > 1 THEN 'repeat_paid_customer' WHEN o.paid_orders > 0 THEN 'single_paid_customer'
            WHEN o.total_orders > 0 THEN 'order_without_payment' WHEN b.behavior_events > 0 THEN 'engaged_noncustomer'
            ELSE 'inactive' END AS customer_segment
FROM d_user u
LEFT JOIN (SELECT user_id, count(*) AS total_orders, count(*) FILTER (is_paid_lifecycle) AS paid_orders,
                  count(*) FILTER (is_completed) AS completed_orders, sum(actual_payment) AS all_order_amount,
                  sum(paid_gmv) AS paid_gmv, min(order_ts) AS first_order_ts, max(order_ts) AS last_order_ts
           FROM f_order GROUP BY user_id) o ON o.user_id = u.user_id
LEFT JOIN (SELECT user_id, count(*) AS behavior_events, {_KINDS}, min(behavior_ts) AS first_behavior_ts,
                  max(behavior_ts) AS last_behavior_ts FROM f_behavior GROUP BY user_id) b ON b.user_id = u.user_id"""
RELATIONS["m_segment"] = f"""
SELECT *, {_ratio('user_count', '(sum(user_count) OVER ())')} AS user_share
FROM (SELECT list_position(['{"', '".join(c.SEGMENTS)}'], customer_segment) AS segment_order, customer_segment,
             count(*) AS user_count, sum(total_orders) AS total_orders, sum(paid_orders) AS paid_orders,
             sum(paid_gmv) AS paid_gmv, sum(behavior_events) AS behavior_events
      FROM m_customer GROUP BY ALL)"""
RELATIONS["t_browse"] = "SELECT user_id, min(behavior_ts) AS t FROM f_behavior WHERE behavior_code = 'browse' GROUP BY 1"
RELATIONS["t_click"] = """SELECT user_id, min(behavior_ts) AS t FROM f_behavior JOIN t_browse USING (user_id)
WHERE behavior_code = 'click' AND behavior_ts >= t GROUP BY 1"""
RELATIONS["t_intent"] = """SELECT user_id, min(behavior_ts) AS t FROM f_behavior JOIN t_click USING (user_id)
WHERE behavior_group = 'intent' AND behavior_ts >= t GROUP BY 1"""
RELATIONS["t_paid"] = """SELECT user_id, min(order_ts) AS t FROM f_order JOIN t_intent USING (user_id)
WHERE is_paid_lifecycle AND order_ts >= t GROUP BY 1"""
RELATIONS["m_funnel"] = f"""
SELECT stage_order, stage_name, user_count,
       CASE WHEN stage_order = 1 THEN 1.0
            ELSE {_ratio('user_count', '(lag(user_count) OVER (ORDER BY stage_order))')} END AS previous_stage_conversion,
       {_ratio('user_count', '(first_value(user_count) OVER (ORDER BY stage_order))')} AS overall_conversion
FROM (SELECT 1 AS stage_order, 'browse' AS stage_name, count(*) AS user_count FROM t_browse
      UNION ALL SELECT 2, 'click_after_browse', count(*) FROM t_click
      UNION ALL SELECT 3, 'intent_after_click', count(*) FROM t_intent
      UNION ALL SELECT 4, 'paid_order_after_intent', count(*) FROM t_paid)"""
RELATIONS["m_category"] = f"""
SELECT d.category, products, coalesce(behavior_events, 0) AS behavior_events, coalesce(engaged_users, 0) AS engaged_users,
       coalesce(browse_users, 0) AS browse_users, coalesce(intent_users, 0) AS intent_users,
       {', '.join(f'coalesce({n}, 0) AS {n}' for n in ('total_orders', 'ordering_customers', 'paid_orders', 'paid_customers', 'paid_gmv'))},
       paid_aov, {', '.join(f'coalesce({n}, 0) AS {n}' for n in ('completed_orders', 'completed_customers', 'completed_gmv'))}
FROM (SELECT category, count(*) AS products FROM ok_products GROUP BY 1) d
LEFT JOIN (SELECT category, count(*) AS behavior_events, count(DISTINCT user_id) AS engaged_users,
                  count(DISTINCT user_id) FILTER (behavior_code = 'browse') AS browse_users,
                  count(DISTINCT user_id) FILTER (behavior_group = 'intent') AS intent_users
           FROM f_behavior JOIN ok_products USING (product_id) GROUP BY 1) b ON b.category = d.category
LEFT JOIN (SELECT category, count(*) AS total_orders, count(DISTINCT user_id) AS ordering_customers,
                  count(*) FILTER (is_paid_lifecycle) AS paid_orders,
                  count(DISTINCT user_id) FILTER (is_paid_lifecycle) AS paid_customers, sum(paid_gmv) AS paid_gmv,
                  {_mean('sum(paid_gmv)', 'count(*) FILTER (is_paid_lifecycle)')} AS paid_aov,
                  count(*) FILTER (is_completed) AS completed_orders,
                  count(DISTINCT user_id) FILTER (is_completed) AS completed_customers,
                  sum(actual_payment) FILTER (is_completed) AS completed_gmv
           FROM f_order JOIN ok_products USING (product_id) GROUP BY 1) o ON o.category = d.category"""
RELATIONS["m_done"] = "SELECT user_id, count(*) AS completed_orders FROM f_order WHERE is_completed GROUP BY 1"
RELATIONS["m_kpi"] = f"""
SELECT min(order_date) AS min_order_date, max(order_date) AS max_order_date,
       (SELECT min(behavior_date) FROM f_behavior) AS min_behavior_date,
       (SELECT max(behavior_date) FROM f_behavior) AS max_behavior_date,
       count(*) AS total_orders, count(DISTINCT user_id) AS ordering_customers,
       count(*) FILTER (is_paid_lifecycle) AS paid_orders,
       count(DISTINCT user_id) FILTER (is_paid_lifecycle) AS paid_customers,
       count(*) FILTER (is_completed) AS completed_orders,
       count(DISTINCT user_id) FILTER (is_completed) AS completed_customers,
       sum(actual_payment) AS all_order_amount, sum(paid_gmv) AS paid_gmv,
       sum(actual_payment) FILTER (is_completed) AS completed_gmv,
       {_mean('sum(paid_gmv)', 'count(*) FILTER (is_paid_lifecycle)')} AS paid_aov,
       {_mean('sum(actual_payment) FILTER (is_completed)', 'count(*) FILTER (is_completed)')} AS completed_aov,
       count(*) FILTER (status_code IN ('cancelled', 'refunded')) AS cancelled_or_refunded_orders,
       {_ratio('count(*) FILTER (is_completed)', 'count(*)')} AS completion_rate,
       {_ratio("count(*) FILTER (status_code IN ('cancelled', 'refunded'))", 'count(*)')} AS cancellation_refund_rate,
       (SELECT count(*) FROM m_done WHERE completed_orders >= 2) AS repeat_completed_customers,
       {_ratio('(SELECT count(*) FROM m_done WHERE completed_orders >= 2)', 'count(DISTINCT user_id) FILTER (is_completed)')}
           AS repeat_completed_customer_rate,
       (SELECT count(*) FROM f_behavior) AS behavior_events, (SELECT count(DISTINCT user_id) FROM f_behavior) AS behavior_users,
       (SELECT count(*) FROM ok_users) AS registered_users, (SELECT count(*) FROM ok_products) AS products,
       (SELECT count(DISTINCT category) FROM ok_products) AS categories, (SELECT count(*) FROM rejected) AS quarantined_rows
FROM f_order"""

# --- checks ---------------------------------------------------------------------------------------------------

_LIFECYCLE = f"""(({_in('order_status', [c.STATUS_TEXT[s] for s in ('shipped', 'received', 'completed')])} AND delivery_ts IS NULL)
 OR ({_in('order_status', [c.STATUS_TEXT[s] for s in ('received', 'completed')])} AND receive_ts IS NULL)
 OR delivery_ts < order_ts OR receive_ts < delivery_ts)"""
_DONE, _OFF = c.STATUS_TEXT["completed"], [c.STATUS_TEXT[s] for s in c.CANCELLED_OR_REFUNDED]
_BC = ", ".join(f"count(*) FILTER (behavior_type = '{t}') AS {b}_count" for b, t in c.BEHAVIOR_TEXT.items())


def _feature_check(features: str, key: str, amount: str, n: str, done: str, off: str | None) -> str:
    counts = [n, done] + ([off] if off else [])
    differs = [f"abs(f.{amount} - coalesce(o.amount, 0)) > 0.01"]
    differs += [f"f.{name} <> coalesce(o.{alias}, 0)" for name, alias in zip(counts, ("n", "done", "off"))]
    differs += [f"f.{b}_count <> coalesce(b.{b}_count, 0)" for b in c.BEHAVIOR_TEXT]
    return f"""
SELECT f.*, ({' OR '.join(differs)}) AS mismatch FROM ok_{features} f
LEFT JOIN (SELECT {key}, count(*) AS n, count(*) FILTER (order_status = '{_DONE}') AS done,
                  count(*) FILTER ({_in('order_status', _OFF)}) AS off, sum(actual_payment) AS amount
           FROM stg_orders WHERE reasons = '' GROUP BY 1) o ON o.{key} = f.{key}
LEFT JOIN (SELECT {key}, {_BC} FROM stg_user_behaviors WHERE reasons = '' GROUP BY 1) b ON b.{key} = f.{key}"""


RELATIONS["q_user"] = _feature_check("user_features", "user_id", "total_spent", "order_count", "completed_orders", None)
RELATIONS["q_product"] = _feature_check(
    "product_features", "product_id", "total_revenue", "total_sales", "completed_count", "cancel_count"
)
_RAWS = [f"(SELECT count(*) FROM raw_{t})" for t in c.HEADERS]
_DUPS = " + ".join(f"(SELECT count(*) - count(DISTINCT {k}) FROM ok_{t})" for t, k in KEYS.items())
_ORPHANS = " + ".join(
    f"(SELECT count(*) FROM {child} WHERE NOT EXISTS (SELECT 1 FROM ok_{parent} p WHERE p.{key} = {child}.{key}))"
    for child in ("ok_orders", "ok_user_behaviors")
    for parent, key in (("users", "user_id"), ("products", "product_id"))
)


def _check_rows() -> str:
    orders, behaviors = "(SELECT count(*) FROM ok_orders)", "(SELECT count(*) FROM ok_user_behaviors)"
    fo, fb = "(SELECT count(*) FROM f_order)", "(SELECT count(*) FROM f_behavior)"
    rejected = "(SELECT count(*) FROM rejected)"
    kpi = lambda n: f"(SELECT {n} FROM m_kpi)"
    daily = "(SELECT sum(total_orders) FROM m_daily)"
    daily_gmv = "(SELECT sum(completed_gmv) FROM m_daily)"
    gmv = "(SELECT sum(actual_payment) FROM f_order WHERE is_completed)"
    rises = "(SELECT count(*) FROM m_funnel a JOIN m_funnel b ON b.stage_order = a.stage_order + 1 WHERE b.user_count > a.user_count)"
    users, share = "(SELECT sum(user_count) FROM m_segment)", "(SELECT sum(user_share) FROM m_segment)"
    filled = " + ".join(
        f"(SELECT CAST(count(*) > 0 AS INT) FROM {t})"
        for t in ("m_kpi", "m_daily", "m_funnel", "m_category", "m_hourly", "m_segment", "m_status")
    )
    balanced = " AND ".join(
        f"(SELECT count(*) FROM raw_{t}) = (SELECT count(*) FROM ok_{t}) + (SELECT count(*) FROM rejected WHERE source_table = '{t}')"
        for t in c.HEADERS
    )
    recount = f"{kpi('total_orders')} = {fo} AND {kpi('completed_gmv')} = {gmv} AND {kpi('quarantined_rows')} = {rejected}"
    zero = {
        "non_temporal_quarantine_empty": (
            "(SELECT count(*) FROM rejected WHERE rejection_reasons <> 'event_before_registration')", "critical", "0"),
        "primary_keys_unique": (f"({_DUPS})", "critical", "0"),
        "foreign_keys_complete": (f"({_ORPHANS})", "critical", "0"),
        "amount_equation_valid": (
            "(SELECT count(*) FILTER (abs(total_amount - discount - actual_payment) > 0.01) FROM stg_orders WHERE reasons = '')",
            "critical", "0"),
        "order_lifecycle_dates_valid": (f"(SELECT count(*) FROM ok_orders WHERE {_LIFECYCLE})", "critical", "0"),
        "user_feature_snapshot_reconciles": ("(SELECT count(*) FILTER (mismatch) FROM q_user)", "critical", "0"),
        "product_feature_snapshot_reconciles": ("(SELECT count(*) FILTER (mismatch) FROM q_product)", "critical", "0"),
        "quarantined_source_rows_reported": (rejected, "warning", "reported and excluded"),
        "pre_registration_events_reported": (
            "(SELECT count(*) FROM rejected WHERE contains(rejection_reasons, 'event_before_registration'))", "warning",
            "reported and excluded"),
        "unit_price_total_difference_reported": (
            "(SELECT count(*) FILTER (abs(unit_price * quantity - total_amount) > 0.01) FROM stg_orders WHERE reasons = '')",
            "warning", "reported only"),
        "feature_last_order_sentinel_reported": (
            "(SELECT count(*) FILTER (days_since_last_order = 999) FROM q_user)", "warning", "reported only"),
    }
    rows = [(name, f"{m} = 0", m, expected, severity) for name, (m, severity, expected) in zero.items()]
    rows += [
        ("all_source_tables_non_empty", f"least({', '.join(_RAWS)}) > 0", f"concat_ws(',', {', '.join(_RAWS)})",
         "all six tables > 0", "critical"),
        ("raw_ods_row_reconciliation", balanced, f"'quarantine=' || {rejected}", "raw=valid+quarantine for all tables", "critical"),
        ("ods_dwd_order_reconciliation", f"{orders} = {fo}", f"{orders} || '=' || {fo}", "ods_orders=dwd_orders", "critical"),
        ("ods_dwd_behavior_reconciliation", f"{behaviors} = {fb}", f"{behaviors} || '=' || {fb}", "ods_behaviors=dwd_behaviors",
         "critical"),
        ("executive_kpis_reconcile", recount,
         f"'orders=' || {kpi('total_orders')} || ',behaviors=' || {kpi('behavior_events')} || ',quarantine=' || {kpi('quarantined_rows')}",
         "ADS equals independent DWD recomputation", "critical"),
        ("daily_orders_reconcile", f"{daily} = {fo} AND {daily_gmv} = {gmv}",
         f"'orders=' || {daily} || ',completed=' || CAST({daily_gmv} AS DECIMAL(30,2))", "daily totals = DWD totals", "critical"),
        ("sequential_funnel_monotonic", f"{rises} = 0 AND (SELECT count(*) FROM m_funnel) = 4",
         f"'stages=' || (SELECT count(*) FROM m_funnel) || ',violations=' || {rises}", "stages=4,violations=0", "critical"),
        ("customer_segments_reconcile", f"{users} = (SELECT count(*) FROM d_user) AND abs({share} - 1) <= 0.001",
         f"'users=' || {users} || ',share=' || round({share}, 4)", "segments cover all users exactly once", "critical"),
        ("ads_outputs_non_empty", f"{filled} = 7", f"({filled})", "7", "critical"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CASE WHEN {passes} THEN 'pass' ELSE '{'fail' if severity == 'critical' else 'warn'}' END"
        f" AS check_status, CAST({observed} AS VARCHAR) AS observed_value, '{expected}' AS expected_value, '{severity}' AS severity"
        for name, passes, observed, expected, severity in rows
    )


RELATIONS["checks"] = _check_rows()
RELATIONS["summary"] = """
SELECT count(*) AS total_checks, count(*) FILTER (check_status = 'pass') AS passed_checks,
       count(*) FILTER (check_status = 'fail') AS failed_checks, count(*) FILTER (check_status = 'warn') AS warning_checks,
       coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (severity = 'critical' AND check_status <> 'pass'), '')
           AS blocking_checks,
       CASE WHEN count(*) FILTER (severity = 'critical' AND check_status <> 'pass') > 0 THEN 'fail' ELSE 'pass' END AS status
FROM checks"""
# Event files in turn; a row is late if its hour had ended before the latest time of all earlier files, less the delay.
RELATIONS["by_arrival"] = f"""
SELECT *, date_trunc('hour', behavior_ts) AS hour_start,
       least({LAST_FILE}, (day(behavior_ts) - 1) // {DAYS_PER_FILE}
             + CASE WHEN CAST(substr(behavior_id, 2) AS BIGINT) % {LATE_EVERY} = 0 THEN 1 ELSE 0 END) AS arrival
FROM f_behavior"""
RELATIONS["arrival_marks"] = f"""
SELECT arrival, max(max(behavior_ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY} AS mark
FROM by_arrival GROUP BY arrival"""
RELATIONS["arrived"] = """
SELECT *, coalesce(hour_start + INTERVAL 1 HOUR <= mark, false) AS late FROM by_arrival JOIN arrival_marks USING (arrival)"""

_FACTS = {
    "users": "d_user", "products": "ok_products", "orders": "f_order", "user_behaviors": "f_behavior",
    "user_features": "ok_user_features", "product_features": "ok_product_features",
}
_COUNTS = {
    f"{layer}_{t}": f"(SELECT count(*) FROM {relation})"
    for layer, names in (
        ("raw", {t: f"raw_{t}" for t in c.HEADERS}), ("valid", {t: f"ok_{t}" for t in c.HEADERS}), ("dwd", _FACTS))
    for t, relation in names.items()
}
RELATIONS["profile"] = f"""
SELECT {', '.join(f"{' + '.join(f'{layer}_{t}' for t in c.HEADERS)} AS {layer}_rows" for layer in ('raw', 'valid', 'dwd'))}, *
FROM (SELECT {', '.join(f'{sql} AS {name}' for name, sql in _COUNTS.items())},
             (SELECT count(*) FROM rejected) AS quarantine_rows,
             least((SELECT min(order_date) FROM f_order), (SELECT min(behavior_date) FROM f_behavior)) AS min_event_date,
             greatest((SELECT max(order_date) FROM f_order), (SELECT max(behavior_date) FROM f_behavior)) AS max_event_date)"""


# --- final statements --------------------------------------------------------------------------------------------

_DOUBLES = {
    "account_balance", "price", "unit_price", "total_amount", "discount", "actual_payment", "paid_gmv", "total_spent",
    "avg_order_amount", "total_revenue", "all_order_amount", "completed_gmv", "discount_amount", "paid_aov", "order_amount",
    "completed_aov", "avg_review_score", "order_share", "user_share", "avg_duration_seconds", "previous_stage_conversion",
    "overall_conversion", "completion_rate", "cancellation_refund_rate", "repeat_completed_customer_rate",
}
_TEXTS = {
    "user_id", "product_id", "order_id", "behavior_id", "gender", "province", "city", "member_level", "product_name",
    "category", "brand", "payment_method", "review_content", "behavior_type", "consumption_level", "source_order_status",
    "status_code", "source_behavior_type", "behavior_code", "behavior_group", "age_band", "customer_segment", "stage_name",
    "order_ts", "delivery_ts", "receive_ts", "behavior_ts", "registration_ts", "registration_date", "order_date",
    "behavior_date", "is_paid_lifecycle", "is_completed", "first_order_ts", "last_order_ts", "first_behavior_ts",
    "last_behavior_ts", "min_order_date", "max_order_date", "min_behavior_date", "max_behavior_date", "min_event_date",
    "max_event_date", "order_frequency", "purchase_intent", "conversion_rate", "popularity_score", "order_status",
    "blocking_checks", "status",
}


def _plain(names, relation: str, extra: str = "") -> str:
    """Counts as BIGINT, amounts and rates as DOUBLE, the rest as it is."""
    columns = [
        _dbl(n, n) if n in _DOUBLES else n if n in _TEXTS else _big(n, n) for n in names
    ]
    return f"SELECT {', '.join(columns)}{extra} FROM {relation}"


def _rules(table: str) -> str:
    whole = ", ".join(f"trunc({n}) AS {n}" for n, (_, dtype) in _typed(table).items() if dtype == _WHOLE)
    relation = f"(SELECT * REPLACE ({whole}) FROM stgbad_{table})" if whole else f"stgbad_{table}"
    return _plain(_typed(table), relation, ", reasons AS rejection_reasons")


def _verdicts(table: str) -> str:
    return f"SELECT {KEYS[table]}, reasons AS rejection_reasons, final_reasons AS final_rejection_reasons FROM all_{table}"


def _row_text(table: str) -> str:
    names = [c.ASCII_NAMES.get(h, h) for h in c.HEADERS[table]]
    fields = " || ".join(f"(CASE WHEN {n} IS NULL THEN 'n' ELSE 'v' || length({n}) || ':' || {n} END)" for n in names)
    return f"sha256({fields})"


def _fingerprint(table: str) -> str:
    limb = lambda start: f"sum(CAST(CAST('0x' || substr(d, {start}, 15) AS BIGINT) AS HUGEINT))"
    limbs = " || ':' || ".join(limb(start) for start in (1, 16, 31, 46, 61))
    return (
        f"SELECT '{table}' AS table_name, count(*) AS row_count, sha256({limbs} || ':' || count(*))"
        f" AS content_sha256 FROM (SELECT {_row_text(table)} AS d FROM raw_{table})"
    )


RELATIONS["prints"] = " UNION ALL ".join(_fingerprint(t) for t in c.HEADERS)
_DAILY = ("order_date", "total_orders", "ordering_customers", "units", "all_order_amount", "paid_gmv", "completed_gmv",
          "discount_amount", "paid_orders", "completed_orders", "completed_customers", "cancelled_or_refunded_orders",
          "paid_aov", "avg_review_score")
_PERFORMANCE = ("category", "products", "behavior_events", "engaged_users", "browse_users", "intent_users", "total_orders",
                "ordering_customers", "paid_orders", "paid_customers", "paid_gmv", "paid_aov")
_KPIS = ("min_order_date", "max_order_date", "min_behavior_date", "max_behavior_date", "total_orders", "ordering_customers",
         "paid_orders", "paid_customers", "completed_orders", "completed_customers", "all_order_amount", "paid_gmv",
         "completed_gmv", "paid_aov", "completed_aov", "cancelled_or_refunded_orders", "completion_rate",
         "cancellation_refund_rate", "repeat_completed_customers", "repeat_completed_customer_rate", "behavior_events",
         "behavior_users", "registered_users", "products", "categories", "quarantined_rows")
_FACT_ORDER = ("order_id", "user_id", "product_id", "quantity", "order_ts", "order_date", "source_order_status", "status_code",
               "status_order", "is_paid_lifecycle", "is_completed", "payment_method", "unit_price", "total_amount", "discount",
               "actual_payment", "paid_gmv", "delivery_ts", "receive_ts", "review_score")
_FACT_BEHAVIOR = ("behavior_id", "user_id", "product_id", "source_behavior_type", "behavior_code", "behavior_group",
                  "stage_order", "behavior_ts", "behavior_date", "behavior_hour", "duration_seconds")
_RANKED = "(SELECT *, row_number() OVER (ORDER BY completed_gmv DESC, category) AS category_rank FROM m_category)"


_LAYERS = {
    **{f"ods_{t}_valid": f"ok_{t}" for t in c.HEADERS}, "ods_quarantine": "rejected", "dwd_dim_user": "d_user",
    "dwd_dim_product": "ok_products", "dwd_dim_order_status": "d_status", "dwd_dim_behavior": "d_behavior", "dwd_fact_order": "f_order",
    "dwd_fact_behavior": "f_behavior", "dwd_feature_snapshot_user": "ok_user_features",
    "dwd_feature_snapshot_product": "ok_product_features",
    "dwd_dim_date": "(SELECT order_date FROM f_order UNION SELECT behavior_date FROM f_behavior)",
    "dws_daily_commerce": "m_daily", "dws_order_status_summary": "m_status", "dws_hourly_behavior": "m_hourly",
    "dws_customer_summary": "m_customer", "dws_sequential_funnel": "m_funnel", "dws_customer_segments": "m_segment",
    "dws_category_performance": "m_category", "ads_executive_kpis": "m_kpi", "ads_daily_trend": "m_daily",
    "ads_sequential_funnel": "m_funnel", "ads_category_performance": "m_category", "ads_hourly_behavior": "m_hourly",
    "ads_customer_segments": "m_segment", "ads_order_status": "m_status", "ops_data_quality_results": "checks",
    "ads_dataops_health": "checks",
}


def _finals() -> dict[str, str]:
    bad = "stgbad_orders"
    score, delivered = _opt("review_score", "INT"), _opt("delivery_date", "TIMESTAMP")
    behavior_line = "concat_ws(',', " + ", ".join(c.HEADERS["user_behaviors"][:-1]) + ")"
    evidence = {
        "check_counts_add_up": "passed_checks + failed_checks + warning_checks = total_checks",
        "quality_gate_passed": "status = 'pass' AND failed_checks = 0",
        "raw_equals_valid_plus_quarantine": "raw_rows = valid_rows + quarantine_rows",
        "valid_equals_facts": "valid_rows = dwd_rows",
        "completed_within_total": "completed_orders <= total_orders",
        "customers_within_completed": "completed_customers <= completed_orders",
        "completion_rate_agrees": "abs(completion_rate - completed_orders / total_orders) <= 0.0001",
        "orders_equal_profile": "total_orders = valid_orders",
        "behaviors_equal_profile": "behavior_events = valid_user_behaviors",
        "mode_discloses_source": "true",
    }
    orphan = " UNION ALL ".join(
        f"SELECT '{child}' AS source_table, '{parent}' AS parent, count(*) AS orphan_rows FROM bad_{child} x "
        f"WHERE NOT EXISTS (SELECT 1 FROM bad_{parent} p WHERE p.{key} = x.{key})"
        for child in ("orders", "user_behaviors") for parent, key in (("users", "user_id"), ("products", "product_id"))
    )
    return {
        "order_status_summary": _plain(
            ("source_order_status", "status_code", "status_order", "order_count", "customer_count", "order_amount", "paid_gmv",
             "order_share"), "m_status"),
        "users_rules": _rules("users"),
        "products_rules": _rules("products"),
        "orders_rules": _rules("orders"),
        "behaviors_rules": _rules("user_behaviors"),
        "user_features_rules": _rules("user_features"),
        "product_features_rules": _rules("product_features"),
        "optional_field_parse": f"""SELECT trim(order_id) AS order_id, CAST({score} AS BIGINT) AS review_score,
            (NOT {_blank('review_score')} AND ({score}) IS NULL) AS bad_review_score, {delivered} AS delivery_ts,
            (NOT {_blank('delivery_date')} AND ({delivered}) IS NULL) AS bad_delivery_date,
            nullif(trim(review_content), '') AS review_content FROM bad_orders""",
        "integral_decimal_parse": f"""SELECT user_id, CAST(trunc({_num('order_count', _WHOLE)}) AS BIGINT) AS order_count,
            ({_num('order_count', _WHOLE)} % 1 <> 0) AS has_fraction,
            CAST({_num('total_spent', _MONEY)} AS DOUBLE) AS total_spent FROM bad_user_features""",
        "orders_validated": _verdicts("orders"),
        "behaviors_validated": _verdicts("user_behaviors"),
        "user_features_validated": _verdicts("user_features"),
        "product_features_validated": _verdicts("product_features"),
        "valid_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS source_table, count(*) FILTER (final_reasons = '') AS valid_rows,"
            f" count(*) FILTER (final_reasons <> '') AS quarantined_rows FROM all_{t}" for t in c.HEADERS),
        "quarantine_rows": "SELECT *, source_table || '.csv' AS source_file, TIMESTAMP '2024-02-01' AS ingested_at,"
        " TIMESTAMP '2024-02-01' AS quarantined_at FROM rejected",
        "rejection_reason_frequency": """SELECT source_table, reason, count(*) AS rejected_rows
            FROM (SELECT source_table, unnest(string_split(rejection_reasons, ';')) AS reason FROM rejected) GROUP BY ALL""",
        "dim_user": _plain(("user_id", "age", "age_band", "gender", "province", "city", "registration_date", "member_level",
                            "account_balance", "credit_score"), "d_user"),
        "dim_product": _plain(("product_id", "product_name", "category", "brand", "price", "sales_count"), "ok_products"),
        "dim_date": """SELECT d AS calendar_date, CAST(year(d) AS BIGINT) AS calendar_year, CAST(quarter(d) AS BIGINT) AS calendar_quarter,
            CAST(month(d) AS BIGINT) AS calendar_month, CAST(day(d) AS BIGINT) AS day_of_month, CAST(weekofyear(d) AS BIGINT) AS week_of_year,
            CAST(isodow(d) AS BIGINT) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
            FROM (SELECT order_date AS d FROM f_order UNION SELECT behavior_date FROM f_behavior)""",
        "fact_order": _plain(_FACT_ORDER, "f_order"),
        "fact_behavior": _plain(_FACT_BEHAVIOR, "f_behavior"),
        "snapshot_user": _plain(_typed("user_features"), "ok_user_features"),
        "snapshot_product": _plain(_typed("product_features"), "ok_product_features"),
        "daily_commerce": _plain(_DAILY, "m_daily"),
        "hourly_behavior": _plain(("behavior_hour", "behavior_events", "active_users", *[f"{b}_events" for b in c.BEHAVIOR_TEXT],
                                   "avg_duration_seconds"), "m_hourly"),
        "customer_summary": _plain(
            ("user_id", "age_band", "gender", "province", "city", "member_level", "total_orders", "paid_orders",
             "completed_orders", "all_order_amount", "paid_gmv", "first_order_ts", "last_order_ts", "behavior_events",
             *[f"{b}_events" for b in c.BEHAVIOR_TEXT], "first_behavior_ts", "last_behavior_ts", "customer_segment"), "m_customer"),
        "customer_segments": _plain(("segment_order", "customer_segment", "user_count", "total_orders", "paid_orders", "paid_gmv",
                                     "behavior_events", "user_share"), "m_segment"),
        "sequential_funnel": _plain(("stage_order", "stage_name", "user_count", "previous_stage_conversion", "overall_conversion"),
                                    "m_funnel"),
        "repeat_customers": "SELECT * FROM m_done WHERE completed_orders >= 2",
        "category_performance": _plain(_PERFORMANCE, "m_category"),
        "category_ranking": _plain(("category_rank", *_PERFORMANCE, "completed_orders", "completed_customers", "completed_gmv"), _RANKED),
        "executive_kpis": _plain(_KPIS, "m_kpi"),
        "orphan_rows": f"SELECT * FROM ({orphan}) WHERE orphan_rows > 0",
        "duplicate_keys": " UNION ALL ".join(
            f"SELECT '{t}' AS source_table, count(*) - count(DISTINCT {k}) AS duplicate_rows FROM bad_{t}" for t, k in KEYS.items()),
        "lifecycle_violations": f"SELECT order_id, order_status, order_ts, delivery_ts, receive_ts FROM ok_orders WHERE {_LIFECYCLE}",
        "amount_mismatches": f"""SELECT * FROM (SELECT order_id, abs(total_amount - discount - actual_payment) > 0.01 AS equation_off,
            abs(unit_price * quantity - total_amount) > 0.01 AS unit_price_off FROM {bad} WHERE reasons = '')
            WHERE equation_off OR unit_price_off""",
        "user_feature_mismatches": "SELECT user_id, mismatch, days_since_last_order = 999 AS last_order_sentinel FROM q_user",
        "product_feature_mismatches": "SELECT product_id, mismatch FROM q_product",
        "kpi_reconciliation": """SELECT check_name, check_status, observed_value FROM checks
            WHERE check_name IN ('executive_kpis_reconcile', 'daily_orders_reconcile', 'customer_segments_reconcile')""",
        "quality_checks": "SELECT * FROM checks",
        "layers_by_name": " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, (SELECT count(*) FROM {rows}) AS layer_rows" for layer, rows in _LAYERS.items()),
        "quality_summary": "SELECT * FROM summary",
        "row_profile": _plain(("raw_rows", "valid_rows", "quarantine_rows", "dwd_rows", *_COUNTS, "min_event_date", "max_event_date"),
                              "profile"),
        "evidence_reconciliation": " UNION ALL ".join(
            f"SELECT '{name}' AS statement, coalesce({sql}, false) AS holds FROM m_kpi, profile, summary" for name, sql in evidence.items()),
        "hourly_behavior_long": " UNION ALL ".join(
            f"SELECT CAST(behavior_hour AS BIGINT) AS behavior_hour, '{b}_events' AS behavior, {b}_events AS events FROM m_hourly"
            for b in c.BEHAVIOR_TEXT),
        "top_categories": "SELECT category, CAST(completed_gmv AS DOUBLE) AS completed_gmv FROM m_category ORDER BY 2 DESC, 1 LIMIT 10",
        "check_status_counts": "SELECT check_status, count(*) AS checks FROM checks GROUP BY 1",
        "daily_series": _plain(("order_date", "completed_gmv", "completed_orders"), "m_daily"),
        "status_series": _plain(("status_order", "source_order_status", "order_count"), "m_status"),
        "segment_series": _plain(("segment_order", "customer_segment", "user_count", "user_share"), "m_segment"),
        "kpi_cards": " UNION ALL ".join(
            f"SELECT '{card}' AS card, CAST({name} AS DOUBLE) AS value FROM m_kpi" for card, name in KPI_CARDS.items()),
        "csv_roundtrip": f"SELECT {', '.join(c.HEADERS['users'])} FROM raw_users",
        "csv_corrupt_capture": f"""SELECT behavior_id, behavior_type, CASE WHEN k % 11 <> 0 THEN duration_seconds END AS duration_seconds,
            CASE WHEN k % 11 = 0 THEN {behavior_line} END AS corrupt_record FROM raw_user_behaviors""",
        "csv_contract_check": """SELECT 'products' AS table_name, true AS header_ok, count(*) AS data_rows, 0::BIGINT AS wrong_width_rows FROM part
            UNION ALL SELECT 'user_behaviors', true, count(*), count(*) FILTER (event_id % 11 = 0) FROM events
            UNION ALL SELECT 'product_features', false, count(*), count(*) FROM customer""",
        "parquet_roundtrip": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS written_rows FROM raw_{t}" for t in c.HEADERS),
        "table_fingerprint": "SELECT * FROM prints",
        "combined_fingerprint": f"""SELECT CAST(sum(row_count) AS BIGINT) AS row_count,
            sha256(string_agg(table_name || chr(10) || content_sha256 || chr(10), '' ORDER BY list_position({list(c.HEADERS)}, table_name)))
            AS combined_sha256 FROM prints""",
        "typed_release_read": """SELECT CAST(order_date AS TIMESTAMP) AS order_date, CAST(total_orders AS DOUBLE) AS total_orders,
            CAST(paid_gmv AS DOUBLE) AS paid_gmv, CAST(completed_gmv AS DOUBLE) AS completed_gmv, CAST(paid_aov AS DOUBLE) AS paid_aov,
            CAST(completed_customers AS DOUBLE) AS completed_customers FROM m_daily""",
        "exported_customers": """SELECT user_id, member_level, CAST(total_orders AS DOUBLE) AS total_orders, CAST(paid_gmv AS DOUBLE) AS paid_gmv,
            CAST(first_order_ts AS TIMESTAMP) AS first_order_ts, CAST(behavior_events AS DOUBLE) AS behavior_events, customer_segment,
            TRUE AS in_order FROM m_customer""",
        "gated_publish": """SELECT CASE WHEN status = 'pass' THEN 'published' ELSE 'withheld' END AS outcome, blocking_checks FROM summary""",
        "catalog_tables": " UNION ALL ".join(
            f"SELECT '{layer}' AS table_name, 'Grain: {GRAINS[layer]}.' AS grain, (SELECT count(*) FROM {rows}) AS table_rows"
            for layer, rows in _LAYERS.items()),
        "raw_views": " UNION ALL ".join(f"SELECT 'raw_{t}_raw' AS view_name, count(*) AS view_rows FROM raw_{t}" for t in c.HEADERS),
        "streamed_hourly_behavior": f"""SELECT hour_start, count(*) FILTER (NOT late) AS behavior_events,
            count(DISTINCT user_id) FILTER (NOT late) AS active_users,
            {', '.join(f"count(*) FILTER (NOT late AND behavior_code = '{b}') AS {b}_events" for b in c.BEHAVIOR_TEXT)},
            CAST(coalesce(sum(duration_seconds) FILTER (NOT late), 0) AS BIGINT) AS duration_seconds, count(*) FILTER (late) AS late_events
            FROM arrived WHERE hour_start + INTERVAL 1 HOUR <= (SELECT max(behavior_ts) - INTERVAL {DELAY} FROM f_behavior) GROUP BY 1""",
        "sketched_customers": "SELECT status_code, count(DISTINCT user_id) AS customer_count, true AS within_bound FROM f_order GROUP BY 1",
    }


def _needed(sql: str, relations: dict[str, str]) -> list[str]:
    """Relations a statement depends on, in definition order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        for word in set(re.findall(r"\b[a-z_]+\b", queue.pop())):
            if word in relations and word not in found:
                found.add(word)
                queue.append(relations[word])
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for word in re.findall(r"\b[a-z_]+\b", relations[name]):
            if word in relations and word != name:
                place(word)
        order.append(name)

    for name in relations:
        if name in found:
            place(name)
    return order


def statements() -> dict[str, str]:
    finals = _finals()
    out = {name: _composed(sql, RELATIONS) for name, sql in finals.items()}
    for name, whole in (("streamed_quarantine", "quarantine_rows"), ("replaced_daily_commerce", "daily_commerce"),
                        ("replaced_order_status", "order_status_summary"), ("replaced_hourly_behavior", "hourly_behavior")):
        # What came in pieces must equal what is computed at once.
        out[name] = out[whole]
    repaired = _repaired()
    for output, (source, columns) in _OUTPUTS.items():
        out[f"published_{output.removeprefix('ads_')}"] = _read_back(_composed(finals[source], repaired), output, columns)
    counts = "SELECT count(*) AS n, '{0}' AS output FROM ({1})"
    sizes = " UNION ALL ".join(counts.format(output, _composed(finals[source], repaired)) for output, (source, _) in _OUTPUTS.items())
    out["republished_outputs"] = f"SELECT output, n AS output_rows, CAST(0 AS BIGINT) AS different FROM ({sizes})"
    outcome = """SELECT '{0}' AS variant, CASE WHEN status = 'pass' THEN 'published' ELSE 'withheld' END AS outcome, blocking_checks,
        status = 'pass' AS pointer_leads_here, CAST(CASE WHEN status = 'pass' THEN 8 ELSE 0 END AS BIGINT) AS exports,
        CAST(33 AS BIGINT) AS statements, raw_rows AS input_rows, valid_rows, quarantine_rows FROM summary, profile"""
    out["publication_outcome"] = " UNION ALL ".join(
        f"SELECT * FROM ({_composed(outcome.format(variant), relations)})" for variant, relations in (("given", RELATIONS), ("repaired", repaired)))
    repeated = dict(RELATIONS)
    for table, step in REPEATS.items():
        once = RELATIONS[f"raw_{table}"]
        repeated[f"raw_{table}"] = f"SELECT * FROM ({once}) UNION ALL SELECT * FROM ({once}) WHERE k % {step} = 0"
    out["quality_checks_repeated_parents"] = _composed(finals["quality_checks"], repeated)
    return out


def _repaired() -> dict[str, str]:
    """The relations over tables whose faulty values were replaced by sound ones."""
    parts = "(SELECT count(*) FROM part)"
    shipped = c.STATUS_TEXT["shipped"]
    zeros = ", ".join(f"coalesce({name}, 0) AS {name}" for name in ("unit_price", "total", "discount", "paid"))
    replaced = {
        "o_rows": f"coalesce(product, k % {parts}) AS product, coalesce(quantity, 1) AS quantity, {zeros}",
        "e_rows": "coalesce(behavior, 'browse') AS behavior",
        "raw_users": "CAST(least(k % 90 + 13, 100) AS VARCHAR) AS age, replace(account_balance, '-', '') AS account_balance",
        "raw_products": "CASE WHEN trim(brand) = '' THEN 'Brand#' || k ELSE brand END AS brand",
        "raw_orders": f"""CASE WHEN delivery_date = '' AND receive_date <> '' THEN receive_date
            WHEN delivery_date = '' AND k % 211 = 0 AND order_status = '{shipped}' THEN order_date ELSE delivery_date END AS delivery_date""",
        "raw_user_features": "CASE WHEN k % 97 = 0 THEN CAST(CAST(total_spent AS DECIMAL(18,2)) - 1 AS VARCHAR) ELSE total_spent END AS total_spent",
        "raw_product_features": "CASE WHEN k % 89 = 1 THEN CAST(CAST(total_sales AS BIGINT) - 1 AS VARCHAR) ELSE total_sales END AS total_sales",
    }
    return RELATIONS | {name: f"SELECT * REPLACE ({columns}) FROM ({RELATIONS[name]})" for name, columns in replaced.items()}


_OUTPUT_TEXTS = {"stage_name", "category", "customer_segment", "source_order_status", "status_code", "check_name", "check_status", "severity",
                 "observed_value", "expected_value", "data_mode", "source_status"}
_OUTPUT_TIMES = {"order_date", "run_date", "min_order_date", "max_order_date", "min_behavior_date", "max_behavior_date", "checked_at"}
# Output -> the statement of its rows and the columns read back.
_OUTPUTS = {
    "ads_executive_kpis": ("executive_kpis", _KPIS),
    "ads_daily_trend": ("daily_commerce", _DAILY),
    "ads_sequential_funnel": ("sequential_funnel", ("stage_order", "stage_name", "user_count", "previous_stage_conversion", "overall_conversion")),
    "ads_category_performance": ("category_ranking", ("category_rank", *_PERFORMANCE, "completed_orders", "completed_customers", "completed_gmv")),
    "ads_hourly_behavior": ("hourly_behavior", ("behavior_hour", "behavior_events", "active_users", *[f"{b}_events" for b in c.BEHAVIOR_TEXT],
                                                "avg_duration_seconds")),
    "ads_customer_segments": ("customer_segments", ("segment_order", "customer_segment", "user_count", "total_orders", "paid_orders", "paid_gmv",
                                                    "behavior_events", "user_share")),
    "ads_order_status": ("order_status_summary", ("source_order_status", "status_code", "status_order", "order_count", "customer_count",
                                                  "order_amount", "paid_gmv", "order_share")),
    "ads_dataops_health": ("quality_checks", ("check_name", "check_status", "severity", "observed_value", "expected_value")),
}
# Columns that a release adds to what the statement gives.
_OUTPUT_EXTRAS = {
    "ads_executive_kpis": ", TIMESTAMP '2024-02-01' AS run_date, 'PORTFOLIO' AS data_mode, 'UNVERIFIED' AS source_status",
    "ads_dataops_health": ", TIMESTAMP '2024-02-01' AS checked_at",
}


def _read_back(sql: str, output: str, columns) -> str:
    def typed(name: str) -> str:
        return f"{name}" if name in _OUTPUT_TEXTS else f"CAST({name} AS {'TIMESTAMP' if name in _OUTPUT_TIMES else 'DOUBLE'}) AS {name}"

    return f"SELECT {', '.join(map(typed, columns))}{_OUTPUT_EXTRAS.get(output, '')} FROM ({sql})"


def _composed(sql: str, all_relations: dict[str, str]) -> str:
    relations = ", ".join(f"{r} AS ({all_relations[r]})" for r in _needed(sql, all_relations))
    return f"WITH {relations} {sql}" if relations else sql
