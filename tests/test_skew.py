"""One user and one product hold a third of all rows: same results, and the join splits."""

import pytest

from cartwright.plans.warehouse import Warehouse

HOT = "IF(id % 3 = 0, 7, 1 + id % 211)"


@pytest.fixture(scope="module")
def skewed(spark):
    users = spark.range(1, 221).selectExpr(
        "concat('U', lpad(id, 6, '0')) AS user_id", "'30' AS age", "'男' AS gender", "'东' AS province", "'城' AS city",
        "'2020-01-01 00:00:00' AS registration_date", "'普通会员' AS member_level", "'1.00' AS account_balance",
        "'500' AS credit_score",
    )
    products = spark.range(1, 221).selectExpr(
        "concat('P', lpad(id, 6, '0')) AS product_id", "'thing' AS product_name", "concat('kind', id % 5) AS category",
        "'maker' AS brand", "'1.00' AS price", "'1' AS sales_count",
    )
    ids = [f"concat('U', lpad({HOT}, 6, '0')) AS user_id", f"concat('P', lpad({HOT}, 6, '0')) AS product_id"]
    orders = spark.range(0, 30000, 1, 8).selectExpr(
        "concat('O', lpad(id, 8, '0')) AS order_id", *ids, "'2' AS quantity",
        "date_format(timestamp_seconds(1704067200 + id * 61), 'yyyy-MM-dd HH:mm:ss') AS order_date",
        "element_at(array('已完成', '已付款', '已取消'), CAST(id % 7 % 3 + 1 AS INT)) AS order_status", "'card' AS payment_method",
        "'5.00' AS unit_price", "'10.00' AS total_amount", "'1.00' AS discount", "'9.00' AS actual_payment",
        "'' AS delivery_date", "'' AS receive_date", "'' AS review_score", "'' AS review_content",
    )
    behaviors = spark.range(0, 30000, 1, 8).selectExpr(
        "concat('B', lpad(id, 8, '0')) AS behavior_id", *ids,
        "element_at(array('浏览', '点击', '收藏', '加购'), CAST(id % 11 % 4 + 1 AS INT)) AS behavior_type",
        "date_format(timestamp_seconds(1704067200 + id * 59), 'yyyy-MM-dd HH:mm:ss') AS behavior_time", "'3' AS duration_seconds",
    )
    return {"users": users, "products": products, "orders": orders, "user_behaviors": behaviors}


@pytest.fixture
def forced_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_parent_join_splits_the_hot_key(spark, skewed, forced_split):
    rows = Warehouse(spark, skewed).staged_orders.select("order_id", "user_id", "accepted")
    found = rows.collect()
    assert len(found) == 30000 and all(r["accepted"] for r in found)
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_results_equal_plain_sql(spark, skewed, forced_split):
    w = Warehouse(spark, skewed)
    w.fact_order.createOrReplaceTempView("hot_orders")
    w.fact_behavior.createOrReplaceTempView("hot_behaviors")
    daily = {r["order_date"]: (r["total_orders"], r["ordering_customers"], r["completed_customers"]) for r in w.daily_commerce.collect()}
    plain = spark.sql(
        "SELECT order_date, count(*), count(DISTINCT user_id), count(DISTINCT IF(is_completed, user_id, NULL))"
        " FROM hot_orders GROUP BY 1"
    )
    assert daily == {r[0]: tuple(r)[1:] for r in plain.collect()}
    funnel = [r["user_count"] for r in w.sequential_funnel.orderBy("stage_order").collect()]
    chained = spark.sql(
        """WITH a AS (SELECT user_id, min(behavior_ts) t FROM hot_behaviors WHERE behavior_code = 'browse' GROUP BY 1),
        b AS (SELECT user_id, min(behavior_ts) t FROM hot_behaviors JOIN a USING (user_id)
              WHERE behavior_code = 'click' AND behavior_ts >= t GROUP BY 1),
        i AS (SELECT user_id, min(behavior_ts) t FROM hot_behaviors JOIN b USING (user_id)
              WHERE behavior_group = 'intent' AND behavior_ts >= t GROUP BY 1),
        p AS (SELECT user_id FROM hot_orders JOIN i USING (user_id) WHERE is_paid_lifecycle AND order_ts >= t GROUP BY 1)
        SELECT (SELECT count(*) FROM a), (SELECT count(*) FROM b), (SELECT count(*) FROM i), (SELECT count(*) FROM p)"""
    ).first()
    assert funnel == list(chained) and funnel[0] > 200
