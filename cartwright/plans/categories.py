"""Category performance and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright import contract as c
from cartwright.functions import measures as m
from cartwright.functions.parsing import exprs, listed
from cartwright.plans.activity import COMPLETED, PAID, PAYMENT

PERFORMANCE_COLUMNS = (
    "category", "products", "behavior_events", "engaged_users", "browse_users", "intent_users",
    "total_orders", "ordering_customers", "paid_orders", "paid_customers", "paid_gmv", "paid_aov",
)
COMPLETED_COLUMNS = ("completed_orders", "completed_customers", "completed_gmv")
_MAY_BE_NULL = ("category", "products", "paid_aov")


def category_activity(dim_product: DataFrame, fact_order: DataFrame, fact_behavior: DataFrame) -> DataFrame:
    """Every category with its activity.

    The facts meet the product dimension without a broadcast hint; the dimension is
    cut to key and category first.
    """
    kind = dim_product.select("product_id", "category")
    behaved = m.report(
        fact_behavior.join(kind, "product_id"), ["category"], "user_id",
        {
            "behavior_events": m.row_count(),
            "engaged_users": m.entities(),
            "browse_users": m.entities_where("behavior_code = 'browse'"),
            "intent_users": m.entities_where(f"behavior_code IN ({listed(c.INTENT_BEHAVIORS)})"),
        },
    )
    ordered = m.report(
        fact_order.join(kind, "product_id"), ["category"], "user_id",
        {
            "total_orders": m.row_count(),
            "ordering_customers": m.entities(),
            "paid_orders": m.rows_where(PAID),
            "paid_customers": m.entities_where(PAID),
            "paid_gmv": m.total("paid_gmv"),
            "paid_aov": m.mean(PAYMENT, PAID),
            "completed_orders": m.rows_where(COMPLETED),
            "completed_customers": m.entities_where(COMPLETED),
            "completed_gmv": m.total_where(COMPLETED, PAYMENT),
        },
    )
    joined = (
        dim_product.groupBy("category").agg(*exprs("count(1) AS products"))
        .join(behaved, "category", "left")
        .join(ordered, "category", "left")
    )
    return joined.selectExpr(
        *[
            name if name in _MAY_BE_NULL else f"coalesce({name}, 0) AS {name}"
            for name in PERFORMANCE_COLUMNS + COMPLETED_COLUMNS
        ]
    )
