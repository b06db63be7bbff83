"""Daily commerce, order-status and hourly behavior summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright import contract as c
from cartwright.functions import measures as m
from cartwright.functions.parsing import listed, literal
from cartwright.operators.relations import with_share

PAID, COMPLETED, PAYMENT = "is_paid_lifecycle", "is_completed", "actual_payment"
CALLED_OFF = f"status_code IN ({listed(c.CANCELLED_OR_REFUNDED)})"


ENTITY = "user_id"
DAILY = {
    "total_orders": m.row_count(),
    "ordering_customers": m.entities(),
    "units": m.total("quantity", None),
    "all_order_amount": m.total(PAYMENT),
    "paid_gmv": m.total("paid_gmv"),
    "completed_gmv": m.total_where(COMPLETED, PAYMENT),
    "discount_amount": m.total("discount"),
    "paid_orders": m.rows_where(PAID),
    "completed_orders": m.rows_where(COMPLETED),
    "completed_customers": m.entities_where(COMPLETED),
    "cancelled_or_refunded_orders": m.rows_where(CALLED_OFF),
    "paid_aov": m.mean(PAYMENT, PAID),
    "avg_review_score": m.mean("review_score", COMPLETED),
}
STATUS_KEYS = ["source_order_status", "status_code", "status_order"]
STATUS = {
    "order_count": m.row_count(),
    "customer_count": m.entities(),
    "order_amount": m.total(PAYMENT),
    "paid_gmv": m.total("paid_gmv"),
}
HOURLY = {
    "behavior_events": m.row_count(),
    "active_users": m.entities(),
    **{f"{b.behavior_code}_events": m.rows_where(f"behavior_code = {literal(b.behavior_code)}") for b in c.BEHAVIORS},
    "avg_duration_seconds": m.mean("duration_seconds"),
}


def daily_commerce(fact_order: DataFrame) -> DataFrame:
    return m.report(fact_order, ["order_date"], ENTITY, DAILY)


def order_status_summary(fact_order: DataFrame) -> DataFrame:
    return with_share(m.report(fact_order, STATUS_KEYS, ENTITY, STATUS), "order_count", "order_share")


def hourly_behavior(fact_behavior: DataFrame) -> DataFrame:
    return m.report(fact_behavior, ["behavior_hour"], ENTITY, HOURLY)
