"""The one-row executive snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright.functions import measures as m
from cartwright.functions.parsing import exprs, literal, named, safe_ratio
from cartwright.operators.relations import side_by_side
from cartwright.plans.activity import CALLED_OFF, COMPLETED, PAID, PAYMENT

# Published column order.
KPI_COLUMNS = (
    "min_order_date", "max_order_date", "min_behavior_date", "max_behavior_date",
    "total_orders", "ordering_customers", "paid_orders", "paid_customers",
    "completed_orders", "completed_customers", "all_order_amount", "paid_gmv", "completed_gmv",
    "paid_aov", "completed_aov", "cancelled_or_refunded_orders", "completion_rate",
    "cancellation_refund_rate", "repeat_completed_customers", "repeat_completed_customer_rate",
    "behavior_events", "behavior_users", "registered_users", "products", "categories",
    "quarantined_rows",
)


def executive_kpis(
    fact_order: DataFrame,
    fact_behavior: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    quarantined: DataFrame,
) -> DataFrame:
    """One pass over each input; repeat customers come out of the same per-user fold."""
    orders = m.report(
        fact_order, [], "user_id",
        {
            "min_order_date": m.earliest("order_date"),
            "max_order_date": m.latest("order_date"),
            "total_orders": m.row_count(),
            "ordering_customers": m.entities(),
            "paid_orders": m.rows_where(PAID),
            "paid_customers": m.entities_where(PAID),
            "completed_orders": m.rows_where(COMPLETED),
            "completed_customers": m.entities_where(COMPLETED),
            "all_order_amount": m.total(PAYMENT),
            "paid_gmv": m.total("paid_gmv"),
            "completed_gmv": m.total_where(COMPLETED, PAYMENT),
            "paid_aov": m.mean(PAYMENT, PAID),
            "completed_aov": m.mean(PAYMENT, COMPLETED),
            "cancelled_or_refunded_orders": m.rows_where(CALLED_OFF),
            "repeat_completed_customers": m.entities_where(COMPLETED, at_least=2),
        },
    )
    behaviors = m.report(
        fact_behavior, [], "user_id",
        {
            "min_behavior_date": m.earliest("behavior_date"),
            "max_behavior_date": m.latest("behavior_date"),
            "behavior_events": m.row_count(),
            "behavior_users": m.entities(),
        },
    )
    catalog = m.report(dim_product, [], "category", {"products": m.row_count(), "categories": m.entities()})
    population = dim_user.agg(*exprs("count(1) AS registered_users"))
    rejected = quarantined.agg(*exprs("count(1) AS quarantined_rows"))
    row = side_by_side([orders, behaviors, catalog, population, rejected])
    rates = {
        "completion_rate": safe_ratio("completed_orders", "total_orders"),
        "cancellation_refund_rate": safe_ratio("cancelled_or_refunded_orders", "total_orders"),
        "repeat_completed_customer_rate": safe_ratio("repeat_completed_customers", "completed_customers"),
    }
    return row.selectExpr("*", *named(rates)).select(*KPI_COLUMNS)


def with_run_constants(kpi_row: DataFrame, run_date: str, data_mode: str, source_status: str) -> DataFrame:
    return kpi_row.selectExpr(
        f"DATE {literal(run_date)} AS run_date",
        f"{literal(data_mode.upper())} AS data_mode",
        f"{literal(source_status.upper())} AS source_status",
        "*",
    )
