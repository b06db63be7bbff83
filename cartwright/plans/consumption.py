"""Chart-ready views of the published aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.functions.parsing import exprs, literal, rows_of

# The six headline cards and the KPI column behind each.
KPI_CARDS = {
    "Valid orders": "total_orders",
    "Completed orders": "completed_orders",
    "Sample amount": "completed_gmv",
    "Completed customers": "completed_customers",
    "Completion rate": "completion_rate",
    "Behavior events": "behavior_events",
}


def hourly_behavior_long(hourly: DataFrame) -> DataFrame:
    kinds = [f"{b.behavior_code}_events" for b in c.BEHAVIORS]
    return hourly.unpivot("behavior_hour", kinds, "behavior", "events")


def top_categories(ranking: DataFrame, n: int = 10) -> DataFrame:
    """The n categories with the largest completed amount, smallest first."""
    top = ranking.orderBy(F.desc("completed_gmv"), F.asc("category")).limit(n)
    return top.select("category", "completed_gmv").orderBy("completed_gmv")


def check_status_counts(health: DataFrame) -> DataFrame:
    return health.groupBy(F.lower("check_status").alias("check_status")).agg(*exprs("count(1) AS checks"))


def daily_series(daily: DataFrame) -> DataFrame:
    """Days present in the data only; a missing day is not a zero."""
    return daily.dropna(subset=["order_date"]).select(
        "order_date", "completed_gmv", "completed_orders"
    ).orderBy("order_date")


def status_series(status: DataFrame) -> DataFrame:
    return status.select("status_order", "source_order_status", "order_count").orderBy("status_order")


def segment_series(segments: DataFrame) -> DataFrame:
    return segments.select("segment_order", "customer_segment", "user_count", "user_share").orderBy("segment_order")


def kpi_cards(kpi_row: DataFrame) -> DataFrame:
    return kpi_row.selectExpr(
        rows_of({"card": literal(card), "value": f"CAST({name} AS DOUBLE)"} for card, name in KPI_CARDS.items())
    )
