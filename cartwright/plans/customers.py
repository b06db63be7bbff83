"""Customer summary, segments and the sequential funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright import contract as c
from cartwright.functions.parsing import exprs, listed, literal
from cartwright.operators.funnel import stage_depth, stage_report
from cartwright.operators.relations import with_share

# Stage names of the published funnel.
FUNNEL_STAGES = ("browse", "click_after_browse", "intent_after_click", "paid_order_after_intent")

_KINDS = [f"{b.behavior_code}_events" for b in c.BEHAVIORS]


def customer_summary(dim_user: DataFrame, fact_order: DataFrame, fact_behavior: DataFrame) -> DataFrame:
    """Both facts are reduced to one row per user before they meet the dimension."""
    ordered = fact_order.groupBy("user_id").agg(
        *exprs(
            "count(1) AS total_orders",
            "count_if(is_paid_lifecycle) AS paid_orders",
            "count_if(is_completed) AS completed_orders",
            "round(sum(actual_payment), 2) AS all_order_amount",
            "round(sum(paid_gmv), 2) AS paid_gmv",
            "min(order_ts) AS first_order_ts",
            "max(order_ts) AS last_order_ts",
        )
    )
    behaved = fact_behavior.groupBy("user_id").agg(
        *exprs(
            "count(1) AS behavior_events",
            *[f"count_if(behavior_code = {literal(b.behavior_code)}) AS {k}" for b, k in zip(c.BEHAVIORS, _KINDS)],
            "min(behavior_ts) AS first_behavior_ts",
            "max(behavior_ts) AS last_behavior_ts",
        )
    )

    def or_zero(*names: str) -> list[str]:
        return [f"coalesce({name}, 0) AS {name}" for name in names]

    who = ("user_id", "age_band", "gender", "province", "city", "member_level")
    return (
        dim_user.select(*who)
        .join(ordered, "user_id", "left")
        .join(behaved, "user_id", "left")
        .selectExpr(
            *who,
            *or_zero("total_orders", "paid_orders", "completed_orders", "all_order_amount", "paid_gmv"),
            "first_order_ts", "last_order_ts",
            *or_zero("behavior_events", *_KINDS),
            "first_behavior_ts", "last_behavior_ts",
        )
        .selectExpr("*", f"{_segment()} AS customer_segment")
    )


def _segment() -> str:
    conditions = ("paid_orders >= 2", "paid_orders = 1", "total_orders > 0", "behavior_events > 0")
    arms = " ".join(f"WHEN {rule} THEN {literal(name)}" for rule, name in zip(conditions, c.SEGMENTS))
    return f"CASE {arms} ELSE {literal(c.SEGMENTS[-1])} END"


def customer_segments(summary: DataFrame) -> DataFrame:
    per_segment = summary.groupBy("customer_segment").agg(
        *exprs(
            "count(1) AS user_count",
            "sum(total_orders) AS total_orders",
            "sum(paid_orders) AS paid_orders",
            "round(sum(paid_gmv), 2) AS paid_gmv",
            "sum(behavior_events) AS behavior_events",
        )
    )
    position = f"CAST(array_position(array({listed(c.SEGMENTS)}), customer_segment) AS INT) AS segment_order"
    return with_share(per_segment.selectExpr(position, "*"), "user_count", "user_share")


def sequential_funnel(fact_behavior: DataFrame, fact_order: DataFrame) -> DataFrame:
    steps = fact_behavior.selectExpr("user_id", "behavior_ts AS at", "behavior_code AS step").unionByName(
        fact_order.filter("is_paid_lifecycle").selectExpr("user_id", "order_ts AS at", "'paid_order' AS step")
    )
    intent = f"step IN ({listed(c.INTENT_BEHAVIORS)})"
    stages = ["step = 'browse'", "step = 'click'", intent, "step = 'paid_order'"]
    return stage_report(stage_depth(steps, "user_id", "at", stages), FUNNEL_STAGES)


def repeat_customers(fact_order: DataFrame, at_least: int = 2) -> DataFrame:
    """Customers with several completed orders."""
    counted = fact_order.filter("is_completed").groupBy("user_id").agg(*exprs("count(1) AS completed_orders"))
    return counted.filter(f"completed_orders >= {at_least}")
