"""The commerce data contract: file headers, enumerations, id formats and code dimensions.

Everything in this module is data.  Operators and plans take it as input.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

# --- Fixed values: input headers, one per file, in contract order -------------------------------

HEADERS: dict[str, tuple[str, ...]] = {
    "users": (
        "user_id", "age", "gender", "province", "city", "registration_date",
        "member_level", "account_balance", "credit_score",
    ),
    "products": (
        "product_id", "product_name", "category", "brand", "price", "sales_count",
    ),
    "orders": (
        "order_id", "user_id", "product_id", "quantity", "order_date", "order_status",
        "payment_method", "unit_price", "total_amount", "discount", "actual_payment",
        "delivery_date", "receive_date", "review_score", "review_content",
    ),
    "user_behaviors": (
        "behavior_id", "user_id", "product_id", "behavior_type", "behavior_time",
        "duration_seconds",
    ),
    "user_features": (
        "user_id", "total_spent", "order_count", "completed_orders", "avg_order_amount",
        "browse_count", "click_count", "favorite_count", "cart_count",
        "days_since_last_order", "order_frequency", "repurchase_indicator",
        "purchase_intent", "consumption_level", "member_level_score",
    ),
    "product_features": (
        "product_id", "total_revenue", "total_sales", "completed_count", "cancel_count",
        "加购_count", "收藏_count", "浏览_count", "点击_count", "conversion_rate",
        "avg_review_score", "popularity_score",
    ),
}

# Headers that get an ASCII name on the way in.
ASCII_NAMES = {
    "加购_count": "cart_count",
    "收藏_count": "favorite_count",
    "浏览_count": "browse_count",
    "点击_count": "click_count",
}

# --- Fixed values: enumerations -----------------------------------------------------------------

GENDERS = ("男", "女", "其他")
MEMBER_LEVELS = ("普通会员", "铜牌会员", "银牌会员", "金牌会员", "钻石会员")
CONSUMPTION_LEVELS = ("低", "中", "高")


class OrderStatus(NamedTuple):
    source_status: str
    status_code: str
    status_order: int
    is_paid_lifecycle: bool
    is_completed: bool


class Behavior(NamedTuple):
    source_behavior: str
    behavior_code: str
    behavior_group: str
    stage_order: int


ORDER_STATUSES = (
    OrderStatus("待付款", "pending_payment", 1, False, False),
    OrderStatus("已付款", "paid", 2, True, False),
    OrderStatus("已发货", "shipped", 3, True, False),
    OrderStatus("已收货", "received", 4, True, False),
    OrderStatus("已完成", "completed", 5, True, True),
    OrderStatus("已取消", "cancelled", 6, False, False),
    OrderStatus("已退款", "refunded", 7, False, False),
)

BEHAVIORS = (
    Behavior("浏览", "browse", "engagement", 1),
    Behavior("点击", "click", "engagement", 2),
    Behavior("收藏", "favorite", "intent", 3),
    Behavior("加购", "cart", "intent", 4),
)

STATUS_TEXT = {s.status_code: s.source_status for s in ORDER_STATUSES}
BEHAVIOR_TEXT = {b.behavior_code: b.source_behavior for b in BEHAVIORS}

CANCELLED_OR_REFUNDED = ("cancelled", "refunded")
INTENT_BEHAVIORS = ("favorite", "cart")

# Customer segments in serving order; a customer belongs to the first that applies.
SEGMENTS = (
    "repeat_paid_customer",
    "single_paid_customer",
    "order_without_payment",
    "engaged_noncustomer",
    "inactive",
)

# Upper age bounds (exclusive) of every band but the last.  The first label also
# holds the valid ages below 18.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_AGE_BAND = "55+"

SOURCE_STATUS_BY_MODE = {"DEMO": "SYNTHETIC_FIXTURE", "PORTFOLIO": "UNVERIFIED"}

TEMPORAL_REASON = "event_before_registration"
LAST_ORDER_SENTINEL = 999
AMOUNT_TOLERANCE = "0.01"


# --- Id formats ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class IdFormats:
    """Regular expressions of the four business ids."""

    user: str
    product: str
    order: str
    behavior: str


# The published id formats.
STRICT_IDS = IdFormats(
    user="^U[0-9]{6}$", product="^P[0-9]{6}$", order="^O[0-9]{8}$", behavior="^B[0-9]{8}$"
)

# The same prefixes with at least as many digits, for key spaces that outgrow the width.
WIDE_IDS = IdFormats(
    user="^U[0-9]{6,}$", product="^P[0-9]{6,}$", order="^O[0-9]{8,}$", behavior="^B[0-9]{8,}$"
)

# --- Fixed values: published outputs and the sort keys of each serving table ---------------------

SERVING_SORT_KEYS: dict[str, tuple[str, ...]] = {
    "ads_executive_kpis": (),
    "ads_daily_trend": ("order_date",),
    "ads_sequential_funnel": ("stage_order",),
    "ads_category_performance": ("category_rank",),
    "ads_hourly_behavior": ("behavior_hour",),
    "ads_customer_segments": ("segment_order",),
    "ads_order_status": ("status_order",),
    "ads_dataops_health": ("check_name",),
}
