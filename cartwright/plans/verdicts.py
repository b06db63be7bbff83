"""What is counted of a layer while it is written: verdicts, order faults and the event window.

Each entry is an aggregate over the rows of that layer, so the checks need not read the layer again for it.
"""

from __future__ import annotations

from cartwright import contract as c
from cartwright.functions.parsing import all_of, any_of, differs, listed, literal
from cartwright.operators.validation import ACCEPTED, LOCAL_REASONS, REASONS

EQUATION_OFF = differs("total_amount - discount", "actual_payment", c.AMOUNT_TOLERANCE)
UNIT_PRICE_OFF = differs("unit_price * quantity", "total_amount", c.AMOUNT_TOLERANCE)


def status_in(*codes: str) -> str:
    return f"order_status IN ({listed(c.STATUS_TEXT[code] for code in codes)})"


LIFECYCLE_BROKEN = any_of(
    [
        all_of(status_in("shipped", "received", "completed"), "delivery_ts IS NULL"),
        all_of(status_in("received", "completed"), "receive_ts IS NULL"),
        "delivery_ts < order_ts",
        "receive_ts < delivery_ts",
    ]
)


def judged_counts(name: str) -> dict[str, str]:
    """Over the rows with their own reasons: one per raw row."""
    counts = {f"raw_{name}": "count(1)"}
    if name == "orders":
        clean = f"size({LOCAL_REASONS}) = 0"
        for column, fault in (("equation_off", EQUATION_OFF), ("unit_price_off", UNIT_PRICE_OFF)):
            # NULL over no clean rows at all: an unmeasured check must not pass.
            counts[column] = f"sum(CASE WHEN {clean} THEN IF({fault}, 1, 0) END)"
    return counts


def staged_counts(name: str) -> dict[str, str]:
    """Over the rows with all their reasons."""
    temporal = literal(c.TEMPORAL_REASON)
    counts = {
        f"valid_{name}": f"count_if({ACCEPTED})",
        f"rejected_{name}": f"count_if(NOT {ACCEPTED})",
        f"other_{name}": f"count_if(NOT {ACCEPTED} AND {REASONS} <> array({temporal}))",
        f"early_{name}": f"count_if(NOT {ACCEPTED} AND array_contains({REASONS}, {temporal}))",
    }
    if name == "orders":
        counts["lifecycle_broken"] = f"count_if({ACCEPTED} AND {LIFECYCLE_BROKEN})"
    return counts


def fact_counts(name: str, date: str) -> dict[str, str]:
    return {f"dwd_{name}": "count(1)", "first": f"min({date})", "last": f"max({date})"}
