"""Reconciliation checks over all layers, the quality summary and the row profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.functions.parsing import all_of, any_of, differs, exprs, literal, rows_of
from cartwright.operators.relations import duplicate_keys, literal_row, literal_values, mismatches, orphans, side_by_side
from cartwright.operators.validation import ACCEPTED, locally_clean_rows, union_all
from cartwright.plans.activity import CALLED_OFF
from cartwright.plans.verdicts import (
    EQUATION_OFF,
    LIFECYCLE_BROKEN,
    UNIT_PRICE_OFF,
    fact_counts,
    judged_counts,
    staged_counts,
    status_in,
)
from cartwright.plans.warehouse import Warehouse
from cartwright.session import give_back

PASS, FAIL, WARN = "pass", "fail", "warn"
CRITICAL, WARNING = "critical", "warning"


@dataclass(frozen=True)
class Check:
    """``passes`` and ``observed`` are expressions over the measurement row."""

    name: str
    passes: str
    observed: str
    expected: str
    severity: str
    details: str

    def row(self) -> dict[str, str]:
        other = FAIL if self.severity == CRITICAL else WARN
        return {
            "check_name": literal(self.name),
            "check_status": f"CASE WHEN {self.passes} THEN '{PASS}' ELSE '{other}' END",
            "observed_value": f"CAST({self.observed} AS STRING)",
            "expected_value": literal(self.expected),
            "severity": literal(self.severity),
            "details": literal(self.details),
        }


# --- findings at row grain ------------------------------------------------------------------

def lifecycle_violations(valid_orders: DataFrame) -> DataFrame:
    return valid_orders.filter(LIFECYCLE_BROKEN)


def amount_findings(clean_orders: DataFrame) -> DataFrame:
    """Locally clean orders whose amounts do not add up or whose unit price does not explain the total."""
    return clean_orders.selectExpr(
        "order_id", f"{EQUATION_OFF} AS equation_off", f"{UNIT_PRICE_OFF} AS unit_price_off"
    ).filter("equation_off OR unit_price_off")


def duplicates(w: Warehouse) -> DataFrame:
    return duplicate_keys({name: (rows.filter(ACCEPTED), key) for name, (rows, key) in w.keyed_staged.items()})


def orphan_rows(w: Warehouse) -> DataFrame:
    children = [
        (name, w.valid(name), key, parent)
        for name in ("orders", "user_behaviors")
        for key, parent in (("user_id", "users"), ("product_id", "products"))
    ]
    parents = {"users": (w.valid("users"), "user_id"), "products": (w.valid("products"), "product_id")}
    return orphans(children, parents)


def _recount(w: Warehouse, key: str, amount: str, order_count: str, completed: str, cancelled: str) -> list[DataFrame]:
    """Per-entity totals straight from the locally clean source rows."""
    ordered = locally_clean_rows(w.judged("orders")).groupBy(key).agg(
        *exprs(
            f"count(1) AS f_{order_count}",
            f"count_if({status_in('completed')}) AS f_{completed}",
            f"count_if({status_in(*c.CANCELLED_OR_REFUNDED)}) AS f_{cancelled}",
            f"round(sum(actual_payment), 2) AS f_{amount}",
        )
    )
    behaved = locally_clean_rows(w.judged("user_behaviors")).groupBy(key).agg(
        *exprs(
            *[
                f"count_if(behavior_type = {literal(b.source_behavior)}) AS f_{b.behavior_code}_count"
                for b in c.BEHAVIORS
            ]
        )
    )
    return [ordered, behaved]


def _disagrees(amount: str, counts: list[str]) -> str:
    terms = [differs(amount, f"coalesce(f_{amount}, 0)", c.AMOUNT_TOLERANCE)]
    return any_of(terms + [f"{name} <> coalesce(f_{name}, 0)" for name in counts])


_BEHAVIOR_COUNTS = [f"{b.behavior_code}_count" for b in c.BEHAVIORS]


def user_feature_findings(w: Warehouse) -> DataFrame:
    facts = _recount(w, "user_id", "total_spent", "order_count", "completed_orders", "called_off")
    differing = _disagrees("total_spent", ["order_count", "completed_orders", *_BEHAVIOR_COUNTS])
    return mismatches(w.valid("user_features"), "user_id", facts, differing)


def product_feature_findings(w: Warehouse) -> DataFrame:
    facts = _recount(w, "product_id", "total_revenue", "total_sales", "completed_count", "cancel_count")
    differing = _disagrees("total_revenue", ["total_sales", "completed_count", "cancel_count", *_BEHAVIOR_COUNTS])
    return mismatches(w.valid("product_features"), "product_id", facts, differing)


# --- the one-row measurement -------------------------------------------------------------------


def _aggregate(rows: DataFrame, **columns: str) -> DataFrame:
    return rows.agg(*exprs(*[f"{text} AS {name}" for name, text in columns.items()]))


def _count(rows: DataFrame, name: str) -> DataFrame:
    return _aggregate(rows, **{name: "count(1)"})


def _sum_if(condition: str) -> str:
    """Matching rows, NULL over no rows at all: an unmeasured check must not pass."""
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def _counted(w: Warehouse, layer: str, rows: DataFrame, columns: dict[str, str], only: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates of a layer: those taken while it was written, or else taken now."""
    asked = _aggregate(rows, **{name: columns[name] for name in only or columns})
    known = w.store.counted(layer)
    if known is None:
        return asked
    # The types are those of the aggregates, so that both ways give the same row.
    return literal_values(w.spark, asked.schema, known)


def _raw_counts(w: Warehouse, name: str) -> DataFrame:
    layer = f"stg_{name}" if name in ("users", "products") else f"jdg_{name}"
    known = w.store.counted(layer)
    return _counted(w, layer, w.raw(name), {f"raw_{name}": "count(1)"}) if known else _count(w.raw(name), f"raw_{name}")


def _verdict_counts(w: Warehouse, name: str) -> DataFrame:
    return _counted(w, f"stg_{name}", w.staged(name), staged_counts(name))


def _amount_counts(w: Warehouse) -> DataFrame:
    return _counted(w, "jdg_orders", w.judged("orders"), judged_counts("orders"), only=("equation_off", "unit_price_off"))


def _fact_recount(w: Warehouse) -> DataFrame:
    """Headline numbers recomputed from the facts, independently of the KPI plan."""
    per_user = w.fact_order.groupBy("user_id").agg(
        *exprs(
            "count(1) AS n",
            "count_if(is_completed) AS done",
            "sum(CASE WHEN is_completed THEN actual_payment ELSE 0 END) AS done_amount",
            f"count_if({CALLED_OFF}) AS off",
        )
    )
    return _aggregate(
        per_user,
        fact_orders="coalesce(sum(n), 0)",
        fact_customers="count(user_id)",
        fact_completed="sum(done)",
        fact_completed_customers="count_if(done > 0)",
        fact_completed_gmv="round(sum(done_amount), 2)",
        fact_called_off="sum(off)",
        fact_repeat="count_if(done >= 2)",
    )


def _row_counts(w: Warehouse) -> list[DataFrame]:
    """Rows of every table in text, validated and in the fact layer, and the event window."""
    facts = {
        "orders": ("dwd_fact_order", w.fact_order, "order_date"),
        "user_behaviors": ("dwd_fact_behavior", w.fact_behavior, "behavior_date"),
    }
    views = {"users": w.dim_user, "products": w.dim_product, "user_features": w.snapshot_user, "product_features": w.snapshot_product}
    counted = {name: _counted(w, layer, rows, fact_counts(name, date)) for name, (layer, rows, date) in facts.items()}
    return [
        *[_raw_counts(w, name) for name in c.HEADERS],
        *[_verdict_counts(w, name) for name in c.HEADERS],
        *[counted[name].select(f"dwd_{name}") if name in counted else _count(views[name], f"dwd_{name}") for name in c.HEADERS],
        _aggregate(
            union_all([rows.select("first", "last") for rows in counted.values()]), min_event_date="min(first)", max_event_date="max(last)"
        ),
    ]


def row_counts(w: Warehouse) -> DataFrame:
    return side_by_side(_row_counts(w))


def _parts(w: Warehouse) -> list[list[DataFrame]]:
    """One-row relations in groups that one job measures: what has few rows shares a job, a pass over a large layer is one of its own."""
    kpi_names = (
        "total_orders", "ordering_customers", "completed_orders", "completed_customers", "completed_gmv",
        "cancelled_or_refunded_orders", "repeat_completed_customers", "behavior_events",
        "registered_users", "products", "quarantined_rows",
    )
    rising = w.sequential_funnel.selectExpr("user_count > lag(user_count) OVER (ORDER BY stage_order) AS rises")
    return [
        [*_row_counts(w), _amount_counts(w)],
        [_aggregate(duplicates(w), duplicate_rows="coalesce(sum(duplicate_rows), 0)")],
        [_aggregate(orphan_rows(w), orphan_rows="coalesce(sum(orphan_rows), 0)")],
        [_fact_recount(w)],
        [
            _aggregate(
                user_feature_findings(w),
                user_mismatches=_sum_if("mismatch"),
                sentinels=_sum_if(f"days_since_last_order = {c.LAST_ORDER_SENTINEL}"),
            )
        ],
        [_aggregate(product_feature_findings(w), product_mismatches=_sum_if("mismatch"))],
        [
            w.executive_kpis.selectExpr(*[f"{name} AS kpi_{name}" for name in kpi_names]),
            _aggregate(
                w.daily_commerce, daily_orders="sum(total_orders)", daily_completed_gmv="round(sum(completed_gmv), 2)"
            ),
            _aggregate(rising, stages="count(1)", stage_rises=_sum_if("rises")),
            _aggregate(w.customer_segments, segment_users="sum(user_count)", segment_share="sum(user_share)"),
            _aggregate(
                union_all([_count(rows, "n") for rows in w.serving.values()]), filled_outputs=_sum_if("n > 0")
            ),
        ],
    ]


def measurement(w: Warehouse) -> DataFrame:
    """Every number the checks and the profile need, as one row."""
    return side_by_side([frame for part in _parts(w) for frame in part])


def measured(w: Warehouse) -> DataFrame:
    """The row of ``measurement``, taken part by part: all its subqueries at once would be as many running plans on the driver."""
    rows = []
    for part in _parts(w):
        rows.append(literal_row(side_by_side(part)))
        give_back(w.spark)
    return side_by_side(rows)


def _joined(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def checks() -> list[Check]:
    """The twenty checks over the measurement row.

    Names, severities, expected values and the form of the observed value are fixed.
    """
    names = list(c.HEADERS)

    def over_tables(prefix: str) -> str:
        return "(" + " + ".join(f"{prefix}_{name}" for name in names) + ")"

    def near(left: str, right: str) -> str:
        return f"NOT {differs(left, right, c.AMOUNT_TOLERANCE)}"

    def zero(name: str, measured: str, severity: str, details: str, expected: str = "0") -> Check:
        return Check(name, f"{measured} = 0", measured, expected, severity, details)

    rejected = over_tables("rejected")
    return [
        Check(
            "all_source_tables_non_empty",
            f"least({', '.join(f'raw_{n}' for n in names)}) > 0",
            f"concat_ws(',', {', '.join(f'raw_{n}' for n in names)})",
            "all six tables > 0", CRITICAL, "No input table may be empty.",
        ),
        Check(
            "raw_ods_row_reconciliation",
            all_of(*[f"raw_{n} = valid_{n} + rejected_{n}" for n in names]),
            _joined("'quarantine='", rejected),
            "raw=valid+quarantine for all tables", CRITICAL, "A source row ends up valid or quarantined, once.",
        ),
        zero("non_temporal_quarantine_empty", over_tables("other"), CRITICAL,
             "Rows rejected for anything but an event before registration block the release."),
        zero("primary_keys_unique", "duplicate_rows", CRITICAL, "Each table's key identifies one row."),
        zero("foreign_keys_complete", "orphan_rows", CRITICAL, "Valid orders and behaviors have valid parents."),
        Check(
            "ods_dwd_order_reconciliation", "valid_orders = fact_orders",
            _joined("valid_orders", "'='", "fact_orders"),
            "ods_orders=dwd_orders", CRITICAL, "The order fact holds every valid order.",
        ),
        Check(
            "ods_dwd_behavior_reconciliation", "valid_user_behaviors = dwd_user_behaviors",
            _joined("valid_user_behaviors", "'='", "dwd_user_behaviors"),
            "ods_behaviors=dwd_behaviors", CRITICAL, "The behavior fact holds every valid behavior.",
        ),
        zero("amount_equation_valid", "equation_off", CRITICAL, "Total minus discount is what was paid."),
        zero("order_lifecycle_dates_valid", "lifecycle_broken", CRITICAL,
             "Delivery and receipt times fit the order's state and order."),
        zero("user_feature_snapshot_reconciles", "user_mismatches", CRITICAL,
             "User features equal a recount of the source rows."),
        zero("product_feature_snapshot_reconciles", "product_mismatches", CRITICAL,
             "Product features equal a recount of the source rows."),
        Check(
            "executive_kpis_reconcile",
            all_of(
                "kpi_total_orders = fact_orders",
                "kpi_ordering_customers = fact_customers",
                "kpi_completed_orders = fact_completed",
                "kpi_completed_customers = fact_completed_customers",
                near("kpi_completed_gmv", "fact_completed_gmv"),
                "kpi_cancelled_or_refunded_orders = fact_called_off",
                "kpi_repeat_completed_customers = fact_repeat",
                "kpi_behavior_events = dwd_user_behaviors",
                "kpi_registered_users = dwd_users",
                "kpi_products = dwd_products",
                f"kpi_quarantined_rows = {rejected}",
            ),
            _joined("'orders='", "kpi_total_orders", "',behaviors='", "kpi_behavior_events", "',quarantine='",
                    "kpi_quarantined_rows"),
            "ADS equals independent DWD recomputation", CRITICAL, "Headline numbers equal a recount of the facts.",
        ),
        Check(
            "daily_orders_reconcile",
            all_of("daily_orders = fact_orders", near("daily_completed_gmv", "fact_completed_gmv")),
            _joined("'orders='", "daily_orders", "',completed='", "daily_completed_gmv"),
            "daily totals = DWD totals", CRITICAL, "The days add up to the order fact.",
        ),
        Check(
            "sequential_funnel_monotonic",
            "stages = 4 AND stage_rises = 0",
            _joined("'stages='", "stages", "',violations='", "stage_rises"),
            "stages=4,violations=0", CRITICAL, "A funnel stage is never larger than the one before.",
        ),
        Check(
            "customer_segments_reconcile",
            "segment_users = dwd_users AND abs(segment_share - 1.0D) <= 0.001D",
            _joined("'users='", "segment_users", "',share='", "round(segment_share, 4)"),
            "segments cover all users exactly once", CRITICAL, "Every user is in one segment.",
        ),
        Check("ads_outputs_non_empty", "filled_outputs = 7", "filled_outputs", "7", CRITICAL,
              "Every published aggregate has rows."),
        zero("quarantined_source_rows_reported", rejected, WARNING,
             "Quarantined rows are set apart and take no part in the aggregates.", "reported and excluded"),
        zero("pre_registration_events_reported", over_tables("early"), WARNING,
             "Orders and behaviors dated before the user's registration are quarantined.", "reported and excluded"),
        zero("unit_price_total_difference_reported", "unit_price_off", WARNING,
             "The total is authoritative; unit price times quantity is only compared.", "reported only"),
        zero("feature_last_order_sentinel_reported", "sentinels", WARNING,
             "Sentinel ages of the last order are counted and otherwise unused.", "reported only"),
    ]


def quality_checks(measured: DataFrame) -> DataFrame:
    return measured.selectExpr(rows_of(check.row() for check in checks()))


# --- gate, summary, profile ---------------------------------------------------------------------

BLOCKING = f"lower(severity) = '{CRITICAL}' AND lower(check_status) <> '{PASS}'"


def blocking(health: DataFrame) -> DataFrame:
    """Critical checks that did not pass, a warning on a critical check included."""
    return health.filter(BLOCKING)


def quality_summary(health: DataFrame) -> DataFrame:
    return _aggregate(
        health,
        total_checks="count(1)",
        passed_checks=f"count_if(lower(check_status) = '{PASS}')",
        failed_checks=f"count_if(lower(check_status) = '{FAIL}')",
        warning_checks=f"count_if(lower(check_status) = '{WARN}')",
        blocking_checks=f"array_join(array_sort(collect_list(CASE WHEN {BLOCKING} THEN check_name END)), ',')",
        status=f"CASE WHEN count_if({BLOCKING}) > 0 THEN '{FAIL}' ELSE '{PASS}' END",
    )


def row_profile(measured: DataFrame) -> DataFrame:
    """Rows per table at each layer, quarantined rows and the window of event dates."""

    def over_tables(layer: str) -> str:
        return " + ".join(f"{layer}_{name}" for name in c.HEADERS)

    return measured.selectExpr(
        f"{over_tables('raw')} AS raw_rows",
        f"{over_tables('valid')} AS valid_rows",
        f"{over_tables('rejected')} AS quarantine_rows",
        f"{over_tables('dwd')} AS dwd_rows",
        *[f"{layer}_{name}" for layer in ("raw", "valid", "dwd") for name in c.HEADERS],
        "min_event_date", "max_event_date",
    )


def evidence_reconciliation(
    kpi_row: DataFrame, profile: DataFrame, summary: DataFrame, data_mode: str, source_status: str
) -> DataFrame:
    """Does a release's evidence agree with itself?  One row per statement."""
    row = side_by_side(
        [
            kpi_row.select("total_orders", "completed_orders", "completed_customers", "completion_rate",
                           "behavior_events"),
            profile.select("raw_rows", "valid_rows", "quarantine_rows", "dwd_rows", "valid_orders",
                           "valid_user_behaviors"),
            summary.select("total_checks", "passed_checks", "failed_checks", "warning_checks", "status"),
        ]
    )
    disclosed = c.SOURCE_STATUS_BY_MODE.get(data_mode.upper()) == source_status.upper()
    statements = {
        "check_counts_add_up": "passed_checks + failed_checks + warning_checks = total_checks",
        "quality_gate_passed": f"status = '{PASS}' AND failed_checks = 0",
        "raw_equals_valid_plus_quarantine": "raw_rows = valid_rows + quarantine_rows",
        "valid_equals_facts": "valid_rows = dwd_rows",
        "completed_within_total": "completed_orders <= total_orders",
        "customers_within_completed": "completed_customers <= completed_orders",
        "completion_rate_agrees":
            "total_orders = 0 OR abs(completion_rate - CAST(completed_orders AS DOUBLE) / nullif(total_orders, 0)) <= 0.0001D",
        "orders_equal_profile": "total_orders = valid_orders",
        "behaviors_equal_profile": "behavior_events = valid_user_behaviors",
        "mode_discloses_source": literal(disclosed),
    }
    return row.selectExpr(
        rows_of({"statement": literal(name), "holds": f"coalesce({holds}, false)"} for name, holds in statements.items())
    )
