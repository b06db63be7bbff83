"""The warehouse layers over six raw tables.

Every layer is a cached property, so it is planned once per warehouse.  What happens
to a layer that several others read is the store's business: a ``LazyStore`` leaves
it a plan, a ``ParquetStore`` writes it and hands back the written table.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.functions.parsing import MONEY, iso_weekday, literal
from cartwright.operators.relations import decode, literal_table, ranked
from cartwright.operators.validation import (
    ACCEPTED,
    ParentLink,
    judge,
    quarantine,
    valid_rows,
    with_parents,
    without_parents,
)
from cartwright.plans import activity, categories, customers, kpis, verdicts
from cartwright.plans.rulebook import LINEAGE, RULEBOOK, raw_contract
from cartwright.session import give_back
from cartwright.sources.store import LazyStore, scratch_store


class Warehouse:
    """All layers from raw text to serving tables."""

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        ids: c.IdFormats = c.STRICT_IDS,
        store=None,
        run_at: datetime | None = None,
        planned_only: bool = False,
    ) -> None:
        """``planned_only`` is for plans that nobody will run: nothing is written or read to make them."""
        self.spark = spark
        self.ids = ids
        self.store = store or LazyStore()
        self.planned_only = planned_only
        self.run_at = run_at
        self._sources = sources
        self._raw: dict[str, DataFrame] = {}
        self._judged_rows: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = raw_contract(self._sources[name], name)
        return self._raw[name]

    # --- validated staging ---------------------------------------------------------------

    def _judged(self, name: str) -> DataFrame:
        return judge(self.raw(name), RULEBOOK[name](self.ids), LINEAGE)

    def judged(self, name: str) -> DataFrame:
        """Rows with their own reasons only, before a repeated parent can repeat them.

        The recounts read these, so the tables with parents are kept in this state too.
        """
        if name not in self._judged_rows:
            self._judged_rows[name] = self.store.keep(f"jdg_{name}", self._judged(name), counts=verdicts.judged_counts(name))
        return self._judged_rows[name]

    def _stage(self, name: str, rows: DataFrame, counts: dict[str, str] | None = None) -> DataFrame:
        counts = verdicts.staged_counts(name) | (counts or {})
        return self.store.keep(f"stg_{name}", rows, partition_by=ACCEPTED, counts=counts)

    @cached_property
    def staged_users(self) -> DataFrame:
        # Without parents no row is repeated: the staged rows are the raw ones.
        return self._stage("users", without_parents(self._judged("users")), verdicts.judged_counts("users"))

    @cached_property
    def staged_products(self) -> DataFrame:
        return self._stage("products", without_parents(self._judged("products")), verdicts.judged_counts("products"))

    def _user_link(self, child_time: str | None = None) -> ParentLink:
        if child_time is None:
            return ParentLink(self.staged_users, "user_id", "broken_user_fk")
        return ParentLink(
            self.staged_users, "user_id", "broken_user_fk",
            parent_time="registration_ts", child_time=child_time, time_code=c.TEMPORAL_REASON,
        )

    def _product_link(self) -> ParentLink:
        return ParentLink(self.staged_products, "product_id", "broken_product_fk")

    @cached_property
    def staged_orders(self) -> DataFrame:
        links = [self._user_link("order_ts"), self._product_link()]
        return self._stage("orders", with_parents(self.judged("orders"), links))

    @cached_property
    def staged_user_behaviors(self) -> DataFrame:
        links = [self._user_link("behavior_ts"), self._product_link()]
        return self._stage("user_behaviors", with_parents(self.judged("user_behaviors"), links))

    @cached_property
    def staged_user_features(self) -> DataFrame:
        return self._stage("user_features", with_parents(self.judged("user_features"), [self._user_link()]))

    @cached_property
    def staged_product_features(self) -> DataFrame:
        return self._stage(
            "product_features", with_parents(self.judged("product_features"), [self._product_link()])
        )

    def staged(self, name: str) -> DataFrame:
        return getattr(self, f"staged_{name}")

    def valid(self, name: str) -> DataFrame:
        return valid_rows(self.staged(name))

    @property
    def keyed_staged(self) -> dict[str, tuple[DataFrame, str]]:
        return {name: (self.staged(name), RULEBOOK[name](self.ids).key) for name in RULEBOOK}

    @cached_property
    def quarantine(self) -> DataFrame:
        rows = quarantine(self.keyed_staged, LINEAGE)
        return rows.withColumn("quarantined_at", F.lit(self.run_at).cast("timestamp"))

    # --- conformed dimensions and facts ----------------------------------------------------

    @cached_property
    def dim_order_status(self) -> DataFrame:
        return literal_table(self.spark, c.OrderStatus._fields, c.ORDER_STATUSES)

    @cached_property
    def dim_behavior(self) -> DataFrame:
        return literal_table(self.spark, c.Behavior._fields, c.BEHAVIORS)

    @cached_property
    def dim_user(self) -> DataFrame:
        bands = " ".join(f"WHEN age < {below} THEN {literal(label)}" for below, label in c.AGE_BANDS)
        return self.valid("users").selectExpr(
            "user_id", "age", f"CASE {bands} ELSE {literal(c.OLDEST_AGE_BAND)} END AS age_band",
            "gender", "province", "city", "to_date(registration_ts) AS registration_date",
            "member_level", "account_balance", "credit_score",
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.valid("products").drop(*LINEAGE)

    @cached_property
    def fact_order(self) -> DataFrame:
        rows = decode(self.valid("orders"), self.dim_order_status, "order_status", "source_status").selectExpr(
            "order_id", "user_id", "product_id", "quantity", "order_ts", "to_date(order_ts) AS order_date",
            "order_status AS source_order_status", "status_code", "status_order", "is_paid_lifecycle", "is_completed",
            "payment_method", "unit_price", "total_amount", "discount", "actual_payment",
            f"CASE WHEN is_paid_lifecycle THEN actual_payment ELSE CAST(0 AS {MONEY}) END AS paid_gmv",
            "delivery_ts", "receive_ts", "review_score", *LINEAGE,
        )
        return self.store.keep("dwd_fact_order", rows, counts=verdicts.fact_counts("orders", "order_date"))

    @cached_property
    def fact_behavior(self) -> DataFrame:
        rows = decode(self.valid("user_behaviors"), self.dim_behavior, "behavior_type", "source_behavior").selectExpr(
            "behavior_id", "user_id", "product_id", "behavior_type AS source_behavior_type", "behavior_code",
            "behavior_group", "stage_order", "behavior_ts", "to_date(behavior_ts) AS behavior_date",
            "hour(behavior_ts) AS behavior_hour", "duration_seconds", *LINEAGE,
        )
        return self.store.keep("dwd_fact_behavior", rows, counts=verdicts.fact_counts("user_behaviors", "behavior_date"))

    @cached_property
    def snapshot_user(self) -> DataFrame:
        return self.valid("user_features").drop(*LINEAGE)

    @cached_property
    def snapshot_product(self) -> DataFrame:
        return self.valid("product_features").drop(*LINEAGE)

    @cached_property
    def dim_date(self) -> DataFrame:
        ordered = self.fact_order.selectExpr("order_date AS calendar_date")
        seen = ordered.union(self.fact_behavior.select("behavior_date")).distinct()
        return seen.selectExpr(
            "calendar_date",
            "year(calendar_date) AS calendar_year",
            "quarter(calendar_date) AS calendar_quarter",
            "month(calendar_date) AS calendar_month",
            "day(calendar_date) AS day_of_month",
            "weekofyear(calendar_date) AS week_of_year",
            f"{iso_weekday('calendar_date')} AS day_of_week",
            f"{iso_weekday('calendar_date')} >= 6 AS is_weekend",
        )

    # --- summaries and serving tables ------------------------------------------------------

    @cached_property
    def daily_commerce(self) -> DataFrame:
        return self.store.keep("dws_daily_commerce", activity.daily_commerce(self.fact_order))

    @cached_property
    def order_status_summary(self) -> DataFrame:
        return self.store.keep("dws_order_status_summary", activity.order_status_summary(self.fact_order))

    @cached_property
    def hourly_behavior(self) -> DataFrame:
        return self.store.keep("dws_hourly_behavior", activity.hourly_behavior(self.fact_behavior))

    @cached_property
    def customer_summary(self) -> DataFrame:
        rows = customers.customer_summary(self.dim_user, self.fact_order, self.fact_behavior)
        return self.store.keep("dws_customer_summary", rows)

    @cached_property
    def sequential_funnel(self) -> DataFrame:
        rows = customers.sequential_funnel(self.fact_behavior, self.fact_order)
        return self.store.keep("dws_sequential_funnel", rows)

    @cached_property
    def customer_segments(self) -> DataFrame:
        return self.store.keep("dws_customer_segments", customers.customer_segments(self.customer_summary))

    @cached_property
    def category_ranking(self) -> DataFrame:
        activity_rows = categories.category_activity(self.dim_product, self.fact_order, self.fact_behavior)
        if self.planned_only:
            return activity_rows.selectExpr("*", "row_number() OVER (ORDER BY completed_gmv DESC, category) AS category_rank")
        # Ranking reads its input several times, so that is written even where other layers stay plans.
        small = scratch_store(self.spark) if isinstance(self.store, LazyStore) else self.store
        written = small.keep("dws_category_activity", activity_rows)
        return self.store.keep("ads_category_performance", ranked(written, "category_rank", "completed_gmv", "category"))

    @cached_property
    def category_performance(self) -> DataFrame:
        # The ranking carries every performance column, so both come from one pass.
        return self.category_ranking.select(*categories.PERFORMANCE_COLUMNS)

    @cached_property
    def executive_kpis(self) -> DataFrame:
        rows = kpis.executive_kpis(
            self.fact_order, self.fact_behavior, self.dim_user, self.dim_product, self.quarantine
        )
        return self.store.keep("ads_executive_kpis", rows)

    @property
    def serving(self) -> dict[str, DataFrame]:
        """Business outputs by serving name; the health table joins them in a release."""
        return {
            "ads_executive_kpis": self.executive_kpis,
            "ads_daily_trend": self.daily_commerce,
            "ads_sequential_funnel": self.sequential_funnel,
            "ads_category_performance": self.category_ranking,
            "ads_hourly_behavior": self.hourly_behavior,
            "ads_customer_segments": self.customer_segments,
            "ads_order_status": self.order_status_summary,
        }

    #: Layers in the order in which they are made; those of a wave do not depend on each other.
    FACT_WAVES = (
        ("staged_users", "staged_products"),
        ("staged_orders", "staged_user_behaviors", "staged_user_features", "staged_product_features"),
        ("fact_order", "fact_behavior"),
    )
    REPORT_WAVES = (
        ("daily_commerce", "order_status_summary", "hourly_behavior", "customer_summary",
         "sequential_funnel", "category_ranking", "executive_kpis"),
        ("customer_segments",),
    )

    def build(self, waves: tuple[tuple[str, ...], ...] = FACT_WAVES + REPORT_WAVES) -> None:
        """Bring every kept layer into being, one after the other.

        The driver holds plan, generated code and task state of every running job, so its memory grows with their number.
        """
        for wave in waves:
            for name in wave:
                getattr(self, name)
                give_back(self.spark)
