"""All layers under their published table names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.operators.validation import union_all
from cartwright.plans.warehouse import Warehouse
from cartwright.sources.store import LazyStore

# Published table names.  The text is the grain of each table.
GRAINS = {
    "ods_users_valid": "one valid source user",
    "ods_products_valid": "one valid source product",
    "ods_orders_valid": "one valid source order",
    "ods_user_behaviors_valid": "one valid source behavior",
    "ods_user_features_valid": "one valid user feature row",
    "ods_product_features_valid": "one valid product feature row",
    "ods_quarantine": "one rejected source row with all its reasons",
    "dwd_dim_user": "one registered user",
    "dwd_dim_product": "one product",
    "dwd_dim_order_status": "one order status",
    "dwd_dim_behavior": "one behavior type",
    "dwd_fact_order": "one valid order",
    "dwd_fact_behavior": "one valid behavior",
    "dwd_feature_snapshot_user": "one user feature row, for audit",
    "dwd_feature_snapshot_product": "one product feature row, for audit",
    "dwd_dim_date": "one date seen in a fact",
    "dws_daily_commerce": "one order date",
    "dws_order_status_summary": "one order status",
    "dws_hourly_behavior": "one hour of the day",
    "dws_customer_summary": "one registered user",
    "dws_sequential_funnel": "one funnel stage",
    "dws_customer_segments": "one customer segment",
    "dws_category_performance": "one product category",
    "ads_executive_kpis": "one snapshot of the observation window",
    "ads_daily_trend": "one order date",
    "ads_sequential_funnel": "one funnel stage",
    "ads_category_performance": "one ranked product category",
    "ads_hourly_behavior": "one hour of the day",
    "ads_customer_segments": "one customer segment",
    "ads_order_status": "one order status",
    "ops_data_quality_results": "one quality check",
    "ads_dataops_health": "one quality check",
}


def layers(w: Warehouse, health: DataFrame) -> dict[str, DataFrame]:
    tables = {f"ods_{name}_valid": w.valid(name) for name in c.HEADERS}
    tables["ods_quarantine"] = w.quarantine.drop("reasons")
    tables |= {
        "dwd_dim_user": w.dim_user,
        "dwd_dim_product": w.dim_product,
        "dwd_dim_order_status": w.dim_order_status,
        "dwd_dim_behavior": w.dim_behavior,
        "dwd_fact_order": w.fact_order,
        "dwd_fact_behavior": w.fact_behavior,
        "dwd_feature_snapshot_user": w.snapshot_user,
        "dwd_feature_snapshot_product": w.snapshot_product,
        "dwd_dim_date": w.dim_date,
        "dws_daily_commerce": w.daily_commerce,
        "dws_order_status_summary": w.order_status_summary,
        "dws_hourly_behavior": w.hourly_behavior,
        "dws_customer_summary": w.customer_summary,
        "dws_sequential_funnel": w.sequential_funnel,
        "dws_customer_segments": w.customer_segments,
        "dws_category_performance": w.category_performance,
        "ops_data_quality_results": health,
        **w.serving,
        "ads_dataops_health": health,
    }
    return {name: tables[name] for name in GRAINS}


def create_views(w: Warehouse, health: DataFrame) -> list[str]:
    """Temporary views over every layer."""
    tables = layers(w, health)
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    return list(tables)


def described_tables(spark: SparkSession, database: str) -> DataFrame:
    """``table_name, grain, table_rows`` of every layer saved in a database: the comment as the catalog has it, the rows counted."""
    counts = []
    for name in GRAINS:
        grain = spark.catalog.getTable(f"{database}.{name}").description
        counts.append(spark.table(f"{database}.{name}").agg(F.lit(name).alias("table_name"), F.lit(grain).alias("grain"), F.count(F.lit(1)).alias("table_rows")))
    return union_all(counts)


def save_tables(w: Warehouse, health: DataFrame, database: str) -> list[str]:
    """Overwrite every layer as a Parquet table of the catalog, with its grain as comment.

    Over plans that nobody has written every table would compute all layers below it again, so a written warehouse is asked for.
    """
    if isinstance(w.store, LazyStore):
        raise ValueError("save_tables needs a warehouse over a ParquetStore")
    saved = []
    for name, rows in layers(w, health).items():
        table = f"{database}.{name}"
        rows.write.mode("overwrite").format("parquet").saveAsTable(table)
        w.spark.sql(f"COMMENT ON TABLE {table} IS 'Grain: {GRAINS[name]}.'")
        saved.append(table)
    return saved
