
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import contract as c
from cartwright.functions.parsing import (
    MONEY,
    WHOLE_DECIMAL,
    blank,
    blank_to_null,
    exprs,
    has_fraction,
    parsed,
    parsed_if_present,
    whole_number,
)
from cartwright.operators.relations import literal_row
from cartwright.operators.validation import judge, reason_frequency, reason_text, union_all
from cartwright.plans import arrivals, consumption, customers, incremental, quality, release
from cartwright.plans.rulebook import RULEBOOK, raw_contract
from cartwright.plans.warehouse import Warehouse
from cartwright.session import give_back, prepare
from cartwright.sources import catalog, csv_files
from cartwright.sources.star_schema import StarSources, files_state
from cartwright.sources.store import scratch_store, shared_folder
from cartwright.streaming.quarantine import stream_tables

FLAGSHIP_FOLDER = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]
RUN_AT = datetime(2024, 2, 1)


def entry(spark: SparkSession) -> DataFrame:
    return order_status_summary(prepare(spark), FLAGSHIP_FOLDER)


# --- plumbing ---------------------------------------------------------------------------------


def _warehouse(spark: SparkSession, tables: str | StarSources, store=None) -> Warehouse:
    sources = StarSources(spark, tables) if isinstance(tables, str) else tables
    return Warehouse(spark, sources, c.WIDE_IDS, store)


_PLAIN_TYPES = {
    T.DecimalType: "DOUBLE", T.IntegerType: "BIGINT", T.ShortType: "BIGINT", T.ByteType: "BIGINT",
    T.TimestampType: "TIMESTAMP_NTZ",
}


def _edge(rows: DataFrame) -> DataFrame:
    """Plain output types: BIGINT, DOUBLE and wall-clock TIMESTAMP."""
    columns = []
    for field in rows.schema:
        target = _PLAIN_TYPES.get(type(field.dataType))
        columns.append(f"CAST({field.name} AS {target}) AS {field.name}" if target else field.name)
    return rows.selectExpr(*columns)


def _judged(name: str) -> Query:
    """A table's own rules over text that was damaged so that every code fires."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        raw = raw_contract(StarSources(spark, folder, spoiled=True)[name], name)
        rows = judge(raw, RULEBOOK[name](c.WIDE_IDS))
        return _edge(rows.selectExpr("*", f"{reason_text('local_reasons')} AS rejection_reasons").drop("local_reasons"))

    return query


def _validated(name: str) -> Query:
    """Own and parent reasons of every row."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = _warehouse(spark, folder)
        return w.staged(name).selectExpr(
            RULEBOOK[name](c.WIDE_IDS).key,
            f"{reason_text('local_reasons')} AS rejection_reasons",
            f"{reason_text()} AS final_rejection_reasons",
        )

    return query


def _layer(pick: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: _edge(pick(_warehouse(spark, folder)))


def _facts_only(rows: DataFrame) -> DataFrame:
    return rows.drop("source_file", "ingested_at")


def order_status_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _edge(_warehouse(spark, folder).order_status_summary)


# --- parsing ----------------------------------------------------------------------------------


def optional_field_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = StarSources(spark, folder, spoiled=True)["orders"]

    def field(source: str, dtype: str, value: str) -> list[str]:
        read = parsed_if_present(source, dtype)
        return [f"{read} AS {value}", f"NOT {blank(source)} AND ({read}) IS NULL AS bad_{source}"]

    return _edge(
        raw.selectExpr(
            "trim(order_id) AS order_id", *field("review_score", "INT", "review_score"),
            *field("delivery_date", "TIMESTAMP", "delivery_ts"), f"{blank_to_null('review_content')} AS review_content",
        )
    )


def integral_decimal_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = StarSources(spark, folder, spoiled=True)["user_features"]
    exact = parsed("order_count", WHOLE_DECIMAL)
    return _edge(
        raw.selectExpr(
            "user_id", f"{whole_number(exact)} AS order_count", f"{has_fraction(exact)} AS has_fraction",
            f"{parsed('total_spent', MONEY)} AS total_spent",
        )
    )


# --- quarantine ---------------------------------------------------------------------------------


def valid_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    w = _warehouse(spark, folder)
    return union_all(
        [
            w.staged(name).agg(
                *exprs(
                    f"'{name}' AS source_table", "count_if(accepted) AS valid_rows",
                    "count_if(NOT accepted) AS quarantined_rows",
                )
            )
            for name in c.HEADERS
        ]
    )


def quarantine_rows(spark: SparkSession, folder: str) -> DataFrame:
    raw = StarSources(spark, folder)
    sources = {name: csv_files.with_lineage(raw[name], csv_files.file_name(name), RUN_AT) for name in c.HEADERS}
    rows = Warehouse(spark, sources, c.WIDE_IDS, run_at=RUN_AT).quarantine
    return _edge(rows.select("source_table", "record_key", "rejection_reasons", "source_file", "ingested_at", "quarantined_at"))


def rejection_reason_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return reason_frequency(_warehouse(spark, folder).quarantine)


# --- checks, gate and evidence -------------------------------------------------------------------


_CANDIDATES: dict[tuple, release.Candidate] = {}


def _candidate(spark: SparkSession, folder: str, repeated: bool = False) -> release.Candidate:
    """The checks read every layer several times, so the layers are written once.

    What the callers read afterwards is a few rows; the large layers go again.  The queries over checks share one candidate as
    long as the session lives and the tables' files stay as they are.
    """
    key = (spark.sparkContext.applicationId, folder, repeated, files_state(spark, folder))
    if key not in _CANDIDATES:
        _CANDIDATES[key] = _built(spark, folder, repeated)
    return _CANDIDATES[key]


def _built(spark: SparkSession, folder: str, repeated: bool) -> release.Candidate:
    store = scratch_store(spark)
    sources = StarSources(spark, folder, repeated=repeated, store=store)
    candidate = release.build_candidate(spark, sources, RUN_AT, c.WIDE_IDS, store)
    store.discard(keep=("ops_data_quality_results", "ops_measurement", "ads_executive_kpis"))
    return candidate


def _kept(name: str, pick: Callable[[Warehouse], DataFrame]) -> Query:
    """A row made of all layers: each is written once, and all but the row go again."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        store = scratch_store(spark)
        w = _warehouse(spark, StarSources(spark, folder, store=store), store)
        w.build(w.FACT_WAVES)
        row = store.keep(name, pick(w))
        store.discard(keep=(name,))
        return _edge(row)

    return query


def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    return _candidate(spark, folder).health.drop("details", "checked_at").orderBy("check_name")


def quality_checks_repeated_parents(spark: SparkSession, folder: str) -> DataFrame:
    """The checks where some users and products come twice: keys and row counts must fail, recounts must not."""
    return _candidate(spark, folder, repeated=True).health.drop("details", "checked_at").orderBy("check_name")


def layers_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every layer, read under its published name."""
    store = scratch_store(spark)
    candidate = release.build_candidate(spark, StarSources(spark, folder, store=store), RUN_AT, c.WIDE_IDS, store)
    names = catalog.create_views(candidate.warehouse, candidate.health)
    counts = [spark.table(name).agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("layer_rows")) for name in names]
    rows = store.keep("layer_counts", union_all(counts))
    for name in names:
        spark.catalog.dropTempView(name)
    store.discard(keep=("layer_counts",))
    return rows


def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_summary(_candidate(spark, folder).health)


def check_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return consumption.check_status_counts(_candidate(spark, folder).health)


def kpi_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """The checks that compare published aggregates with a recount."""
    names = ("executive_kpis_reconcile", "daily_orders_reconcile", "customer_segments_reconcile")
    health = _candidate(spark, folder).health
    return health.filter(F.col("check_name").isin(*names)).select("check_name", "check_status", "observed_value")


def evidence_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    candidate = _candidate(spark, folder)
    return quality.evidence_reconciliation(
        candidate.warehouse.executive_kpis,
        quality.row_profile(candidate.measured),
        quality.quality_summary(candidate.health),
        "PORTFOLIO",
        c.SOURCE_STATUS_BY_MODE["PORTFOLIO"],
    )


def lifecycle_violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.lifecycle_violations(_warehouse(spark, folder).valid("orders"))
    return _edge(rows.select("order_id", "order_status", "order_ts", "delivery_ts", "receive_ts"))


def amount_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    staged = judge(
        raw_contract(StarSources(spark, folder, spoiled=True)["orders"], "orders"), RULEBOOK["orders"](c.WIDE_IDS)
    )
    return quality.amount_findings(staged.filter("size(local_reasons) = 0"))


def user_feature_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.user_feature_findings(_warehouse(spark, folder))
    sentinel = f"days_since_last_order = {c.LAST_ORDER_SENTINEL} AS last_order_sentinel"
    return rows.selectExpr("user_id", "mismatch", sentinel)


def product_feature_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return quality.product_feature_findings(_warehouse(spark, folder)).select("product_id", "mismatch")


def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and behaviors, before validation, whose user or product key is unknown."""
    raw = StarSources(spark, folder, spoiled=True)
    children = [
        (name, raw[name], key, parent)
        for name in ("orders", "user_behaviors")
        for key, parent in (("user_id", "users"), ("product_id", "products"))
    ]
    parents = {"users": (raw["users"], "user_id"), "products": (raw["products"], "product_id")}
    return quality.orphans(children, parents)


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of damaged keys in every table's text."""
    raw = StarSources(spark, folder, spoiled=True)
    return quality.duplicate_keys({name: (raw[name], c.HEADERS[name][0]) for name in c.HEADERS})


# --- files ----------------------------------------------------------------------------------------


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write a table as CSV and read it back as text under the contract."""
    target, headers = f"{_scratch_folder(spark)}/users.csv", c.HEADERS["users"]
    users = StarSources(spark, folder)["users"].select(*headers)
    users.write.option("header", True).option("escape", '"').csv(target)
    return csv_files.scan_csv(spark, target, headers).drop("_corrupt_record")


def _write_event_lines(spark: SparkSession, folder: str, target: str) -> None:
    """The behavior table as ready-made CSV lines; every eleventh line lacks its last field."""
    headers = c.HEADERS["user_behaviors"]
    rows = StarSources(spark, folder)["user_behaviors"]
    whole, short = F.concat_ws(",", *headers), F.concat_ws(",", *headers[:-1])
    lines = rows.select(F.when(F.col("_k") % 11 == 0, short).otherwise(whole).alias(",".join(headers)))
    # A separator that does not occur keeps each line, and the header line, as it is.
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x00").csv(target)


def csv_corrupt_capture(spark: SparkSession, folder: str) -> DataFrame:
    target = f"{_scratch_folder(spark)}/user_behaviors.csv"
    _write_event_lines(spark, folder, target)
    rows = csv_files.scan_csv(spark, target, c.HEADERS["user_behaviors"])
    return rows.select("behavior_id", "behavior_type", "duration_seconds", F.col("_corrupt_record").alias("corrupt_record"))


def csv_contract_check(spark: SparkSession, folder: str) -> DataFrame:
    """Header, width and size of written tables: one sound, one with short rows, one misnamed."""
    root, sources = _scratch_folder(spark), StarSources(spark, folder)
    for name in ("users", "products"):
        sources[name].select(*c.HEADERS[name]).write.option("header", True).option("escape", '"').csv(f"{root}/{name}.csv")
    _write_event_lines(spark, folder, f"{root}/user_behaviors.csv")
    reports = [
        csv_files.inspect_table(spark, f"{root}/products.csv", "products"),
        csv_files.inspect_table(spark, f"{root}/user_behaviors.csv", "user_behaviors"),
        # The users file under the headers of another table.
        csv_files.inspect_table(spark, f"{root}/users.csv", "product_features"),
    ]
    return union_all(reports).select("table_name", "header_ok", "data_rows", "wrong_width_rows")


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table before and after it is written as Parquet."""
    store, sources = scratch_store(spark), StarSources(spark, folder)
    counts = []
    for name, headers in c.HEADERS.items():
        rows = sources[name].select(*[f"`{h}`" for h in headers])
        for side, frame in (("source", rows), ("written", store.keep(name, rows))):
            counts.append(frame.agg(*exprs(f"'{name}' AS table_name", f"'{side}' AS side", "count(1) AS n")))
    return union_all(counts).groupBy("table_name").agg(
        *exprs("max(IF(side = 'source', n, NULL)) AS source_rows", "max(IF(side = 'written', n, NULL)) AS written_rows")
    )


def table_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return csv_files.fingerprints(StarSources(spark, folder))


def combined_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return csv_files.combined_fingerprint(csv_files.fingerprints(StarSources(spark, folder)))


def typed_release_read(spark: SparkSession, folder: str) -> DataFrame:
    """Publish the daily trend as CSV and read it back typed."""
    target, daily = f"{_scratch_folder(spark)}/ads_daily_trend.csv", _warehouse(spark, folder).daily_commerce
    csv_files.write_aggregate(daily, target, ("order_date",))
    rows = csv_files.read_aggregate(spark, target, daily.schema)
    return _edge(rows.select("order_date", "total_orders", "paid_gmv", "completed_gmv", "paid_aov", "completed_customers"))


def exported_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Export all customers in ordered parts, some eight at least, and read them back typed.

    ``in_order`` says whether all keys of a row's part lie above those of the part before.
    """
    store, target = scratch_store(spark), f"{_scratch_folder(spark)}/dws_customer_summary.csv"
    rows = store.keep("exported", _warehouse(spark, folder).customer_summary)
    count = rows.count()
    part_rows = max(1, min(csv_files.PART_ROWS, count // 8))
    csv_files.write_aggregate(rows, target, ("user_id",), count, part_rows)
    back = csv_files.read_aggregate(spark, target, rows.schema, part="part")
    # A row per part.
    parts = back.groupBy("part").agg(F.min("user_id").alias("low"), F.max("user_id").alias("high"))
    before = F.lag("high").over(W.orderBy("part"))
    judged = parts.select("part", F.coalesce(F.col("low") > before, F.lit(True)).alias("in_order"))
    store.discard()
    kept = ("user_id", "member_level", "total_orders", "paid_gmv", "first_order_ts", "behavior_events", "customer_segment", "in_order")
    return _edge(back.join(judged, "part").select(*kept))


def gated_publish(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's verdict over the given tables: what would block, and was anything published?"""
    summary = quality.quality_summary(_candidate(spark, folder).health)
    return summary.select(
        F.when(F.col("status") == "pass", "published").otherwise("withheld").alias("outcome"), "blocking_checks"
    )


# --- publication ----------------------------------------------------------------------------------


_ROOTS: dict[tuple, str] = {}


def _publication(spark: SparkSession, folder: str, repaired: bool) -> str:
    """A root to which the given tables were released from CSV files, once per session and state of the files.

    Sound tables get through the gate.
    """
    key = (spark.sparkContext.applicationId, folder, repaired, files_state(spark, folder))
    if key not in _ROOTS:
        root, store = _scratch_folder(spark), scratch_store(spark)
        arrivals.write_text_files(StarSources(spark, folder, repaired=repaired, store=store), f"{root}/in")
        store.discard()
        _release(spark, root)
        _ROOTS[key] = root
    return _ROOTS[key]


def _release(spark: SparkSession, root: str) -> None:
    try:
        release.run_release(spark, f"{root}/in", root, "PORTFOLIO", run_at=RUN_AT, ids=c.WIDE_IDS)
    except release.QualityGateError:
        pass  # The run's manifest says what blocked it.


def publication_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """A whole release of the given and of the repaired tables: what the manifests say, and where the pointer leads."""
    rows = []
    for variant, repaired in (("given", False), ("repaired", True)):
        root = _publication(spark, folder, repaired)
        manifest = release.first_manifest(spark, root)
        current = release.current_release(spark, root)
        counts = manifest["data_profile"]
        rows.append((
            variant, "published" if manifest["published"] else "withheld", ",".join(manifest["quality"]["blocking_checks"]),
            current is not None and release.read_manifest(spark, current)["run_id"] == manifest["run_id"],
            len(manifest.get("exports", {})), len(manifest["statements"]), manifest["input"]["row_count"],
            counts["valid_rows"], counts["quarantine_rows"],
        ))
    names = "variant string, outcome string, blocking_checks string, pointer_leads_here boolean, exports bigint, statements bigint"
    return spark.createDataFrame(rows, f"{names}, input_rows bigint, valid_rows bigint, quarantine_rows bigint")


def _published(output: str) -> Query:
    """One output of the current release of the repaired tables, found through the pointer and read back typed."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = _publication(spark, folder, repaired=True)
        present, missing = release.read_release(spark, release.current_release(spark, root))
        if missing:
            raise RuntimeError(f"Outputs missing from the release: {missing}")
        return present[output].drop("details")

    return query


def republished_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The same input released twice: rows per output, and rows that only one of the two releases has."""
    root = _publication(spark, folder, repaired=True)
    before, _ = release.read_release(spark, release.current_release(spark, root))
    _release(spark, root)
    after, _ = release.read_release(spark, release.current_release(spark, root))
    counts = []
    for output in c.SERVING_SORT_KEYS:
        both = before[output].withColumn("side", F.lit(1)).unionAll(after[output].withColumn("side", F.lit(-1)))
        per_row = both.groupBy(*before[output].columns).agg(F.sum("side").alias("left"), F.count(F.lit(1)).alias("n"))
        sums = per_row.agg(*[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in (("n", F.col("n")), ("different", F.abs("left")))])
        # Compared now, one output after the other: in one plan the driver would run all eight comparisons at once.
        counts.append(literal_row(sums.select(F.lit(output).alias("output"), (F.col("n") / 2).cast("bigint").alias("output_rows"), "different")))
        give_back(spark)
    return union_all(counts)


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every layer saved as a table of the catalog: its grain as the catalog describes it, and its rows."""
    database = f"cartwright_{uuid.uuid4().hex}"
    store = scratch_store(spark)
    candidate = release.build_candidate(spark, StarSources(spark, folder, store=store), RUN_AT, c.WIDE_IDS, store)
    spark.sql(f"CREATE DATABASE {database}")
    try:
        catalog.save_tables(candidate.warehouse, candidate.health, database)
        rows = store.keep("described", catalog.described_tables(spark, database))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    store.discard(keep=("described",))
    return rows


def raw_views(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the six sources, read by the names of their views."""
    names = csv_files.register_views(dict(StarSources(spark, folder)))
    return union_all([spark.table(name).agg(F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("view_rows")) for name in names])


# --- arriving data --------------------------------------------------------------------------------


def streamed_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine of all six tables, judged as their CSV files arrive, two a batch."""
    root, store = _scratch_folder(spark), scratch_store(spark)
    arrivals.write_text_files(StarSources(spark, folder, store=store), f"{root}/in", files=4)
    store.discard()
    tables = stream_tables(spark, f"{root}/in", f"{root}/out", RUN_AT, c.WIDE_IDS, files_per_batch=2)
    rows = union_all([table.quarantine() for table in tables.values()])
    return _edge(rows.select("source_table", "record_key", "rejection_reasons", "source_file", "ingested_at", "quarantined_at"))


def streamed_hourly_behavior(spark: SparkSession, folder: str) -> DataFrame:
    """Behavior per hour of event time over event files that arrive in turn, late rows counted apart."""
    return arrivals.hourly_stream(spark, _warehouse(spark, folder).fact_behavior, _scratch_folder(spark)).result()


_LAYERS: dict[tuple, incremental.PartitionedLayers] = {}


def _replaced(fact: incremental.PartitionedFact, report: Callable[[incremental.PartitionedLayers], DataFrame]) -> Query:
    """A report over partitions that two change sets brought to their present state, once per session and state of the files."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, fact.name, files_state(spark, folder))
        if key not in _LAYERS:
            w = _warehouse(spark, folder)
            rows = w.fact_order if fact is incremental.ORDERS else w.fact_behavior
            _LAYERS[key] = arrivals.replaced_layers(spark, {fact: rows}, _scratch_folder(spark))
        return _edge(report(_LAYERS[key]))

    return query


def _sketched_customers(layers: incremental.PartitionedLayers) -> DataFrame:
    """Exact customers per status, and whether the sketches come within four standard errors."""
    exact = layers.order_status_summary().select("status_code", "customer_count")
    near = f"abs(customers - customer_count) <= 1 + {4 * incremental.SKETCH_ERROR} * customer_count"
    return exact.join(layers.approximate_customers(), "status_code").selectExpr("status_code", "customer_count", f"{near} AS within_bound")


def _prepared(query: Query) -> Query:
    return lambda spark, folder: query(prepare(spark), folder)


def _corpus():
    """The corpus queries, or None where that subpackage, or a library that it needs, is not installed."""
    try:
        import corpus_pipeline
        from cartwright.llm import registry
    except ModuleNotFoundError:
        return None
    return registry, corpus_pipeline


def core_queries() -> dict[str, Query]:
    registered = {
        "order_status_summary": order_status_summary,
        "users_rules": _judged("users"),
        "products_rules": _judged("products"),
        "orders_rules": _judged("orders"),
        "behaviors_rules": _judged("user_behaviors"),
        "user_features_rules": _judged("user_features"),
        "product_features_rules": _judged("product_features"),
        "optional_field_parse": optional_field_parse,
        "integral_decimal_parse": integral_decimal_parse,
        "orders_validated": _validated("orders"),
        "behaviors_validated": _validated("user_behaviors"),
        "user_features_validated": _validated("user_features"),
        "product_features_validated": _validated("product_features"),
        "valid_row_counts": valid_row_counts,
        "quarantine_rows": quarantine_rows,
        "rejection_reason_frequency": rejection_reason_frequency,
        "dim_user": _layer(lambda w: w.dim_user),
        "dim_product": _layer(lambda w: w.dim_product),
        "dim_date": _layer(lambda w: w.dim_date),
        "fact_order": _layer(lambda w: _facts_only(w.fact_order)),
        "fact_behavior": _layer(lambda w: _facts_only(w.fact_behavior)),
        "snapshot_user": _layer(lambda w: w.snapshot_user),
        "snapshot_product": _layer(lambda w: w.snapshot_product),
        "daily_commerce": _layer(lambda w: w.daily_commerce),
        "hourly_behavior": _layer(lambda w: w.hourly_behavior),
        "customer_summary": _layer(lambda w: w.customer_summary),
        "customer_segments": _layer(lambda w: w.customer_segments),
        "sequential_funnel": _layer(lambda w: w.sequential_funnel),
        "repeat_customers": _layer(lambda w: customers.repeat_customers(w.fact_order)),
        "category_performance": _layer(lambda w: w.category_performance),
        "category_ranking": _layer(lambda w: w.category_ranking),
        "executive_kpis": _kept("kpi_row", lambda w: w.executive_kpis),
        "orphan_rows": orphan_rows,
        "duplicate_keys": duplicate_keys,
        "lifecycle_violations": lifecycle_violations,
        "amount_mismatches": amount_mismatches,
        "user_feature_mismatches": user_feature_mismatches,
        "product_feature_mismatches": product_feature_mismatches,
        "kpi_reconciliation": kpi_reconciliation,
        "quality_checks": quality_checks,
        "quality_checks_repeated_parents": quality_checks_repeated_parents,
        "layers_by_name": layers_by_name,
        "quality_summary": quality_summary,
        "row_profile": _kept("profile_row", lambda w: quality.row_profile(quality.row_counts(w))),
        "evidence_reconciliation": evidence_reconciliation,
        "hourly_behavior_long": _layer(lambda w: consumption.hourly_behavior_long(w.hourly_behavior)),
        "top_categories": _layer(lambda w: consumption.top_categories(w.category_ranking)),
        "check_status_counts": check_status_counts,
        "daily_series": _layer(lambda w: consumption.daily_series(w.daily_commerce)),
        "status_series": _layer(lambda w: consumption.status_series(w.order_status_summary)),
        "segment_series": _layer(lambda w: consumption.segment_series(w.customer_segments)),
        "kpi_cards": _kept("kpi_cards", lambda w: consumption.kpi_cards(w.executive_kpis)),
        "csv_roundtrip": csv_roundtrip,
        "csv_corrupt_capture": csv_corrupt_capture,
        "csv_contract_check": csv_contract_check,
        "parquet_roundtrip": parquet_roundtrip,
        "table_fingerprint": table_fingerprint,
        "combined_fingerprint": combined_fingerprint,
        "typed_release_read": typed_release_read,
        "exported_customers": exported_customers,
        "gated_publish": gated_publish,
        "publication_outcome": publication_outcome,
        **{f"published_{output.removeprefix('ads_')}": _published(output) for output in c.SERVING_SORT_KEYS},
        "republished_outputs": republished_outputs,
        "catalog_tables": catalog_tables,
        "raw_views": raw_views,
        "streamed_quarantine": streamed_quarantine,
        "streamed_hourly_behavior": streamed_hourly_behavior,
        "replaced_daily_commerce": _replaced(incremental.ORDERS, lambda layers: layers.daily_commerce()),
        "replaced_order_status": _replaced(incremental.ORDERS, lambda layers: layers.order_status_summary()),
        "replaced_hourly_behavior": _replaced(incremental.BEHAVIORS, lambda layers: layers.hourly_behavior()),
        "sketched_customers": _replaced(incremental.ORDERS, _sketched_customers),
    }
    return {name: _prepared(query) for name, query in registered.items()}


def queries() -> dict[str, Query]:
    corpus = _corpus()
    if corpus is None:
        return core_queries()
    registry, pipeline = corpus
    return core_queries() | registry.QUERIES | {"pipeline": pipeline.run}


def core_oracle_sql() -> dict[str, str]:
    from oracle_statements import statements

    return statements()


def oracle_sql() -> dict[str, str]:
    corpus = _corpus()
    if corpus is None:
        return core_oracle_sql()
    registry, pipeline = corpus
    return core_oracle_sql() | registry.SQL | ({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})
