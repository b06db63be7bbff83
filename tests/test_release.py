"""Whole runs over the generated fixture: golden results, faults, idempotence, publication."""

import json
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.plans import identity, quality, release
from cartwright.sources import catalog, csv_files, fixture, folders
from cartwright.sources.csv_files import ContractError
from cartwright.sources.store import scratch_store

RUN_AT = datetime(2026, 4, 1, 8, 0, 0)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """The 40-user fixture, published once."""
    root = tmp_path_factory.mktemp("release")
    fixture.write_fixture(spark, f"{root}/in")
    manifest = release.run_release(spark, f"{root}/in", f"{root}/out", "demo", run_at=RUN_AT)
    return root, manifest


@pytest.fixture(scope="module")
def candidate(spark):
    return release.build_candidate(spark, fixture.fixture_sources(spark), RUN_AT)


def published(spark, root):
    folder = Path(release.current_release(spark, f"{root}/out"))
    files = sorted(p for p in folder.rglob("*") if p.is_file() and not p.name.startswith("."))
    return {str(p.relative_to(folder)): p.read_bytes() for p in files}


def recount(root):
    """The published numbers counted by SQL straight from the input files."""
    con = duckdb.connect()
    for name in c.HEADERS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_csv('{root}/in/{name}.csv/*.csv', header = true, all_varchar = true, escape = '\"')")
    one = lambda sql: con.execute(sql).fetchone()[0]
    done, paid = "order_status = '已完成'", "order_status IN ('已付款', '已发货', '已收货', '已完成')"
    kpi = {
        "total_orders": one("SELECT count(*) FROM orders"),
        "ordering_customers": one("SELECT count(DISTINCT user_id) FROM orders"),
        "completed_orders": one(f"SELECT count(*) FROM orders WHERE {done}"),
        "completed_customers": one(f"SELECT count(DISTINCT user_id) FROM orders WHERE {done}"),
        "behavior_events": one("SELECT count(*) FROM user_behaviors"),
        "registered_users": one("SELECT count(*) FROM users"),
        "products": one("SELECT count(*) FROM products"),
        "quarantined_rows": 0,
    }
    gmv = float(one(f"SELECT sum(CAST(actual_payment AS DECIMAL(18,2))) FROM orders WHERE {done}"))
    reached = "SELECT user_id, min(behavior_time) AS t FROM user_behaviors WHERE behavior_type = '浏览' GROUP BY 1"
    funnel = [one(f"SELECT count(*) FROM ({reached})")]
    for later, time in (
        ("FROM user_behaviors x JOIN ({}) r USING (user_id) WHERE behavior_type = '点击'", "behavior_time"),
        ("FROM user_behaviors x JOIN ({}) r USING (user_id) WHERE behavior_type IN ('收藏', '加购')", "behavior_time"),
        (f"FROM orders x JOIN ({{}}) r USING (user_id) WHERE {paid}", "order_date"),
    ):
        reached = f"SELECT x.user_id, min({time}) AS t {later.format(reached)} AND {time} >= r.t GROUP BY 1"
        funnel.append(one(f"SELECT count(*) FROM ({reached})"))
    segments = dict(con.execute(f"""
        SELECT CASE WHEN paid > 1 THEN 'repeat_paid_customer' WHEN paid = 1 THEN 'single_paid_customer'
                    WHEN n > 0 THEN 'order_without_payment' WHEN seen > 0 THEN 'engaged_noncustomer' ELSE 'inactive' END, count(*)
        FROM (SELECT user_id, (SELECT count(*) FROM orders o WHERE o.user_id = u.user_id) AS n,
                     (SELECT count(*) FROM orders o WHERE o.user_id = u.user_id AND {paid}) AS paid,
                     (SELECT count(*) FROM user_behaviors b WHERE b.user_id = u.user_id) AS seen FROM users u) GROUP BY 1""").fetchall())
    return kpi, gmv, funnel, segments


def test_golden_run(spark, base):
    root, manifest = base
    assert (manifest["status"], manifest["published"]) == ("success", True)
    quality_section = manifest["quality"]
    assert [quality_section[k] for k in ("total_checks", "passed_checks", "failed_checks", "warning_checks")] == [20, 18, 0, 2]
    assert (quality_section["blocking_checks"], quality_section["status"]) == ([], "pass")
    tables, missing = release.read_release(spark, release.current_release(spark, f"{root}/out"))
    assert missing == []
    kpi = tables["ads_executive_kpis"].first().asDict()
    expected, gmv, users_by_stage, users_by_segment = recount(root)
    assert {name: kpi[name] for name in expected} == expected
    assert kpi["completed_gmv"] == pytest.approx(gmv)
    assert kpi["completion_rate"] == pytest.approx(expected["completed_orders"] / expected["total_orders"], abs=5e-5)
    assert (kpi["data_mode"], kpi["source_status"]) == ("DEMO", "SYNTHETIC_FIXTURE")
    funnel = tables["ads_sequential_funnel"].collect()
    assert [row["user_count"] for row in sorted(funnel, key=lambda row: row["stage_order"])] == users_by_stage
    segments = {r["customer_segment"]: r["user_count"] for r in tables["ads_customer_segments"].collect()}
    assert {name: n for name, n in segments.items() if n} == users_by_segment
    rows = sum(fixture.sizes(40).values())
    assert manifest["data_profile"]["raw_rows"] == manifest["data_profile"]["dwd_rows"] == rows
    assert manifest["input"]["row_count"] == rows
    written = {t: sum(p.stat().st_size for p in Path(f"{root}/in/{t}.csv").glob("part-*.csv")) for t in c.HEADERS}
    assert {t: table["bytes"] for t, table in manifest["input"]["tables"].items()} == written
    assert manifest["input"]["bytes"] == sum(written.values())
    assert manifest["started_at"] <= manifest["finished_at"]


def test_exports_are_ordered_single_files(spark, base):
    root, manifest = base
    folder = Path(release.current_release(spark, f"{root}/out"))
    for name, keys in c.SERVING_SORT_KEYS.items():
        parts = list((folder / f"{name}.csv").glob("part-*.csv"))
        assert len(parts) == 1
        lines = parts[0].read_text(encoding="utf-8").splitlines()
        assert len(lines) - 1 == manifest["exports"][name]
        if keys:
            at = lines[0].split(",").index(keys[0])
            values = [line.split(",")[at] for line in lines[1:]]
            assert values == sorted(values, key=lambda v: (float(v) if v.replace(".", "").isdigit() else 0, v))


def damaged(base, spark, table, change):
    """A copy of the inputs with one table rewritten by ``change``."""
    root, _ = base
    target = f"{root}/{table}-{change.__name__}"
    for name, headers in c.HEADERS.items():
        rows = csv_files.scan_csv(spark, f"{root}/in/{name}.csv", headers).drop("_corrupt_record")
        if name == table or table == "all":
            rows = change(name, rows)
        if rows is not None:
            rows.write.option("header", True).option("escape", '"').csv(f"{target}/{name}.csv")
    return target


def set_where(rows, key, value, **changes):
    hit = F.col(key) == value
    return rows.withColumns({n: F.when(hit, F.lit(v)).otherwise(F.col(n)) for n, v in changes.items()})


def missing_file(_, rows):
    return None


def duplicate_order(_, rows):
    return rows.union(rows.filter("order_id = 'O00000001'"))


def invalid_lifecycle(_, rows):
    return set_where(rows, "order_id", "O00000001", order_status="已完成", delivery_date="", receive_date="")


def feature_mismatch(_, rows):
    return rows.withColumn(
        "total_spent", F.expr("IF(user_id = 'U000001', CAST(CAST(total_spent AS DECIMAL(18,2)) + 1 AS STRING), total_spent)")
    )


def parse_failures(name, rows):
    edits = {
        "users": [("user_id", "U000001", {"age": "abc"}), ("user_id", "U000002", {"user_id": ""})],
        "orders": [("order_id", "O00000003", {"quantity": "abc"}), ("order_id", "O00000004", {"total_amount": "abc"})],
        "user_behaviors": [
            ("behavior_id", "B00000005", {"duration_seconds": "abc"}), ("behavior_id", "B00000006", {"behavior_type": "购买"}),
            ("behavior_id", "B00000007", {"behavior_time": "not-a-timestamp"}), ("behavior_id", "B00000008", {"behavior_id": ""}),
        ],
        "user_features": [("user_id", "U000009", {"total_spent": "abc"}), ("user_id", "U000010", {"order_count": "6.5"})],
        "product_features": [("product_id", "P000010", {"popularity_score": "abc"})],
    }
    for key, value, changes in edits.get(name, []):
        rows = set_where(rows, key, value, **changes)
    return rows


@pytest.mark.parametrize(
    "table, change, error, blocking",
    [
        ("orders", missing_file, ContractError, []),
        ("orders", duplicate_order, release.QualityGateError, ["primary_keys_unique"]),
        ("orders", invalid_lifecycle, release.QualityGateError, ["order_lifecycle_dates_valid"]),
        ("user_features", feature_mismatch, release.QualityGateError, ["user_feature_snapshot_reconciles"]),
        ("all", parse_failures, release.QualityGateError,
         ["non_temporal_quarantine_empty", "user_feature_snapshot_reconciles"]),
    ],
    ids=lambda v: getattr(v, "__name__", None),
)
def test_faults_leave_the_last_good_release(spark, base, table, change, error, blocking):
    root, _ = base
    before = published(spark, root)
    runs = {p.name for p in Path(f"{root}/out/runs").iterdir()}
    with pytest.raises(error):
        release.run_release(spark, damaged(base, spark, table, change), f"{root}/out", "demo", run_at=RUN_AT)
    assert published(spark, root) == before
    (run,) = {p.name for p in Path(f"{root}/out/runs").iterdir()} - runs
    manifest = json.loads(Path(f"{root}/out/runs/{run}/manifest.json").read_text(encoding="utf-8"))
    assert (manifest["status"], manifest["published"]) == ("failed", False)
    assert manifest["error_type"] == error.__name__
    if blocking:
        assert set(blocking) <= set(manifest["quality"]["blocking_checks"])
    if change is parse_failures:
        assert manifest["data_profile"]["quarantine_rows"] >= 10


def test_same_input_gives_the_same_outputs(spark, base):
    root, _ = base
    before = published(spark, root)
    release.run_release(spark, f"{root}/in", f"{root}/out", "demo", run_at=RUN_AT)
    after = published(spark, root)

    def business(files):
        return {
            name.split("/")[0]: data for name, data in files.items()
            if name.endswith(".csv") and "health" not in name
        }

    assert business(before) == business(after) and len(business(before)) == 7


def test_a_failed_switch_withdraws_the_release(spark, base, monkeypatch):
    root, _ = base
    before = release.current_release(spark, f"{root}/out")
    kept = {p.name for p in Path(f"{root}/out/releases").iterdir()}
    real = folders.replace_text

    def refuse(session, path, text):
        if path.endswith(release.POINTER):
            raise OSError("pointer not writable")
        real(session, path, text)

    monkeypatch.setattr(folders, "replace_text", refuse)
    with pytest.raises(OSError):
        release.run_release(spark, f"{root}/in", f"{root}/out", "demo", run_at=RUN_AT)
    assert release.current_release(spark, f"{root}/out") == before
    assert {p.name for p in Path(f"{root}/out/releases").iterdir()} == kept


def test_of_two_writers_one_wins(spark, folder):
    """Both runs saw the same pointer; the second finds it moved and withdraws its release."""
    for run in ("first", "second", "third"):
        folders.replace_text(spark, f"{folder}/releases/{run}/manifest.json", "{}")
    assert release.pointer_version(spark, folder) == 0 and release.current_release(spark, folder) is None
    release.switch_pointer(spark, folder, "first", 0)
    with pytest.raises(release.ConcurrentReleaseError):
        release.switch_pointer(spark, folder, "second", 0)
    assert release.current_release(spark, folder).endswith("releases/first")
    assert not folders.exists(spark, f"{folder}/releases/second") and release.pointer_version(spark, folder) == 1
    assert not folders.create_text(spark, f"{folder}/commits/00000001.json", "x")
    # A claim whose writer stopped before it moved the pointer is finished by the next one; one without a release is dropped.
    folders.create_text(spark, f"{folder}/commits/00000002.json", json.dumps({"run_id": "third", "version": 2}))
    assert release.pointer_version(spark, folder) == 2 and release.current_release(spark, folder).endswith("third")
    folders.create_text(spark, f"{folder}/commits/00000003.json", json.dumps({"run_id": "lost", "version": 3}))
    assert release.pointer_version(spark, folder) == 2 and not folders.exists(spark, f"{folder}/commits/00000003.json")
    assert [p.name for p in Path(folder).rglob("*.tmp")] == []


def test_layer_digests_follow_the_rules(spark, base, monkeypatch):
    _, manifest = base
    digests = identity.layer_digests(spark)
    assert digests == manifest["statements"] == identity.layer_digests(spark.newSession()) and len(digests) == 33
    assert identity.layer_digests(spark, c.WIDE_IDS)["dwd_fact_order"] != digests["dwd_fact_order"]
    monkeypatch.setattr(c, "AGE_BANDS", ((26, "18-25"), *c.AGE_BANDS[1:]))
    changed = {name for name, digest in identity.layer_digests(spark).items() if digest != digests[name]}
    assert {"dwd_dim_user", "dws_customer_summary", "bundle"} <= changed and "dwd_fact_behavior" not in changed


def test_warning_on_a_critical_check_blocks(spark):
    rows = [("a", "warn", "critical"), ("b", "warn", "warning"), ("c", "pass", "critical"), ("d", "FAIL", "Critical")]
    health = spark.createDataFrame(rows, "check_name STRING, check_status STRING, severity STRING")
    assert {r["check_name"] for r in quality.blocking(health).collect()} == {"a", "d"}
    summary = quality.quality_summary(health).first()
    assert (summary["blocking_checks"], summary["status"], summary["warning_checks"]) == ("a,d", "fail", 2)


def test_evidence(spark, candidate):
    def holds(mode, status):
        rows = quality.evidence_reconciliation(
            candidate.warehouse.executive_kpis, quality.row_profile(candidate.measured),
            quality.quality_summary(candidate.health), mode, status,
        )
        return {r["statement"]: r["holds"] for r in rows.collect()}

    assert all(holds("DEMO", "SYNTHETIC_FIXTURE").values())
    assert [n for n, ok in holds("DEMO", "UNVERIFIED").items() if not ok] == ["mode_discloses_source"]


def test_views_and_tables(spark, candidate):
    names = catalog.create_views(candidate.warehouse, candidate.health)
    assert len(names) == 32
    assert spark.table("dwd_dim_order_status").count() == 7
    for name in names:
        spark.catalog.dropTempView(name)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    saved = catalog.save_tables(candidate.warehouse, candidate.health, "shop")
    assert len(saved) == 32 and spark.table("shop.dwd_fact_order").count() == fixture.sizes(40)["orders"]
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED shop.dwd_fact_order").collect()}
    assert described["Comment"] == "Grain: one valid order."
    catalog.save_tables(candidate.warehouse, candidate.health, "shop")
    assert spark.table("shop.dwd_fact_order").count() == fixture.sizes(40)["orders"]


def test_store_round_trip_keeps_schema_and_rows(spark):
    rows = spark.range(10).selectExpr("id", "id % 2 = 0 AS accepted", "CAST(id AS DECIMAL(18,2)) AS amount")
    back = scratch_store(spark).keep("t", rows, partition_by="accepted")
    assert back.dtypes == rows.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_repeated_parents_fail_keys_and_counts_only(spark):
    sources = fixture.fixture_sources(spark)
    for name, key in (("users", "user_id = 'U000001'"), ("products", "product_id = 'P000001'")):
        sources[name] = sources[name].unionByName(sources[name].filter(key))
    once = {r["check_name"]: r["observed_value"] for r in release.build_candidate(spark, fixture.fixture_sources(spark), RUN_AT).health.collect()}
    twice = {r["check_name"]: r for r in release.build_candidate(spark, sources, RUN_AT).health.collect()}
    assert {n for n, r in twice.items() if r["check_status"] == "fail"} == {"raw_ods_row_reconciliation", "primary_keys_unique"}
    for name in ("user_feature_snapshot_reconciles", "product_feature_snapshot_reconciles", "unit_price_total_difference_reported"):
        assert twice[name]["observed_value"] == once[name]


def test_fixture_sizes_and_determinism(spark):
    first = fixture.fixture_sources(spark, 40)
    assert {n: f.count() for n, f in first.items()} == fixture.sizes(40)
    digest = csv_files.fingerprints(first).collect()
    assert csv_files.fingerprints(fixture.fixture_sources(spark, 40)).collect() == digest
    with pytest.raises(ValueError):
        fixture.sizes(2)


def test_larger_fixture_passes_the_gate(spark):
    built = release.build_candidate(spark, fixture.fixture_sources(spark, 3000), RUN_AT)
    assert built.blocking == [] and built.profile["quarantine_rows"] == 0
