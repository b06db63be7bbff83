"""Build a candidate, gate it, publish it.

A release is a folder that is never changed after it is written.  Readers follow one
small pointer file, and replacing that file is the commit: whatever fails before
leaves the last good release in place.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import contract as c
from cartwright.operators.validation import union_all
from cartwright.plans import identity, quality
from cartwright.plans.kpis import with_run_constants
from cartwright.plans.warehouse import Warehouse
from cartwright.session import give_back, prepare
from cartwright.sources import csv_files, folders
from cartwright.sources.store import ParquetStore, scratch_store, shared_folder

POINTER = "current.json"


class QualityGateError(RuntimeError):
    """Critical checks failed, so nothing was published."""


class ConcurrentReleaseError(RuntimeError):
    """Another run published since this one began."""


@dataclass
class Candidate:
    """A built warehouse with its checks; nothing of it is visible to readers yet."""

    warehouse: Warehouse
    health: DataFrame
    summary: dict[str, Any]
    profile: dict[str, Any]
    measured: DataFrame

    @property
    def blocking(self) -> list[str]:
        return [name for name in self.summary["blocking_checks"].split(",") if name]


def new_run_id(data_mode: str, at: datetime) -> str:
    return f"{at:%Y%m%dT%H%M%SZ}-{data_mode.lower()}-{uuid.uuid4().hex[:8]}"


def build_candidate(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    run_at: datetime,
    ids: c.IdFormats = c.STRICT_IDS,
    store: ParquetStore | None = None,
) -> Candidate:
    """Materialise the layers, measure them once and derive the checks."""
    store = store or scratch_store(spark)
    prepare(spark)
    w = Warehouse(spark, sources, ids, store, run_at)
    w.build()
    measured = store.keep("ops_measurement", quality.measured(w))
    health = store.keep(
        "ops_data_quality_results",
        quality.quality_checks(measured).withColumn("checked_at", F.lit(run_at)),
    )
    summary = quality.quality_summary(health).first().asDict()
    if summary["total_checks"] == 0:
        raise QualityGateError("No quality check was produced")
    return Candidate(w, health, summary, quality.row_profile(measured).first().asDict(), measured)


def _outputs(w: Warehouse, health: DataFrame, run_at: datetime, data_mode: str, source_status: str) -> dict[str, DataFrame]:
    outputs = dict(w.serving)
    outputs["ads_executive_kpis"] = with_run_constants(
        outputs["ads_executive_kpis"], run_at.date().isoformat(), data_mode, source_status
    )
    outputs["ads_dataops_health"] = health
    return {name: outputs[name] for name in c.SERVING_SORT_KEYS}


_SCHEMAS: dict[str, dict[str, T.StructType]] = {}


def output_schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Columns and types of the eight outputs, from their plans over empty tables."""
    application = spark.sparkContext.applicationId
    if application not in _SCHEMAS:
        w, at = Warehouse(spark, identity.empty_sources(spark), planned_only=True), datetime(2000, 1, 1)
        health = quality.quality_checks(quality.measurement(w)).withColumn("checked_at", F.lit(at))
        _SCHEMAS[application] = {name: rows.schema for name, rows in _outputs(w, health, at, "DEMO", "").items()}
    return _SCHEMAS[application]


def read_release(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """The typed outputs of a release and the names of missing ones."""
    return csv_files.read_aggregates(spark, folder, output_schemas(spark))


def export(spark: SparkSession, outputs: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write every output as an ordered CSV; their rows are counted in one job."""
    counted = union_all(
        [rows.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n")) for name, rows in outputs.items()]
    )
    counts = {row["output"]: row["n"] for row in counted.collect()}
    empty = [name for name in outputs if counts[name] == 0]
    if empty:
        raise QualityGateError(f"Outputs without rows: {', '.join(empty)}")
    for name, rows in outputs.items():
        csv_files.write_aggregate(rows, f"{folder}/{name}.csv", c.SERVING_SORT_KEYS[name], counts[name])
        give_back(spark)
    return {name: counts[name] for name in outputs}


def _pointer(spark: SparkSession, root: str) -> dict[str, Any]:
    path = f"{root}/{POINTER}"
    found = json.loads(folders.read_text(spark, path)) if folders.exists(spark, path) else {"run_id": None}
    return {"version": 0, **found}


def _claim(root: str, version: int) -> str:
    return f"{root}/commits/{version:08d}.json"


def pointer_version(spark: SparkSession, root: str) -> int:
    """How often the pointer has moved; finishes a move that broke off after its claim."""
    now = _pointer(spark, root)["version"]
    claim = _claim(root, now + 1)
    if folders.exists(spark, claim):
        claimed = json.loads(folders.read_text(spark, claim))
        if folders.exists(spark, f"{release_folder(root, claimed['run_id'])}/manifest.json"):
            folders.replace_text(spark, f"{root}/{POINTER}", json.dumps(claimed) + "\n")
            return now + 1
        folders.remove_folder(spark, claim)
    return now


def switch_pointer(spark: SparkSession, root: str, run_id: str, seen: int) -> None:
    """Make a finished release the current one if the pointer is still where it was ``seen``; else withdraw the release.

    The next version is claimed by creating its file, which only one writer can; the winner replaces the pointer.
    """
    claim = _claim(root, seen + 1)
    moved = {"run_id": run_id, "version": seen + 1}
    claimed = False
    try:
        if pointer_version(spark, root) != seen or not folders.create_text(spark, claim, json.dumps(moved) + "\n"):
            raise ConcurrentReleaseError(f"Another release was published after version {seen}")
        claimed = True
        folders.replace_text(spark, f"{root}/{POINTER}", json.dumps(moved) + "\n")
    except Exception:
        if claimed:
            folders.remove_folder(spark, claim)
        folders.remove_folder(spark, release_folder(root, run_id))
        raise


def release_folder(root: str, run_id: str) -> str:
    return f"{root}/releases/{run_id}"


def current_release(spark: SparkSession, root: str) -> str | None:
    run_id = _pointer(spark, root)["run_id"]
    return release_folder(root, run_id) if run_id else None


def read_manifest(spark: SparkSession, folder: str) -> dict[str, Any]:
    return json.loads(folders.read_text(spark, f"{folder}/manifest.json"))


def first_manifest(spark: SparkSession, root: str) -> dict[str, Any]:
    """The manifest of the first run below a root, published or not."""
    runs = sorted(entry.name for entry in folders.entries(spark, f"{root}/runs"))
    return read_manifest(spark, f"{root}/runs/{runs[0]}")


def _write_manifest(spark: SparkSession, folder: str, manifest: dict[str, Any]) -> None:
    text = json.dumps(manifest, indent=2, ensure_ascii=False, default=str) + "\n"
    folders.replace_text(spark, f"{folder}/manifest.json", text)


def _quality_section(candidate: Candidate) -> dict[str, Any]:
    return {**candidate.summary, "blocking_checks": candidate.blocking}


def _profile_section(row: dict[str, Any]) -> dict[str, Any]:
    per_table = {
        f"{layer}_table_rows": {name: row[f"{layer}_{name}"] for name in c.HEADERS}
        for layer in ("raw", "valid", "dwd")
    }
    totals = ("raw_rows", "valid_rows", "quarantine_rows", "dwd_rows", "min_event_date", "max_event_date")
    return {**{name: row[name] for name in totals}, **per_table}


def _close(manifest: dict[str, Any], run_at: datetime, started: float) -> None:
    seconds = time.monotonic() - started
    manifest["duration_seconds"] = round(seconds, 3)
    manifest["finished_at"] = (run_at + timedelta(seconds=seconds)).isoformat()


def _kept_inputs(store: ParquetStore, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw text as written tables: what reads it afterwards parses no CSV again."""
    kept = {}
    for name, rows in sources.items():
        kept[name] = store.keep(f"src_{name}", rows)
        give_back(store.spark)
    return kept


def run_release(
    spark: SparkSession,
    input_folder: str,
    root: str,
    data_mode: str,
    *,
    run_at: datetime | None = None,
    publish: bool = True,
    ids: c.IdFormats = c.STRICT_IDS,
    keep_layers: bool = False,
    multi_line: bool = False,
) -> dict[str, Any]:
    """Six CSV inputs to eight published aggregates; returns the run manifest.

    The layers live in the shared folder while the run lasts, and beyond it on request.
    ``multi_line`` reads quoted line breaks.  The run sets the session settings of
    ``cartwright.session`` and leaves them set.
    """
    mode = data_mode.upper()
    if mode not in c.SOURCE_STATUS_BY_MODE:
        raise ValueError(f"Unsupported data mode: {data_mode}")
    run_at = run_at or datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = new_run_id(mode, run_at)
    run_folder = f"{root}/runs/{run_id}"
    started = time.monotonic()
    store = ParquetStore(spark, f"{shared_folder(spark)}/cartwright-{run_id}")
    manifest: dict[str, Any] = {
        "run_id": run_id,
        "data_mode": mode,
        "source_status": c.SOURCE_STATUS_BY_MODE[mode],
        "status": "running",
        "started_at": run_at.isoformat(),
        "spark_version": spark.version,
        "published": False,
    }
    try:
        seen = pointer_version(spark, root)
        csv_files.check_files(spark, input_folder)
        manifest["statements"] = identity.layer_digests(spark, ids)
        reports = csv_files.inspect_inputs(spark, input_folder, multi_line)
        sources = _kept_inputs(store, csv_files.read_inputs(spark, input_folder, run_at, multi_line))
        prints = csv_files.fingerprints(sources)
        ordered = {row["table_name"]: row["content_sha256"] for row in prints.collect()}
        manifest["input"] = {
            "combined_sha256": csv_files.combine(ordered),
            "row_count": sum(report["data_rows"] for report in reports.values()),
            "bytes": sum(report["bytes"] for report in reports.values()),
            "tables": {
                t: {"row_count": reports[t]["data_rows"], "bytes": reports[t]["bytes"], "content_sha256": ordered[t]}
                for t in c.HEADERS
            },
        }
        candidate = build_candidate(spark, sources, run_at, ids, store)
        manifest["quality"] = _quality_section(candidate)
        manifest["data_profile"] = _profile_section(candidate.profile)
        if candidate.blocking:
            raise QualityGateError(f"Critical checks failed: {', '.join(candidate.blocking)}")
        target = release_folder(root, run_id)
        if folders.exists(spark, target):
            raise RuntimeError(f"Release exists already: {target}")
        outputs = _outputs(candidate.warehouse, candidate.health, run_at, mode, manifest["source_status"])
        manifest["exports"] = export(spark, outputs, target if publish else f"{run_folder}/exports")
        manifest["status"] = "success"
        _close(manifest, run_at, started)
        if publish:
            _write_manifest(spark, target, {**manifest, "published": True})
            switch_pointer(spark, root, run_id, seen)
            manifest["published"] = True
    except Exception as exc:
        if publish and folders.exists(spark, release_folder(root, run_id)):
            # Not yet pointed to, so no reader has seen it.
            folders.remove_folder(spark, release_folder(root, run_id))
        manifest["status"] = "failed"
        manifest["error_type"] = type(exc).__name__
        manifest["error"] = str(exc)
        _close(manifest, run_at, started)
        _write_manifest(spark, run_folder, manifest)
        raise
    finally:
        if not keep_layers:
            store.discard()
    try:
        _write_manifest(spark, run_folder, manifest)
    except Exception as exc:  # The release is committed; a second copy of its manifest must not undo that.
        manifest["run_manifest_warning"] = f"{type(exc).__name__}: {exc}"
    return manifest
