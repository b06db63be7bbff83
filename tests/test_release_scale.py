"""What a release does once per row: digests summed as integers, source rows of several tables made once."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartwright.plans import arrivals
from cartwright.sources import csv_files
from cartwright.sources.store import ParquetStore


def digest(rows):
    hexes = [hashlib.sha256("".join("n" if v is None else f"v{len(v)}:{v}" for v in row).encode()).hexdigest() for row in rows]
    limbs = [sum(int(h[start : start + 15], 16) for h in hexes) for start in range(0, 64, 15)]
    return hashlib.sha256(":".join(map(str, [*limbs, len(rows)])).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [("a", None)], [("a", None), ("", "é")] * 3, [(str(i), None if i % 7 else "x") for i in range(5000)]])
def test_fingerprint_is_the_sum_of_row_digests(spark, rows):
    frame = spark.createDataFrame(rows, "a string, b string")
    found = csv_files.fingerprint(frame, "t", ["a", "b"]).first()
    assert (found["row_count"], found["content_sha256"]) == (len(rows), digest(rows))


def test_fingerprint_adds_no_decimals_row_by_row(spark):
    frame = spark.range(3).select(F.col("id").cast("string").alias("a"))
    plan = csv_files.fingerprint(frame, "t", ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(conv" not in plan and "sum((shiftright(" in plan


@pytest.mark.parametrize("query", ["publication", "streamed", "layers"])
def test_order_and_event_rows_are_written_once(spark, folder, monkeypatch, query):
    stores, made = [], entry.StarSources

    class Stop(Exception):
        pass

    def sources(*args, store=None, **options):
        stores.append(store)
        return made(*args, store=store, **options)

    def stop(*args, **options):
        raise Stop

    monkeypatch.setattr(entry, "StarSources", sources)
    monkeypatch.setattr(arrivals, "write_text_files", stop)
    monkeypatch.setattr(entry.release, "build_candidate", stop)
    monkeypatch.setattr(entry, "files_state", lambda *_: ())
    runs = {
        "publication": lambda: entry._publication(spark, folder, True),
        "streamed": lambda: entry.streamed_quarantine(spark, folder),
        "layers": lambda: entry.layers_by_name(spark, folder),
    }
    with pytest.raises(Stop):
        runs[query]()
    assert len(stores) == 1 and isinstance(stores[0], ParquetStore)
