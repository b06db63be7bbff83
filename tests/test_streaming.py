"""Quarantine and hourly activity over arriving files."""

from datetime import datetime

import pytest

from cartwright import contract as c
from cartwright.plans.warehouse import Warehouse
from cartwright.sources import csv_files, fixture
from cartwright.sources.store import ParquetStore
from cartwright.streaming.hourly import EVENT_SCHEMA, HourlyStream
from cartwright.streaming.quarantine import StreamedTable, stream_tables

RUN_AT = datetime(2024, 2, 1)


def raw_users(spark, *rows):
    whole = [(f"U{i:06d}", age, "男", "p", "q", "2023-01-01 00:00:00", "普通会员", "1.00", "500") for i, age in rows]
    return spark.createDataFrame(whole, ", ".join(f"{h} string" for h in c.HEADERS["users"]))


def arrive(rows, folder):
    rows.coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/users.csv")


def users_stream(spark, folder):
    table = StreamedTable(spark, "users", f"{folder}/out", RUN_AT)
    rows = csv_files.stream_csv(spark, f"{folder}/users.csv", c.HEADERS["users"], 1)
    return table, csv_files.with_lineage(rows, "users.csv", RUN_AT)


def outcome(table):
    valid = sorted(r["user_id"] for r in table.valid().collect())
    rejected = sorted((r["record_key"], r["rejection_reasons"]) for r in table.quarantine().collect())
    return valid, rejected


EXPECTED = (["U000001", "U000004"], [("U000002", "invalid_age_parse"), ("U000003", "invalid_age")])


@pytest.mark.parametrize("broken_sink", ["staged", "quarantine", "commit"])
def test_a_broken_batch_is_taken_again_without_repeats(spark, folder, monkeypatch, broken_sink):
    arrive(raw_users(spark, (1, "20"), (2, "abc")), folder)
    arrive(raw_users(spark, (3, "7"), (4, "40")), folder)
    table, rows = users_stream(spark, folder)
    real, failures = ParquetStore.keep, []

    def fails_once(self, name, frame, partition_by=None):
        written = real(self, name, frame, partition_by)
        if name == "batch=1" and self.root.endswith(broken_sink) and not failures:
            failures.append(name)
            raise OSError("disk is gone")
        return written

    if broken_sink == "commit":
        import cartwright.streaming.quarantine as module

        plain = module.folders.replace_text

        def refuse(session, path, text):
            if "1" in text and not failures:
                failures.append(path)
                raise OSError("commit lost")
            plain(session, path, text)

        monkeypatch.setattr(module.folders, "replace_text", refuse)
    else:
        monkeypatch.setattr(ParquetStore, "keep", fails_once)
    with pytest.raises(Exception, match="disk is gone|commit lost"):
        table.run(rows)
    assert failures
    valid, rejected = outcome(table)
    assert len(valid) + len(rejected) == 2  # Only the whole batch is seen.
    table.run(users_stream(spark, folder)[1])
    assert outcome(table) == EXPECTED
    table.run(users_stream(spark, folder)[1])
    assert outcome(table) == EXPECTED


def test_nothing_has_arrived(spark, folder):
    assert outcome(StreamedTable(spark, "users", f"{folder}/out", RUN_AT)) == ([], [])


def test_streams_equal_the_batch(spark, folder):
    sources = fixture.fixture_sources(spark, 30)
    for name, headers in c.HEADERS.items():
        rows = sources[name].select(*[f"`{h}`" for h in headers])
        if name == "orders":
            rows = rows.selectExpr(*[f"IF(order_id = 'O00000002', 'X', user_id) AS user_id" if h == "user_id" else f"`{h}`" for h in headers])
        rows.repartition(2).write.option("header", True).option("escape", '"').csv(f"{folder}/in/{name}.csv")
    tables = stream_tables(spark, f"{folder}/in", f"{folder}/out", RUN_AT, files_per_batch=1)
    w = Warehouse(spark, csv_files.read_inputs(spark, f"{folder}/in", RUN_AT), run_at=RUN_AT)
    for name, table in tables.items():
        assert sorted(table.staged().collect(), key=str) == sorted(w.staged(name).select(*table.staged().columns).collect(), key=str), name
    found = [r for t in tables.values() for r in t.quarantine().select("source_table", "record_key", "rejection_reasons").collect()]
    assert ("orders", "O00000002", "invalid_user_id;broken_user_fk") in {tuple(r) for r in found}


def at(day, hour, minute=0):
    return datetime(2024, 1, day, hour, minute)


def test_late_rows_count_apart(spark, folder):
    stream = HourlyStream(spark, f"{folder}/in", f"{folder}/out", "2 hours")
    batches = [
        [("b1", "u1", "browse", at(1, 0, 10), 5), ("b2", "u1", "click", at(1, 0, 20), 5), ("b3", "u2", "browse", at(1, 5), 1)],
        # Hour 0 ended before 5:00 - 2h: late.  Hour 3 did not.
        [("b4", "u9", "browse", at(1, 0, 30), 7), ("b5", "u2", "cart", at(1, 3, 30), None), ("b6", "u3", "browse", at(1, 1, 1), 7)],
        [("b7", "u1", "favorite", at(2, 0), 2)],
    ]
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/arrival={number}")
        stream.advance()
    got = {r["hour_start"].replace(tzinfo=None): tuple(r)[1:] for r in stream.result().collect()}
    assert got == {
        # events, users, browse, click, favorite, cart, seconds, late
        at(1, 0): (2, 1, 1, 1, 0, 0, 10, 1),
        at(1, 1): (0, 0, 0, 0, 0, 0, 0, 1),
        at(1, 3): (1, 1, 0, 0, 0, 1, 0, 0),
        at(1, 5): (1, 1, 1, 0, 0, 0, 1, 0),
    }
