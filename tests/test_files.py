"""CSV scan, contract inspection, fingerprints, typed read-back."""

import os
from datetime import datetime

import pytest

from cartwright import contract as c
from cartwright.plans import release
from cartwright.sources import csv_files, fixture
from cartwright.sources.csv_files import ContractError


def put(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write(text)
    return os.path.join(folder, name)


HEADER = ",".join(c.HEADERS["products"])


def test_scan_keeps_text_and_captures_wrong_width(spark, folder):
    path = put(folder, "products.csv", f"{HEADER}\nP000001,a, b ,m,1.50,007\nP000002,short\nP000003,a,b,c,1,2,3\n")
    rows = {r["product_id"]: r for r in csv_files.scan_csv(spark, path, c.HEADERS["products"]).collect()}
    assert (rows["P000001"]["category"], rows["P000001"]["sales_count"]) == (" b ", "007")
    assert rows["P000001"]["_corrupt_record"] is None
    assert rows["P000002"]["_corrupt_record"] == "P000002,short"
    assert rows["P000003"]["_corrupt_record"] == "P000003,a,b,c,1,2,3"


def test_corrupt_rows_are_seen_whatever_is_selected(spark, folder):
    path = put(folder, "products.csv", f"{HEADER}\nP000001,short\n")
    rows = csv_files.scan_csv(spark, path, c.HEADERS["products"])
    assert rows.select("product_id", "_corrupt_record").first()["_corrupt_record"] == "P000001,short"


@pytest.mark.parametrize(
    "text, expected",
    [
        (f"{HEADER}\nP000001,a,b,c,1,2\n", (True, 1, 0)),
        (f"﻿{HEADER}\nP000001,a,b,c,1,2\n", (True, 1, 0)),
        (f"{HEADER.upper()}\nP000001,a,b,c,1,2\n", (False, 1, 0)),
        (f"{HEADER}\nP000001,a\nP000002,a,b,c,1,2\n", (True, 2, 1)),
        ("product_id,x\nP000001,a\n", (False, 1, 1)),
        (f"{HEADER}\n", (True, 0, 0)),
    ],
)
def test_inspection(spark, folder, text, expected):
    row = csv_files.inspect_table(spark, put(folder, "products.csv", text), "products").first()
    assert (row["header_ok"], row["data_rows"], row["wrong_width_rows"]) == expected


def test_inspection_of_several_files(spark, folder):
    good = f"{HEADER}\n" + "".join(f"P{i:06d},a,b,c,1,2\n" for i in range(50))
    put(folder, "part-1.csv", good)
    put(folder, "part-2.csv", good)
    row = csv_files.inspect_table(spark, folder, "products").first()
    assert (row["files"], row["header_ok"], row["data_rows"]) == (2, True, 100)
    put(folder, "part-3.csv", good.replace("brand", "label"))
    assert csv_files.inspect_table(spark, folder, "products").first()["header_ok"] is False


@pytest.mark.parametrize("fault", ["missing", "header", "width", "empty", "no rows"])
def test_contract_errors(spark, folder, fault):
    for name, headers in c.HEADERS.items():
        body = ",".join(headers) + "\n" + ",".join("1" for _ in headers) + "\n"
        if name == "orders":
            if fault == "missing":
                continue
            body = {
                "header": body.replace("order_id", "id"), "width": body + "only,two\n", "empty": "",
                "no rows": ",".join(headers) + "\n",
            }[fault]
        put(folder, f"{name}.csv", body)
    with pytest.raises(ContractError, match="orders"):
        csv_files.inspect_inputs(spark, folder)


def test_fingerprint_ignores_order_and_layout_but_not_content(spark):
    rows = spark.range(200).selectExpr("CAST(id AS STRING) AS a", "IF(id % 7 = 0, NULL, 'x') AS b")

    def digest(frame):
        return csv_files.fingerprint(frame, "t", ["a", "b"]).first()["content_sha256"]

    base = digest(rows)
    assert digest(rows.orderBy("a").repartition(7)) == base
    assert digest(rows.union(rows.limit(1))) != base
    assert digest(rows.selectExpr("a", "coalesce(b, '') AS b")) != base


def test_fingerprint_takes_no_content_for_another(spark):
    def digest(*rows):
        frame = spark.createDataFrame(list(rows), "a string, b string")
        return csv_files.fingerprint(frame, "t", ["a", "b"]).first()["content_sha256"]

    alike = [("x\x1fy", "z"), ("x", "y\x1fz"), (None, "z"), ("\x1e", "z"), ("n", "z"), ("", "z"), ("v1:x", "z"), ("1", ":xv1:z"), ("1:", "xv1:z")]
    assert len({digest(row) for row in alike}) == len(alike)


def test_quotes_and_line_breaks(spark, folder):
    headers = c.HEADERS["products"]
    text = ",".join(headers) + '\nP000001,"say ""hi"", now",c,b,1.00,0\n'
    put(folder, "quoted.csv", text)
    rows = csv_files.scan_csv(spark, f"{folder}/quoted.csv", headers).collect()
    assert [(r["product_name"], r["_corrupt_record"]) for r in rows] == [('say "hi", now', None)]
    assert csv_files.inspect_table(spark, f"{folder}/quoted.csv", "products").first()["wrong_width_rows"] == 0
    broken = text + 'P000002,"two\nlines",c,b,1.00,0\n'
    put(folder, "broken.csv", broken)
    rows = csv_files.scan_csv(spark, f"{folder}/broken.csv", headers, multi_line=True).collect()
    assert [r["product_name"] for r in rows] == ['say "hi", now', "two\nlines"]
    report = csv_files.inspect_table(spark, f"{folder}/broken.csv", "products", multi_line=True).first()
    assert (report["data_rows"], report["wrong_width_rows"], report["bytes"]) == (2, 0, len(broken))
    csv_files.write_aggregate(spark.createDataFrame([('a "q" b', 1)], "note string, total_orders int"), f"{folder}/out", ())
    [part] = __import__("pathlib").Path(f"{folder}/out").glob("part-*.csv")
    assert part.read_text().splitlines()[1] == '"a ""q"" b",1'
    like = spark.createDataFrame([], "note string, total_orders int").schema
    assert csv_files.read_aggregate(spark, f"{folder}/out", like).first().asDict() == {"note": 'a "q" b', "total_orders": 1.0}


def test_large_exports_are_ordered_parts_with_one_header_in_all(spark, folder):
    rows = spark.range(5000).selectExpr("(id * 7919) % 5000 AS n", "concat('é', id, ', \"q\"') AS note")
    csv_files.write_aggregate(rows, f"{folder}/out", ("n", "absent"), part_rows=700)
    parts = sorted(f for f in os.listdir(f"{folder}/out") if f.startswith("part-"))
    assert len(parts) == 8
    lines = list(csv_files.export_lines(spark, f"{folder}/out"))
    assert lines[0] == "n,note" and lines.count("n,note") == 1
    assert [int(line.split(",")[0]) for line in lines[1:]] == list(range(5000))
    back = csv_files.read_aggregate(spark, f"{folder}/out", rows.schema, part="part")
    assert back.count() == 5000 and back.select("part").distinct().count() == 8
    # Equal keys stay together, NULL comes first, and what has no key or no rows is one part.
    tied = spark.createDataFrame([(1, "x")] * 30 + [(None, "x")] * 3, "k int, note string")
    csv_files.write_aggregate(tied, f"{folder}/tied", ("k",), part_rows=5)
    assert list(csv_files.export_lines(spark, f"{folder}/tied")) == ["k,note"] + [",x"] * 3 + ["1,x"] * 30
    csv_files.write_aggregate(tied, f"{folder}/keyless", (), part_rows=5)
    csv_files.write_aggregate(tied.limit(0), f"{folder}/empty", ("k",), part_rows=5)
    for name, lines in (("keyless", 34), ("empty", 1)):
        assert len([f for f in os.listdir(f"{folder}/{name}") if f.startswith("part-")]) == 1
        assert len(list(csv_files.export_lines(spark, f"{folder}/{name}"))) == lines


def test_combined_fingerprint_in_plan_and_on_driver(spark):
    prints = csv_files.fingerprints(fixture.fixture_sources(spark, 12))
    collected = {r["table_name"]: r["content_sha256"] for r in prints.collect()}
    assert csv_files.combined_fingerprint(prints).first()["combined_sha256"] == csv_files.combine(collected)


def test_typed_read_back(spark, folder):
    put(folder, "ads_daily_trend.csv", " Order_Date ,total_orders,note\n2024-01-01,5,a\nsoon,many,b\n")
    schemas = release.output_schemas(spark)
    rows = csv_files.read_aggregate(spark, f"{folder}/ads_daily_trend.csv", schemas["ads_daily_trend"]).collect()
    assert (rows[0]["order_date"], rows[0]["total_orders"], rows[0]["note"]) == (datetime(2024, 1, 1), 5.0, "a")
    assert (rows[1]["order_date"], rows[1]["total_orders"]) == (None, None)
    present, missing = release.read_release(spark, folder)
    assert list(present) == ["ads_daily_trend"] and len(missing) == 7


def test_views(spark):
    sources = csv_files.register_views(fixture.fixture_sources(spark, 4))
    assert "raw_users_raw" in sources
    assert spark.table("raw_users_raw").count() == 4


def test_links_and_empty_files_are_refused(spark, folder):
    for name in c.HEADERS:
        os.makedirs(f"{folder}/in/{name}.csv")
        put(f"{folder}/in/{name}.csv", "part-0.csv", ",".join(c.HEADERS[name]) + "\n")
        put(f"{folder}/in/{name}.csv", "_SUCCESS", "")
    csv_files.check_files(spark, f"{folder}/in")
    empty = put(f"{folder}/in/users.csv", "part-1.csv", "")
    with pytest.raises(ContractError, match="users.csv/part-1.csv is an empty file"):
        csv_files.check_files(spark, f"{folder}/in")
    put(f"{folder}/in/users.csv", "part-1.csv", "x")
    outside = put(folder, "outside.csv", "secret")
    os.symlink(outside, f"{folder}/in/orders.csv/part-9.csv")
    with pytest.raises(ContractError, match="orders.csv/part-9.csv is a symbolic link"):
        csv_files.check_files(spark, f"{folder}/in")
    os.makedirs(f"{folder}/other")
    os.symlink(f"{folder}/in/users.csv", f"{folder}/other/users.csv")
    with pytest.raises(ContractError, match="users.csv is a symbolic link"):
        csv_files.check_files(spark, f"{folder}/other")
    with pytest.raises(ContractError, match="Required input is missing: users.csv"):
        csv_files.check_files(spark, f"{folder}/nowhere")
    assert os.path.getsize(empty) == 1
