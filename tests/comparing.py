"""Run registered queries on Spark and their SQL twins on DuckDB and compare all rows.

``python tests/comparing.py /root/testdata/sf0.01 [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, connection, folder: str, query, sql: str) -> str | None:
    """None when names, types and all values agree, otherwise what differs."""
    result = query(spark, folder)
    found = [tuple(row) for row in result.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} / {sorted(names)}"
    spark_types = {f.name: _kind(f.dataType.simpleString()) for f in result.schema}
    sql_types = {d[0]: _kind(str(d[1]).lower()) for d in cursor.description}
    if spark_types != sql_types:
        return f"types {[(n, spark_types[n], sql_types[n]) for n in names if spark_types[n] != sql_types[n]]}"
    left, right = _bag(found, result.columns), _bag(expected, names)
    if left != right:
        return f"rows {len(found)} / {len(expected)}; only spark {list((left - right))[:3]}; only sql {list((right - left))[:3]}"
    return None


def _kind(name: str) -> str:
    aliases = {"varchar": "string", "timestamp_ntz": "timestamp", "integer": "int"}
    return aliases.get(name, name)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    where = sys.argv[1]
    chosen = sys.argv[2:] or list(entry.queries())
    sql_by_name, con = entry.oracle_sql(), oracle(where)
    for name in chosen:
        started = time.time()
        try:
            verdict = compare(session, con, where, entry.queries()[name], sql_by_name[name]) or "same"
        except Exception as exc:  # noqa: BLE001
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        print(f"{name}: {verdict} ({time.time() - started:.1f}s)", flush=True)
