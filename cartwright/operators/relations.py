"""Small relations and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.parsing import exprs, literal, rows_of, safe_ratio
from cartwright.operators.validation import union_all


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """An inline relation whose rows are part of the plan."""
    structs = [dict(zip(columns, map(literal, row), strict=True)) for row in rows]
    return spark.range(0, 1, 1, 1).selectExpr(rows_of(structs))


def decode(rows: DataFrame, codes: DataFrame, source: str, code_key: str) -> DataFrame:
    """Inner lookup into a code dimension, which holds a handful of literal rows."""
    return rows.join(F.broadcast(codes), rows[source] == codes[code_key], "inner").drop(code_key)


def side_by_side(frames: Sequence[DataFrame]) -> DataFrame:
    """One-row relations with different columns as a single row.

    Each relation becomes a scalar subquery, so no product of relations is planned and
    the subqueries run side by side.
    """
    spark = frames[0].sparkSession
    packed = [
        frame.selectExpr(f"struct({', '.join(frame.columns)}) AS row").scalar().alias(f"row_{position}")
        for position, frame in enumerate(frames)
    ]
    fields = [
        f"row_{position}.{name} AS {name}" for position, frame in enumerate(frames) for name in frame.columns
    ]
    return spark.range(0, 1, 1, 1).select(*packed).selectExpr(*fields)


def literal_values(spark: SparkSession, schema: T.StructType, values: Mapping[str, Any]) -> DataFrame:
    """One row of known values in the types of a schema."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def literal_row(frame: DataFrame) -> DataFrame:
    """A one-row relation, computed now, as a plan of literals."""
    return literal_values(frame.sparkSession, frame.schema, frame.collect()[0].asDict())


def with_share(grouped: DataFrame, amount: str, share: str) -> DataFrame:
    """Share of the total over an already aggregated relation of a few rows."""
    return grouped.selectExpr("*", f"{safe_ratio(amount, f'sum({amount}) OVER ()')} AS {share}")


# Ranges that a global rank is taken in, and bytes of a name that take part in choosing the range.
RANGES, NAME_BYTES = 64, 6


def ranked(written: DataFrame, rank: str, amount: str, name: str) -> DataFrame:
    """Rank by ``amount`` (two decimals, falling) and ``name`` (rising), without one task over all rows.

    Rows are ranked within ranges of some sixty quantiles, and each range starts after the rows of those before it.  A range
    is chosen by one number that never falls along the order: the amount in cents, and below it the first bytes of
    the name, so that many rows of one amount spread over ranges too.  ``written`` is read three times.
    """
    unit = float(1 << 8 * NAME_BYTES)
    opening = f"CAST(conv(rpad(hex(substring(encode({name}, 'UTF-8'), 1, {NAME_BYTES})), {2 * NAME_BYTES}, '0'), 16, 10) AS DOUBLE)"
    place = f"coalesce(CAST(-{amount} * 100 AS DOUBLE), 1e300D) * {unit}D + coalesce({opening}, 0D)"
    rows = written.withColumn("__place", F.expr(place))
    # Bounds and counts: as many numbers as there are ranges.
    bounds = sorted(set(rows.approxQuantile("__place", [i / RANGES for i in range(1, RANGES)], 0.25 / RANGES)))
    bounds_sql = ", ".join(f"{bound!r}D" for bound in bounds) or "CAST(NULL AS DOUBLE)"
    ranges = rows.withColumn("__range", F.expr(f"size(filter(array({bounds_sql}), bound -> bound < __place))"))
    before, starts = 0, []
    for row in sorted(ranges.groupBy("__range").count().collect()):
        starts.append(f"WHEN {row['__range']} THEN {before}")
        before += row["count"]
    start = f"CASE __range {' '.join(starts)} END" if starts else "0"
    order = f"row_number() OVER (PARTITION BY __range ORDER BY {amount} DESC, {name})"
    return ranges.selectExpr(*written.columns, f"CAST({start} + {order} AS INT) AS {rank}")


def duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows beyond the first per key, for each table: COUNT(*) - COUNT(DISTINCT key)."""
    keys = union_all(
        [
            rows.selectExpr(f"{literal(name)} AS source_table", f"CAST({key} AS STRING) AS record_key")
            for name, (rows, key) in tables.items()
        ]
    )
    per_key = keys.groupBy("source_table", "record_key").agg(*exprs("count(1) AS copies"))
    return per_key.groupBy("source_table").agg(*exprs("sum(copies) - count(record_key) AS duplicate_rows"))


def orphans(
    children: Sequence[tuple[str, DataFrame, str, str]], parents: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Child rows whose key has no parent, counted per child table and parent kind.

    ``children`` holds (child name, rows, key column, parent kind).  The child keys
    are counted first, so a key held by many rows meets the anti join as one row.
    """
    keys = union_all(
        [
            rows.selectExpr(f"{literal(name)} AS source_table", f"{literal(kind)} AS parent", f"{key} AS key")
            for name, rows, key, kind in children
        ]
    )
    counted = keys.groupBy("source_table", "parent", "key").agg(*exprs("count(1) AS copies"))
    known = union_all(
        [rows.selectExpr(f"{literal(kind)} AS parent", f"{key} AS key") for kind, (rows, key) in parents.items()]
    )
    return (
        counted.join(known, ["parent", "key"], "left_anti")
        .groupBy("source_table", "parent")
        .agg(*exprs("sum(copies) AS orphan_rows"))
    )


def mismatches(snapshot: DataFrame, key: str, recomputed: Sequence[DataFrame], differs: str) -> DataFrame:
    """Snapshot rows that disagree with what the facts say (one-sided, from the snapshot)."""
    joined = snapshot
    for frame in recomputed:
        joined = joined.join(frame, key, "left")
    return joined.selectExpr("*", f"{differs} AS mismatch")
