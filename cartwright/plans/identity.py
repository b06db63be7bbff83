"""What a release has run, as digests: one per layer, over its analyzed plan from raw text on."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from cartwright import contract as c
from cartwright.plans import quality
from cartwright.plans.warehouse import Warehouse
from cartwright.sources import catalog, csv_files

_FIELDS, _WIDE = "spark.sql.debug.maxToStringFields", str(2**31 - 1)


def plan_digest(rows: DataFrame) -> str:
    """SHA-256 of the analyzed plan, with expression ids numbered in the order in which they appear.

    The same statements over the same columns give the same digest in every session; input
    paths, row counts and settings do not enter.
    """
    spark = rows.sparkSession
    before = spark.conf.get(_FIELDS, None)
    spark.conf.set(_FIELDS, _WIDE)  # No column is left out of the text.
    try:
        text = rows._jdf.queryExecution().analyzed().treeString()
    finally:
        spark.conf.unset(_FIELDS) if before is None else spark.conf.set(_FIELDS, before)
    numbers: dict[str, str] = {}
    text = re.sub(r"#(\d+)L?", lambda m: "#" + numbers.setdefault(m.group(1), str(len(numbers))), text)
    # Scalar subqueries are named by ids of their own, relations by where they came from.
    text = re.sub(r"\b(scalar-subquery|exists|list)#\d+", r"\1", text)
    text = re.sub(r"\bplan_id=\d+", "", text)
    return hashlib.sha256(text.encode()).hexdigest()


def empty_sources(spark: SparkSession) -> dict[str, DataFrame]:
    """The six tables without rows: enough to plan every layer."""
    return {name: spark.createDataFrame([], csv_files.text_schema(headers)) for name, headers in c.HEADERS.items()}


def planned_layers(spark: SparkSession, ids: c.IdFormats) -> dict[str, DataFrame]:
    """All published layers as plans over empty tables."""
    w = Warehouse(spark, empty_sources(spark), ids, planned_only=True)
    health = quality.quality_checks(quality.measurement(w))
    return catalog.layers(w, health)


def layer_digests(spark: SparkSession, ids: c.IdFormats = c.STRICT_IDS) -> dict[str, str]:
    """Digest of the statements behind each published layer, and of all of them together."""
    digests = {name: plan_digest(rows) for name, rows in planned_layers(spark, ids).items()}
    together = "".join(f"{name}\n{digest}\n" for name, digest in digests.items())
    return {**digests, "bundle": hashlib.sha256(together.encode()).hexdigest()}
