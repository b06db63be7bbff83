"""Facts and their aggregates in partitions by date, replaced where a change set touches them.

A change set names keys and brings the rows these keys have now; a key without a row is gone.  The partitions that held a
changed key, or will hold one, are written anew beside the tables with all that depends on them; then they take their
places by dynamic partition overwrite.  A journal tells a run that breaks in between how to go on.
Aggregates that cross partitions are kept as partials per partition, exact and mergeable.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import measures as m
from cartwright.operators.relations import with_share
from cartwright.plans import activity
from cartwright.sources import folders
from cartwright.sources.store import ParquetStore

PART = "part"
#: Format of the partition names: days by default; a coarser one keeps small data in fewer files.
DAY, MONTH = "yyyy-MM-dd", "yyyy-MM"
SKETCH_BITS = 12
#: Standard error of a sketch with 2^12 registers, as published for HyperLogLog: 1.04 / sqrt(registers).
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


@dataclass(frozen=True)
class Dependent:
    """A table that follows from one partition of a fact alone."""

    name: str
    build: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PartitionedFact:
    name: str
    key: str
    date: str
    dependents: tuple[Dependent, ...]


def _customer_sketches(fact_order: DataFrame) -> DataFrame:
    """Mergeable approximate customer sets per (day, status), for distinct counts over any span of days."""
    sketch = F.hll_sketch_agg("user_id", SKETCH_BITS).alias("customers")
    return fact_order.groupBy("order_date", "status_code").agg(sketch)


ORDERS = PartitionedFact(
    "fact_order", "order_id", "order_date",
    (
        Dependent("daily_commerce", activity.daily_commerce),
        Dependent(
            "order_status_partials",
            lambda rows: m.partials(rows, ["order_date", *activity.STATUS_KEYS], activity.ENTITY, activity.STATUS),
        ),
        Dependent("customer_sketches", _customer_sketches),
    ),
)
BEHAVIORS = PartitionedFact(
    "fact_behavior", "behavior_id", "behavior_date",
    (
        Dependent(
            "hourly_behavior_partials",
            lambda rows: m.partials(rows, ["behavior_date", "behavior_hour"], activity.ENTITY, activity.HOURLY),
        ),
    ),
)


def _parts_of(rows: DataFrame) -> list[str]:
    return sorted(row[PART] for row in rows.select(PART).distinct().toLocalIterator())


class PartitionedLayers:
    """Partitioned tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, grain: str = DAY) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.grain = grain

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def _journal(self) -> str:
        return f"{self.root}/pending.json"

    def exists(self, name: str) -> bool:
        return folders.exists(self.spark, self._path(name))

    def read(self, name: str) -> DataFrame:
        """A table with its partition column."""
        return self.spark.read.option("basePath", self._path(name)).option("mergeSchema", False).schema(self._schema(name)).parquet(self._path(name))

    def _schema(self, name: str) -> str:
        return json.loads(folders.read_text(self.spark, f"{self.root}/{name}.schema.json"))["ddl"]

    def _parted(self, rows: DataFrame, date: str) -> DataFrame:
        return rows.withColumn(PART, F.date_format(date, self.grain))

    def apply(self, fact: PartitionedFact, change: str, rows: DataFrame, keys: DataFrame) -> list[str]:
        """Bring in a change set; returns the partitions replaced.

        ``rows`` are whole fact rows, ``keys`` has the fact's key column with every key the change set speaks of, those of
        ``rows`` too.  A change set that was applied before changes nothing when it is applied again.  The list of
        partitions goes through the driver: it is as long as the calendar, whatever the number of rows.
        """
        self.recover()
        staging = ParquetStore(self.spark, f"{self.root}/pending-{change}")
        parted = self._parted(rows, fact.date)

        def dealt(rows: DataFrame) -> DataFrame:
            # Splits a partition that holds a large share of the rows, and does not scatter a small one over all tasks.
            return staging.keep(fact.name, rows.hint("rebalance", PART), partition_by=PART)

        if self.exists(fact.name):
            keys, changed = staging.keep("keys", keys.select(fact.key).distinct()), staging.keep("rows", parted)
            # Two columns of the fact are read here, and whole rows below of the touched partitions only.
            held = self.read(fact.name).select(fact.key, PART).join(keys, fact.key, "left_semi")
            parts = _parts_of(changed.select(PART).union(held.select(PART)))
            if parts:
                kept = self.read(fact.name).filter(F.col(PART).isin(parts)).join(keys, fact.key, "left_anti")
                whole = dealt(kept.unionByName(changed))
        else:
            # Nothing is held yet: the rows are written once, and no key is looked up.
            whole = dealt(parted)
            parts = _parts_of(whole)
        if parts:
            tables = {fact.name: whole.schema}
            for dependent in fact.dependents:
                made = self._parted(dependent.build(whole.drop(PART)), fact.date)
                tables[dependent.name] = staging.keep(dependent.name, made.hint("rebalance", PART), partition_by=PART).schema
            ddl = {name: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) for name, schema in tables.items()}
            folders.replace_text(self.spark, self._journal, json.dumps({"change": change, "parts": parts, "tables": ddl}))
            self.recover()
        else:
            folders.remove_folder(self.spark, staging.root)
        return parts

    def recover(self) -> None:
        """Finish a replacement that was begun: its partitions are whole in the staging folder, so this can be repeated."""
        if not folders.exists(self.spark, self._journal):
            return
        pending = json.loads(folders.read_text(self.spark, self._journal))
        staging = f"{self.root}/pending-{pending['change']}"
        for name, ddl in pending["tables"].items():
            folders.replace_text(self.spark, f"{self.root}/{name}.schema.json", json.dumps({"ddl": ddl}))
            self._replace(name, self.spark.read.schema(ddl).parquet(f"{staging}/{name}"), pending["parts"])
        folders.remove_folder(self.spark, self._journal)
        folders.remove_folder(self.spark, staging)

    def _replace(self, name: str, rows: DataFrame, parts: list[str]) -> None:
        # The staged files are dealt by partition already, so they are written on without another shuffle.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(self._path(name))
        # Dynamic overwrite leaves alone what it has no rows for; a partition that lost all its rows goes.
        left = set(_parts_of(rows))
        for part in parts:
            if part not in left:
                folders.remove_folder(self.spark, f"{self._path(name)}/{PART}={part}")

    # --- reports over all partitions -----------------------------------------------------------

    def daily_commerce(self) -> DataFrame:
        return self.read("daily_commerce").drop(PART)

    def order_status_summary(self) -> DataFrame:
        keys = activity.STATUS_KEYS
        per_user = m.folded(self.read("order_status_partials"), keys, activity.STATUS)
        return with_share(m.merged(per_user, keys, activity.STATUS), "order_count", "order_share")

    def hourly_behavior(self) -> DataFrame:
        per_user = m.folded(self.read("hourly_behavior_partials"), ["behavior_hour"], activity.HOURLY)
        return m.merged(per_user, ["behavior_hour"], activity.HOURLY)

    def approximate_customers(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Distinct customers per status between two dates, from sketches alone, whatever the number of orders.

        The standard error of an estimate is ``SKETCH_ERROR`` of it (1.6 %).
        """
        rows = self.read("customer_sketches")
        for bound, sign in ((first, ">="), (last, "<=")):
            if bound is not None:
                rows = rows.filter(f"order_date {sign} DATE '{bound}'")
        return rows.groupBy("status_code").agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))
