"""Rule-based quarantine of raw text rows as they arrive.

Each micro-batch is judged once and written once, divided by verdict, under its batch number; its rejected
rows go on to the quarantine in the unified form.  Both writes replace whatever an earlier attempt at the same batch
left, and a batch counts only once its number is recorded, so a run that broke anywhere can start again from
the checkpoint without losing or repeating a row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwright import contract as c
from cartwright.operators.validation import (
    ACCEPTED,
    ParentLink,
    judge,
    quarantine,
    valid_rows,
    with_parents,
    without_parents,
)
from cartwright.plans.rulebook import LINEAGE, RULEBOOK, raw_contract
from cartwright.sources import csv_files, folders
from cartwright.sources.store import ParquetStore

BATCH = "batch"


@dataclass(frozen=True)
class StreamedTable:
    """One table's stream: where its two sinks and its checkpoint live.

    ``links`` is asked anew for every batch, so that children see the parents that have arrived by then.
    """

    spark: SparkSession
    name: str
    root: str
    run_at: datetime
    ids: c.IdFormats = c.STRICT_IDS
    links: Callable[[], list[ParentLink]] = list

    @property
    def folder(self) -> str:
        return f"{self.root}/{self.name}"

    def _committed(self) -> int:
        path = f"{self.folder}/committed.json"
        return json.loads(folders.read_text(self.spark, path))[BATCH] if folders.exists(self.spark, path) else -1

    def _rules(self):
        return RULEBOOK[self.name](self.ids)

    def _judged(self, rows: DataFrame) -> DataFrame:
        judged, links = judge(raw_contract(rows, self.name), self._rules(), LINEAGE), self.links()
        return with_parents(judged, links) if links else without_parents(judged)

    def _rejected(self, staged: DataFrame) -> DataFrame:
        rows = quarantine({self.name: (staged, self._rules().key)}, LINEAGE)
        return rows.withColumn("quarantined_at", F.lit(self.run_at).cast("timestamp"))

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """Both sinks of one micro-batch, then its commit."""
        if batch <= self._committed():
            return
        part = f"{BATCH}={batch}"
        staged = ParquetStore(self.spark, f"{self.folder}/staged").keep(part, self._judged(rows), partition_by=ACCEPTED)
        ParquetStore(self.spark, f"{self.folder}/quarantine").keep(part, self._rejected(staged))
        folders.replace_text(self.spark, f"{self.folder}/committed.json", json.dumps({BATCH: batch}))

    def start(self, rows: DataFrame) -> StreamingQuery:
        """Judge all that has arrived, batch by batch, and stop."""
        writer = rows.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", f"{self.folder}/checkpoint")
        return writer.trigger(availableNow=True).start()

    def run(self, rows: DataFrame) -> None:
        self.start(rows).awaitTermination()

    def _read(self, sink: str, like: DataFrame) -> DataFrame:
        last, path = self._committed(), f"{self.folder}/{sink}"
        if last < 0:
            return self.spark.createDataFrame([], like.schema)
        schema = T.StructType([*like.schema.fields, T.StructField(BATCH, T.LongType())])
        rows = self.spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{BATCH}=*")
        return rows.filter(F.col(BATCH) <= last).select(*like.columns)

    def _blank(self) -> DataFrame:
        empty = self.spark.createDataFrame([], csv_files.text_schema(c.HEADERS[self.name]))
        return self._judged(empty)

    def staged(self) -> DataFrame:
        """All committed rows with their verdicts."""
        return self._read("staged", self._blank())

    def valid(self) -> DataFrame:
        return valid_rows(self.staged())

    def quarantine(self) -> DataFrame:
        return self._read("quarantine", self._rejected(self._blank()))


def stream_tables(spark: SparkSession, inputs: str, root: str, run_at: datetime, ids: c.IdFormats = c.STRICT_IDS, files_per_batch: int = 1000) -> dict[str, StreamedTable]:
    """Judge the six tables as their files arrive: parents first, then their children side by side.

    ``inputs`` holds a folder of CSV files per table.  Calling it again judges only what has arrived since.  A child is judged
    by the parents known at its batch; a parent that comes later does not call it back from the quarantine.
    """
    tables: dict[str, StreamedTable] = {}

    def user(child_time: str | None = None) -> ParentLink:
        timed = {"parent_time": "registration_ts", "child_time": child_time, "time_code": c.TEMPORAL_REASON} if child_time else {}
        return ParentLink(tables["users"].staged(), "user_id", "broken_user_fk", **timed)

    def product() -> ParentLink:
        return ParentLink(tables["products"].staged(), "product_id", "broken_product_fk")

    links: dict[str, Callable[[], list[ParentLink]]] = {
        "users": list,
        "products": list,
        "orders": lambda: [user("order_ts"), product()],
        "user_behaviors": lambda: [user("behavior_ts"), product()],
        "user_features": lambda: [user()],
        "product_features": lambda: [product()],
    }
    for wave in (("users", "products"), ("orders", "user_behaviors", "user_features", "product_features")):
        running = []
        for name in wave:
            tables[name] = StreamedTable(spark, name, root, run_at, ids, links[name])
            path = f"{inputs}/{csv_files.file_name(name)}"
            rows = csv_files.stream_csv(spark, path, c.HEADERS[name], files_per_batch)
            running.append(tables[name].start(csv_files.with_lineage(rows, csv_files.file_name(name), run_at)))
        for query in running:
            query.awaitTermination()
    return tables
