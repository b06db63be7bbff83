"""Behavior per hour of event time, with late rows counted apart.

Rows are folded to (hour, user) and then to the hour by two aggregations with state, so that distinct users need no
set of users per hour; both close an hour once the watermark has passed its end.  A row whose hour had been closed when
it came adds to no hour.  How many those were comes from a second, stateless reading of the same arrivals, which keeps
a count per arrival and hour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwright import contract as c
from cartwright.functions.parsing import exprs, literal
from cartwright.sources.store import ParquetStore

HOUR = "1 hour"
KINDS = tuple(f"{b.behavior_code}_events" for b in c.BEHAVIORS)
EVENT_SCHEMA = "behavior_id string, user_id string, behavior_code string, behavior_ts timestamp, duration_seconds int"


def closed_hours(events: DataFrame, delay: str) -> DataFrame:
    """A streaming plan that emits each hour once, when no row can reach it any more."""
    kinds = [f"count_if(behavior_code = {literal(b.behavior_code)}) AS {kind}" for b, kind in zip(c.BEHAVIORS, KINDS, strict=True)]
    per_user = (
        events.withWatermark("behavior_ts", delay)
        .groupBy(F.window("behavior_ts", HOUR), "user_id")
        .agg(*exprs("count(1) AS behavior_events", *kinds, "sum(duration_seconds) AS duration_seconds"))
    )
    sums = [f"sum({name}) AS {name}" for name in ("behavior_events", *KINDS, "duration_seconds")]
    per_hour = per_user.groupBy(F.window(F.window_time("window"), HOUR)).agg(*exprs("count(user_id) AS active_users", *sums))
    return per_hour.selectExpr("window.start AS hour_start", "behavior_events", "active_users", *KINDS, "duration_seconds")


@dataclass(frozen=True)
class HourlyStream:
    """Event files in ``inputs``; sinks and checkpoints below ``root``; one batch per call of ``advance``."""

    spark: SparkSession
    inputs: str
    root: str
    delay: str

    def _events(self) -> DataFrame:
        return self.spark.readStream.schema(EVENT_SCHEMA).parquet(self.inputs)

    def _start(self, rows: DataFrame, sink: str, mode: str):
        store = ParquetStore(self.spark, f"{self.root}/{sink}")

        def write(batch: DataFrame, number: int) -> None:
            store.keep(f"batch={number}", batch)

        writer = rows.writeStream.outputMode(mode).foreachBatch(write)
        return writer.option("checkpointLocation", f"{self.root}/{sink}-checkpoint").trigger(availableNow=True).start()

    def advance(self) -> None:
        """Take in all files that have arrived since the last call, as one batch."""

        store = ParquetStore(self.spark, f"{self.root}/arrivals")

        def count(batch: DataFrame, number: int) -> None:
            hour = F.window("behavior_ts", HOUR)
            per_hour = batch.groupBy(hour.alias("hour")).agg(*exprs("count(1) AS events", "max(behavior_ts) AS latest"))
            store.keep(f"batch={number}", per_hour.selectExpr("hour.start AS hour_start", "hour.end AS hour_end", "events", "latest"))

        arrivals = self._events().writeStream.foreachBatch(count)
        arrivals = arrivals.option("checkpointLocation", f"{self.root}/arrivals-checkpoint").trigger(availableNow=True).start()
        hours = self._start(closed_hours(self._events(), self.delay), "hours", "append")
        arrivals.awaitTermination()
        hours.awaitTermination()

    def _sink(self, sink: str, schema: str) -> DataFrame:
        path = f"{self.root}/{sink}"
        return self.spark.read.schema(f"{schema}, batch bigint").option("basePath", path).parquet(f"{path}/batch=*")

    def hours(self) -> DataFrame:
        counts = ", ".join(f"{name} bigint" for name in ("behavior_events", "active_users", *KINDS, "duration_seconds"))
        return self._sink("hours", f"hour_start timestamp, {counts}").drop("batch")

    def late(self) -> DataFrame:
        """Rows per hour that came after the hour was closed: its end was not after the latest time of all earlier arrivals, less the delay."""
        arrived = self._sink("arrivals", "hour_start timestamp, hour_end timestamp, events bigint, latest timestamp")
        before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
        # One row per arrival meets in one task.
        marks = arrived.groupBy("batch").agg(F.max("latest").alias("latest"))
        marks = marks.select("batch", (F.max("latest").over(before) - F.expr(f"INTERVAL {self.delay}")).alias("mark"))
        rows = arrived.drop("latest").join(F.broadcast(marks), "batch").filter("hour_end <= mark")
        return rows.groupBy("hour_start").agg(F.sum("events").alias("late_events"))

    def result(self) -> DataFrame:
        """Closed hours beside their late rows; an hour that only late rows would have opened has zeros."""
        zeros = {name: 0 for name in ("behavior_events", "active_users", *KINDS, "duration_seconds", "late_events")}
        return self.hours().join(self.late(), "hour_start", "full").na.fill(zeros)
