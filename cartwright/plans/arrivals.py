"""How the given tables would arrive in pieces: files of text, event files, and change sets of facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contract as c
from cartwright.plans import incremental
from cartwright.session import give_back
from cartwright.sources import csv_files
from cartwright.sources.store import ParquetStore
from cartwright.streaming.hourly import HourlyStream

# Days of an event file; the share of rows that comes one file late; the delay that is waited for.
DAYS_PER_FILE, LATE_EVERY, LAST_FILE, DELAY = 8, 23, 3, "6 hours"
# In every third month: keys that come with the second change set only, keys it corrects, keys it takes back.
MONTHS, NEW, CORRECTED, WITHDRAWN = 3, (7, 3), (11, 5), (101, 7)


def write_text_files(sources: Mapping[str, DataFrame], folder: str, files: int | None = None) -> None:
    """Every raw table as a folder of CSV files, so many if a number is given, one table after the other."""
    for name, headers in c.HEADERS.items():
        rows = sources[name].select(*[f"`{h}`" for h in headers])
        rows = rows.repartition(files) if files else rows
        rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{csv_files.file_name(name)}")
        give_back(rows.sparkSession)


def _number(key: str) -> str:
    return f"CAST(substr({key}, 2) AS BIGINT)"


def hourly_stream(spark: SparkSession, fact_behavior: DataFrame, root: str) -> HourlyStream:
    """Event files in the order of their days, some rows in the next file, streamed one after the other."""
    late = f"IF({_number('behavior_id')} % {LATE_EVERY} = 0, 1, 0)"
    arrival = f"least({LAST_FILE}, (day(behavior_ts) - 1) DIV {DAYS_PER_FILE} + {late})"
    inputs = ParquetStore(spark, f"{root}/events")
    events = fact_behavior.select("behavior_id", "user_id", "behavior_code", "behavior_ts", "duration_seconds", F.expr(arrival).alias("arrival"))
    events = ParquetStore(spark, root).keep("by-arrival", events, partition_by="arrival")
    stream = HourlyStream(spark, inputs.root, f"{root}/hourly", DELAY)
    for number in range(LAST_FILE + 1):
        inputs.keep(f"arrival={number}", events.filter(F.col("arrival") == number).drop("arrival"))
        stream.advance()
    return stream


@dataclass(frozen=True)
class ChangeSets:
    """A fact as it was at first, and what then changed."""

    first: DataFrame
    second: DataFrame
    second_keys: DataFrame


def change_sets(rows: DataFrame, fact: incremental.PartitionedFact) -> ChangeSets:
    """The given rows as the outcome of two change sets: the first lacks some keys, dates others a day early and has some too many."""
    number, month = _number(fact.key), f"month({fact.date}) % {MONTHS} = 0"

    def chosen(rule: tuple[int, int]) -> str:
        return f"({month} AND {number} % {rule[0]} = {rule[1]})"

    early = f"IF({chosen(CORRECTED)}, date_sub({fact.date}, 1), {fact.date})"
    before = rows.filter(f"NOT {chosen(NEW)}").withColumn(fact.date, F.expr(early))
    extra = rows.filter(chosen(WITHDRAWN)).withColumn(fact.key, F.concat(F.lit("X"), F.col(fact.key)))
    after = rows.filter(f"{chosen(NEW)} OR {chosen(CORRECTED)}")
    return ChangeSets(before.unionByName(extra), after, after.select(fact.key).union(extra.select(fact.key)))


def replaced_layers(spark: SparkSession, facts: Mapping[incremental.PartitionedFact, DataFrame], root: str) -> incremental.PartitionedLayers:
    """Partitioned layers after both change sets of each fact."""
    layers = incremental.PartitionedLayers(spark, root, incremental.MONTH)
    given = ParquetStore(spark, f"{root}/given")
    for fact, rows in facts.items():
        # Both change sets are made of the same rows.
        sets = change_sets(given.keep(fact.name, rows), fact)
        layers.apply(fact, f"{fact.name}-1", sets.first, sets.first.select(fact.key))
        layers.apply(fact, f"{fact.name}-2", sets.second, sets.second_keys)
        given.discard()
    return layers
