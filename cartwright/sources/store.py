"""Where a shared layer lives between the plans that read it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwright.sources.folders import remove_folder


class LazyStore:
    """Keep layers as plans."""

    def keep(self, name: str, rows: DataFrame, partition_by: str | None = None, counts: Mapping[str, str] | None = None) -> DataFrame:
        return rows

    def counted(self, name: str) -> dict[str, Any] | None:
        """Nothing is counted before somebody reads the plan."""
        return None


class ParquetStore:
    """Write a layer to the shared folder and continue from the written table.

    The written table cuts the lineage, survives the loss of executors, and lets each
    reader prune columns and partitions on its own.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._written: set[str] = set()
        self._counted: dict[str, dict[str, Any]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, name: str, rows: DataFrame, partition_by: str | None = None, counts: Mapping[str, str] | None = None) -> DataFrame:
        """Write a layer and read it back; ``counts`` are aggregates taken of its rows on the way.

        They are taken by the tasks that write, each of which counts once however often it is tried.
        """
        schema = rows.schema
        if counts:
            observation = Observation()
            rows = rows.observe(observation, *[F.expr(text).alias(column) for column, text in counts.items()])
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(name))
        self._written.add(name)
        if counts:
            self._counted[name] = observation.get
        # The declared schema keeps the partition column's type without inference.
        back = self.spark.read.schema(schema).parquet(self.path(name))
        return back.select(*schema.names)

    def counted(self, name: str) -> dict[str, Any] | None:
        """What was counted while the layer was written, None if nothing was."""
        return self._counted.get(name)

    def remove(self, names: Iterable[str]) -> None:
        """Remove written layers that nobody will read any more."""
        for name in sorted(self._written.intersection(names)):
            remove_folder(self.spark, self.path(name))
            self._written.discard(name)

    def discard(self, keep: tuple[str, ...] = ()) -> None:
        """Remove all written layers but those in ``keep``."""
        self.remove(self._written.difference(keep))


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is named by ``spark.checkpoint.dir`` or by ``setCheckpointDir``.  Only a local
    master, whose tasks run in the driver's own process, gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="cartwright-")
    return _LOCAL_FOLDERS[application]


def scratch_store(spark: SparkSession) -> ParquetStore:
    return ParquetStore(spark, f"{shared_folder(spark)}/cartwright-{uuid.uuid4().hex}")
