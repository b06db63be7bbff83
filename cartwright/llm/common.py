"""What the corpus operators share: shipping code to workers, layers, tables, names."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.sources.store import ParquetStore, scratch_store

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable by Python workers, once per application.

    Functions are then pickled by name, and a worker that is used again keeps what a
    module has cached.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="cartwright-code-")) / "cartwright_code.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for source in sorted(root.rglob("*.py")):
                packed.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)
    return spark


# Rows go to Python in batches of so many bytes, and not of 10,000 rows whatever their texts measure: the JVM's
# buffer for a batch doubles as it grows, and a worker holds the whole batch while it works on slices of it.
BATCH_BYTES = "8m"
_BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches from here on in this session, unless its user has set a bound."""
    if spark.conf.get(_BATCH_BYTES_SETTING, None) is None:
        spark.conf.set(_BATCH_BYTES_SETTING, BATCH_BYTES)


_CACHES: dict[str, Callable[[], object]] = {}


def keeps_cache(owner: str, clear: Callable[[], object]) -> None:
    """Say how to drop what an operator has cached in a Python worker."""
    _CACHES[owner] = clear


def use_cache(owner: str) -> None:
    """At the start of a task: what other operators have left in this worker goes, so that caches do not add up."""
    for other, clear in _CACHES.items():
        if other != owner:
            clear()
    # What is free goes back to the system; a worker that is used again would hold it beside the next operator's.
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store_for(rows: DataFrame) -> ParquetStore:
    return scratch_store(rows.sparkSession)


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name beside the caller's own; Spark compares names without case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have about ``limit`` bytes; a longer text is a slice alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start, total = 0, 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def vocabulary_bytes(path: str) -> bytes:
    """A vocabulary file, read once on the driver; it has a fixed size, a few MB."""
    return Path(path).read_bytes()
