"""Token ids as files with random access.

    <root>/dictionary   one row: zstandard dictionary and its hash
    <root>/blocks       one file per shard, rows in ascending key order.  A row is a block: the keys of
                        its documents, their numbers of ids, the end of each document's frame in the
                        payload, the dictionary's hash, and the payload: one zstandard frame per document
    <root>/shards       one row per shard: key range, documents, ids, and ids of all shards before

Every document is compressed on its own against the shared dictionary, so a short one is read by
slicing its frame.  The container is Parquet, whose commit survives lost executors and whose
statistics find blocks by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.common import col, ship, slices, use_cache, vocabulary_bytes
from cartwright.llm.word_bpe import library_encoder

DICTIONARY_BYTES, DICTIONARY_DOCS, DICTIONARY_TEXT_BYTES = 64 << 10, 1000, 16 << 10
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20
LEVEL = 3

_BLOCKS = (
    "shard int, block int, first_id bigint, last_id bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "frame_ends array<bigint>, tokens_before bigint, width int, dictionary_hash bigint, payload binary"
)


# --- frames -----------------------------------------------------------------------------------


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from serialized id arrays; of too few samples their content, of none the empty one."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary_hash(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content) >> 1


@lru_cache(maxsize=4)
def _codecs(content: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    shared = zstandard.ZstdCompressionDict(content) if content else None
    if shared is not None:
        shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def serialized(ids: bytes, width: int) -> bytes:
    """Unsigned 32-bit ids in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def restored(content: bytes, width: int) -> bytes:
    return content if width == 4 else np.frombuffer(content, "<u2").astype("<u4").tobytes()


# --- writing ----------------------------------------------------------------------------------


def _sample(rows: DataFrame, file, width_of) -> list[bytes]:
    """Serialized ids of at most DICTIONARY_DOCS documents of at most DICTIONARY_TEXT_BYTES, drawn by hash."""
    short = rows.filter(F.octet_length("row_text").between(1, DICTIONARY_TEXT_BYTES))
    drawn = short.orderBy(F.xxhash64("row_key"), "row_key").limit(DICTIONARY_DOCS).select("row_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("library_encoder")
        encoder = library_encoder(file.value)
        for batch in batches:
            ids = encoder.encode_all(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([serialized(i, width_of(encoder)) for i in ids], pa.binary())], ["ids"])

    return [bytes(row["ids"]) for row in drawn.mapInArrow(run, "ids binary").collect()]


def _width(encoder) -> int:
    return 2 if encoder.vocabulary_size <= 1 << 16 else 4


def write(docs: DataFrame, root: str, vocabulary_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, append ``end_id`` to each, and write them in ascending key order.

    Null and empty texts hold the end id alone; a text of any length is one frame.  Null keys come first; rows of equal keys follow each
    other, by text hash.  Other columns are not written.  An empty table gives empty files.
    """
    spark = ship(docs.sparkSession)
    file = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary_path))
    rows = docs.select(col(key).cast("bigint").alias("row_key"), F.coalesce(col(text).cast("string"), F.lit("")).alias("row_text"))
    content = train_dictionary(_sample(rows, file, _width))
    mark = dictionary_hash(content)
    spark.createDataFrame([(mark, bytearray(content))], "dictionary_hash bigint, content binary").coalesce(1).write.parquet(f"{root}/dictionary")
    shared = spark.sparkContext.broadcast(content)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("library_encoder")
        encoder = library_encoder(file.value)
        compress = _codecs(shared.value)[0].compress
        width = _width(encoder)
        if end_id >= 1 << (8 * width):
            width = 4
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        keys, counts, ends, payload = [], [], [], bytearray()

        def closed() -> pa.RecordBatch:
            values = [[shard], [block], [keys[0]], [keys[-1]], [keys], [counts], [ends], [before], [width], [mark], [bytes(payload)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _ARROW)], _NAMES)

        for batch in batches:
            for part in slices(batch, "row_text"):
                for row_key, ids in zip(part.column(0).to_pylist(), encoder.encode_all(part.column(1).to_pylist())):
                    payload += compress(serialized(ids + end, width))
                    keys.append(row_key)
                    counts.append(len(ids) // 4 + 1)
                    ends.append(len(payload))
                    if len(keys) == BLOCK_DOCS or len(payload) >= BLOCK_BYTES:
                        yield closed()
                        block, before = block + 1, before + sum(counts)
                        keys, counts, ends, payload = [], [], [], bytearray()
        if keys:
            yield closed()

    shards = max(1, docs.rdd.getNumPartitions())
    ordered = rows.withColumn("tie", F.xxhash64("row_text")).repartitionByRange(shards, "row_key", "tie")
    ordered = ordered.sortWithinPartitions("row_key", "tie").select("row_key", "row_text")
    ordered.mapInArrow(run, _BLOCKS).write.parquet(f"{root}/blocks")

    blocks = spark.read.schema(_BLOCKS).parquet(f"{root}/blocks")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda total, n: total + n)
    totals = blocks.groupBy("shard").agg(
        F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.sum(F.size("doc_ids")).alias("documents"), F.sum(tokens).alias("tokens")
    )
    # One row per shard, so one window holds them all.
    earlier = F.sum("tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    totals.withColumn("shard_start", F.coalesce(earlier, F.lit(0))).coalesce(1).write.parquet(f"{root}/shards")


_NAMES = [field.split()[0] for field in _BLOCKS.split(", ")]
_ARROW = [
    {"int": pa.int32(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary()}[field.split()[1]]
    for field in _BLOCKS.split(", ")
]


# --- reading ----------------------------------------------------------------------------------


def read(spark: SparkSession, root: str, keys: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, token_ids`` of all documents, or of ``keys`` only, whose blocks are found by
    their ranges and whose frames alone are decompressed.

    ``token_ids`` are little-endian unsigned 32-bit integers; ``start`` counts the ids before in key order.
    """
    ship(spark)
    stored = spark.read.parquet(f"{root}/dictionary").first()
    content, mark = bytes(stored["content"]), stored["dictionary_hash"]
    if dictionary_hash(content) != mark:
        raise ValueError("the dictionary is damaged")
    shared = spark.sparkContext.broadcast(content)
    starts = spark.read.parquet(f"{root}/shards").select("shard", "shard_start")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{root}/blocks")
    wanted = None if keys is None else frozenset(keys)
    if keys is not None:
        inside = [F.lit(key).between(F.col("first_id"), F.col("last_id")) for key in keys]
        found = inside[0] if inside else F.lit(False)
        for condition in inside[1:]:
            found = found | condition
        blocks = blocks.filter(found)
    # A row per shard: as small as the number of files.
    placed = blocks.join(F.broadcast(starts), "shard").select(
        "doc_ids", "n_tokens", "frame_ends", (F.col("shard_start") + F.col("tokens_before")).alias("start"), "width", "dictionary_hash", "payload"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = _codecs(shared.value)[1].decompress
        for batch in batches:
            for at in range(batch.num_rows):
                ids, counts, ends, start, width, used, payload = (c[0].as_py() for c in batch.slice(at, 1).columns)
                if used != mark:
                    raise ValueError("a block was written with another dictionary")
                begin, out = 0, []
                for key, count, end in zip(ids, counts, ends):
                    if wanted is None or key in wanted:
                        out.append((key, start, count, restored(decompress(payload[begin:end]), width)))
                    begin, start = end, start + count
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "token_ids"])

    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, token_ids binary")
