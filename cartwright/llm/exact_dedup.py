"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

Frequent digests are found by the frequent-element counters of ``freqItems`` (Misra and Gries'
algorithm in the form of Karp, Shenker and Papadimitriou): at most ``1 / support`` candidates.
They are counted again exactly; these winners are broadcast, so that the rows of large groups of
copies are decided where they lie.  All other digests are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import col, free_name, store_for
from cartwright.sources.store import ParquetStore

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# At most a thousand frequent digests are broadcast, whatever the size of the corpus.
SUPPORT = 0.001


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only.  Where all characters are one byte, ``lower`` does the same, faster."""
    one_byte = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, null as the empty text."""
    return F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), 256)


def decide(
    docs: DataFrame, store: ParquetStore, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), support: float = SUPPORT
) -> tuple[DataFrame, str]:
    """Every row with ``keep_id, group_size, kept, text_sha256``, and the name of its row number.

    Of rows with equal normalised texts the one with the largest key stays; null keys are smaller than
    all others, and of repeated keys the last row stays, so that one row of a group stays always.
    ``carry`` columns are handed through.
    """
    row = free_name("row_number", list(carry))
    rows = store.keep(
        "digests",
        docs.select(
            *[col(name) for name in carry],
            F.monotonically_increasing_id().alias(row),
            col(key).alias(free_name("row_key", [*carry, row])),
            F.unhex(text_digest(col(text))).alias(free_name("digest", [*carry, row])),
        ),
    )
    row_key, digest = rows.columns[-2], rows.columns[-1]
    winner, size = free_name("winner", rows.columns), free_name("rows_of_group", rows.columns)

    def groups(of: DataFrame) -> DataFrame:
        return of.groupBy(digest).agg(F.max(F.struct(row_key, row)).alias(winner), F.count(F.lit(1)).alias(size))

    narrow = rows.select(digest, row_key, row)
    candidates = narrow.select(digest).stat.freqItems([digest], support).select(F.explode(f"{digest}_freqItems").alias(digest))
    verified = store.keep("winners", groups(narrow.join(F.broadcast(candidates), digest, "left_semi")).coalesce(1))
    frequent = F.broadcast(verified)
    apart = rows.join(frequent, digest)
    others = rows.join(frequent.select(digest), digest, "left_anti")
    rest = others.join(groups(others.select(digest, row_key, row)), digest)

    def decided(part: DataFrame) -> DataFrame:
        return part.select(
            *[col(name) for name in carry],
            row,
            F.col(winner)[row_key].alias("keep_id"),
            F.col(size).alias("group_size"),
            (F.col(winner)[row] == F.col(row)).alias("kept"),
            F.lower(F.hex(digest)).alias("text_sha256"),
        )

    return decided(apart).unionByName(decided(rest)), row


def decisions(docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``<key>, keep_id, group_size, kept, text_sha256``.

    Null and empty texts are equal; texts of any length enter whole.  An empty table gives an empty result; other columns are not read.
    """
    rows, _ = decide(docs.select(col(key), col(text)), store_for(docs), key, text, (key,), support)
    return rows.select(col(key), "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = SUPPORT, store: ParquetStore | None = None
) -> DataFrame:
    """The rows that stay, with all their columns and nothing else.

    Whole texts are compared by their SHA-256, however long; the result reads from ``store`` until it is written.

    The rows are written once with a row number.  Dropped row numbers are written too; Spark broadcasts
    them where the written table is below its threshold, and joins by shuffle beyond.
    """
    store = store or store_for(docs)
    row = free_name("stable_row", docs.columns)
    rows = store.keep("rows", docs.withColumn(row, F.monotonically_increasing_id()))
    work = store_for(docs)
    judged, _ = decide(rows.select(col(key), col(text), row), work, key, text, (row,), support)
    dropped = store.keep("dropped", judged.filter(~F.col("kept")).select(row))
    work.discard()
    return rows.join(dropped, row, "left_anti").select(*[col(name) for name in docs.columns])
