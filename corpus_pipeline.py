"""A pipeline from raw documents to token ids; each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import byte_bpe, exact_dedup, minhash, mixing, toxicity
from cartwright.llm.common import store_for, table
from cartwright.sources.store import ParquetStore


# A document goes when operator 9 predicts it toxic.
TOXIC_FROM = toxicity.TOXIC_FROM
# Every source is passed once at least and twice at most.
MIXTURE = mixing.Target(repetitions=2.0)


_LEFT: list[ParquetStore] = []


def _stage_store(docs: DataFrame) -> ParquetStore:
    """Layers of one stage.  ``docs`` is a written table by now, so those of the stages before are removed."""
    _clear()
    _LEFT.append(store_for(docs))
    return _LEFT[-1]


def _clear() -> None:
    while _LEFT:
        _LEFT.pop().discard()


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 9 predicts clean; null, empty and very long texts are scored whole like others.

    The model is fitted anew to labelled documents that are not held out.  An empty table stays empty.
    """
    _clear()
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, output="toxicity_of_text").filter(F.col("toxicity_of_text") < TOXIC_FROM).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id; null and empty texts are equal, repeated rows too."""
    return exact_dedup.deduplicate(docs, store=_stage_store(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 over five-word shingles of whole texts; texts without words stay."""
    return minhash.deduplicate(docs, store=_stage_store(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, small sources up to twice, in blocks of the wanted mixture; texts without tokens come once."""
    return mixing.mix(docs, MIXTURE, store=_stage_store(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text (null: none) and whether they decode to it."""
    _clear()
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    same = F.col("decoded_bytes") == F.coalesce("text", F.lit("")).cast("binary")
    return rows.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", same.alias("decodes_to_text"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", encode_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written, and all but the last one's removed once the next is."""
    docs = table(spark, sf_dir, "documents")
    store = store_for(docs)
    for position, (_, stage) in enumerate(STAGES):
        docs = store.keep(f"stage-{position}", stage(spark, docs, sf_dir))
        if position:
            store.discard(keep=(f"stage-{position}",))
    _clear()
    return docs
