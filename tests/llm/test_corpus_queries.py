"""Registered corpus queries: SQL twins over whole tables, and the pipeline."""

from collections import Counter
from pathlib import Path

import pytest
from awkward import AWKWARD, clashing, documents
from comparing import compare, oracle
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cartwright.llm import byte_bpe, registry, toxicity
from cartwright.sources.store import shared_folder


@pytest.fixture(scope="module")
def database():
    return oracle(SMALL)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, database, name):
    assert compare(spark, database, SMALL, registry.QUERIES[name], registry.SQL[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def test_columns_of_contracts(spark):
    expected = {
        "op1_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        "op3_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op5_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
        "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op7_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
        "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op10_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
        "op12_main_text": "page_id bigint, url string, text string, n_chars bigint",
    }
    for name, columns in expected.items():
        assert ", ".join(f"{c} {t}" for c, t in registry.QUERIES[name](spark, SMALL).dtypes) == columns


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        docs = docs.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else docs.cache()
        counts.append(docs.count())
    toxic, exact, near, mixed = counts[1:]
    assert counts[0] >= toxic > exact > near
    assert near <= mixed <= 2 * near
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(ids) == near
    last = corpus_pipeline.run(spark, SMALL)
    found = Counter(r["doc_id"] for r in last.select("doc_id").collect())
    assert found == Counter(r["doc_id"] for r in docs.select("doc_id").collect())


def test_a_run_leaves_one_stage_behind(spark):
    """Layers of the stages go with the stage after them."""
    shared = Path(shared_folder(spark))
    before = set(shared.rglob("*.parquet"))
    last = corpus_pipeline.run(spark, SMALL)
    left = {path.relative_to(shared).parts[1] for path in set(shared.rglob("*.parquet")) - before}
    assert left <= {"stage-4"} | {name for name in left if name.startswith("model")} and last.count() > 0


def test_toxicity_stage_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").selectExpr("toxic", f"toxicity >= {corpus_pipeline.TOXIC_FROM} AS gone").toPandas()
    assert rows[rows.toxic == 0].gone.mean() < 0.005
    assert rows[rows.toxic == 1].gone.mean() > 0.85


def test_toxicity_stage_removes_what_op9_predicts(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = registry.op9_toxicity(spark, folder).join(labels, "doc_id", "left").select("doc_id", "held_out", "predicted", "toxic").toPandas()
    kept = Counter(r["doc_id"] for r in corpus_pipeline.toxicity_stage(spark, docs, folder).select("doc_id").collect())
    assert kept == Counter(judged[judged.predicted == 0].doc_id)
    toxic = judged[judged.held_out & (judged.toxic == 1)]
    assert len(toxic) > 50
    assert (~toxic.doc_id.isin(kept)).mean() > 0.9


def test_last_stage_decodes_what_it_encoded(spark, monkeypatch):
    docs = clashing(documents(spark)).selectExpr("*", "'xx' AS lang", "1 AS n_chars")
    rows = corpus_pipeline.encode_stage(spark, docs, SMALL).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["decodes_to_text"] is True for r in rows)
    encode = byte_bpe.encode
    monkeypatch.setattr(byte_bpe, "encode", lambda *a, **b: encode(*a, **b).withColumn("text", F.concat("text", F.lit("?"))))
    spoilt = corpus_pipeline.encode_stage(spark, docs, SMALL).filter("n_tokens > 0").collect()
    assert spoilt and not any(r["decodes_to_text"] for r in spoilt)
