"""Encoders and counters against the public libraries."""

import base64
import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from awkward import AWKWARD, clashing, documents
from tokenizers import Tokenizer

from cartwright.llm import byte_bpe, token_files, word_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "​", "　", "a", "The", "É", "Ω", "Σ", "ΟΔΟΣ", "'s", "'S", "1", "23", "²",
    "!", "..", "漢", "🙂", "́", "̱", "H", "e", "_", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "\x00", "﻿", "ß", "İ", "K", "ﬁ", "가",
]


def mixtures(count, seed):
    random.seed(seed)
    return ["".join(random.choice(PARTS) for _ in range(random.randint(0, 12))) for _ in range(count)]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_codec_equals_the_public_encoder(reference):
    codec = byte_bpe.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    for text in mixtures(4000, 1) + [t for _, t, _ in AWKWARD if t]:
        [ids] = codec.encode_all([text])
        assert ids == packed(reference.encode_ordinary(text)), text
        assert codec.decode(ids) == text.encode()


def test_codec_cuts_long_texts_without_a_trace(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 7)
    codec = byte_bpe.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    for text in mixtures(1500, 2):
        assert codec.encode_all([text]) == [packed(reference.encode_ordinary(text))], text


def test_codec_with_another_pattern_and_small_caches(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_CHUNKS", 3)
    codec = byte_bpe.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN + "|$^")
    for text in mixtures(500, 3):
        assert codec.encode_all([text]) == [packed(reference.encode_ordinary(text))], text


def test_encode_and_decode_rows(spark, reference):
    rows = byte_bpe.decode(byte_bpe.encode(clashing(documents(spark)), RANKS, decoded=True), RANKS).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        text = row["text"] or ""
        assert bytes(row["token_ids"]) == packed(reference.encode_ordinary(text))
        assert row["n_tokens"] == len(row["token_ids"]) // 4
        assert bytes(row["decoded_bytes"]) == text.encode()
    assert byte_bpe.encode(documents(spark).limit(0), RANKS).collect() == []


def test_a_kept_text_is_sent_to_python_once(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame([(1, "One text"), (2, None)], "doc_id bigint, text string")
    rows = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    assert "text_to_encode" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["doc_id"], r["text"], bytes(r["decoded_bytes"])) for r in rows.orderBy("doc_id").collect()] == [(1, "One text", b"One text"), (2, None, b"")]


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    def measured(batches):
        import pyarrow as pa

        return (pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"]) for batch in batches)

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    docs = spark.range(64, numPartitions=1).selectExpr("id AS doc_id", "concat(repeat('word ', 100000), id) AS text")
    try:
        assert byte_bpe.encode(docs, RANKS).selectExpr("count(*)", "min(n_tokens) > 100000").first()[:] == (64, True)
        sizes = [r["n"] for r in docs.mapInArrow(measured, "n bigint").collect()]
        assert len(sizes) > 1 and max(sizes) < 10_000_000
        spark.conf.set(setting, "1m")
        byte_bpe.encode(docs, RANKS)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.unset(setting)


def test_query_digests(spark, reference, tmp_path):
    from cartwright.llm.registry import QUERIES

    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op1_byte_bpe"](spark, str(tmp_path)).collect()
    expected = sorted(
        (d or -1, hashlib.sha256(packed(reference.encode_ordinary(t or ""))).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for d, t, _ in AWKWARD
    )
    assert sorted((r["doc_id"] or -1, r["ids_sha256"], r["decoded_sha256"]) for r in rows) == expected


def test_counter_and_encoder_equal_the_library(library):
    file = open(WORDS, "rb").read()
    counter, encoder = word_bpe.TokenCounter(file), word_bpe.LibraryEncoder(file)
    for text in mixtures(6000, 4) + [t for _, t, _ in AWKWARD if t]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids), text
        assert encoder.encode(text) == packed(ids), text


def test_words_and_the_marks_after_them_are_learned_apart(library):
    """One entry for a word, whatever marks follow it; runs of marks, contractions and figures are read as the library reads them."""
    encoder = word_bpe.LibraryEncoder(open(WORDS, "rb").read())
    words = [f"{a}{b}{c}" for a in ("tha", "ó", "Über") for b in ("nd", "ñe", "ss") for c in ("ly", "É", "r")]
    text = " ".join(f"{word}{mark}" for word in words for mark in ("", ",", ".", "?!", ").", ";\n"))
    assert encoder.encode(text) == packed(library.encode(text, add_special_tokens=False).ids)
    assert len(encoder._chunks) <= len(words) + 10
    for odd in ("it's. we'll, a.b.c 3.5, x1. e%20f d*)( $a$ ª. µ, ß!ß ÿ.\u00a0, ×, n.\xad.", "o'clock.'s, 'd.'d ..a.. \u0085a,\u0085", "a,\tb.\r\nc;\x0bd:\x0c"):
        assert encoder.encode(odd) == packed(library.encode(odd, add_special_tokens=False).ids), odd


def test_small_caches_and_segments(library, monkeypatch):
    for name in ("CACHED_CHUNKS", "CACHED_WORDS", "ENCODED_CHUNKS", "SEGMENT_CHARS"):
        monkeypatch.setattr(word_bpe, name, 4)
    file = open(WORDS, "rb").read()
    counter, encoder = word_bpe.TokenCounter(file), word_bpe.LibraryEncoder(file)
    for text in mixtures(1500, 5):
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids), text
        assert encoder.encode(text) == packed(ids), text


def test_merges_take_the_lowest_rank_leftmost_first():
    ranks = {("a", "a"): (0, "aa"), ("aa", "b"): (1, "aab"), ("b", "c"): (2, "bc")}
    assert word_bpe.merged_symbols(list("aaab"), ranks) == 3  # aa a b
    assert word_bpe.merged_symbols(list("aabc"), ranks) == 2  # aab c
    assert word_bpe.merged_symbols([], ranks) == 0
    assert word_bpe.merged_symbols(["a"], ranks) == 1


def test_counts_of_rows(spark, library):
    rows = word_bpe.count_tokens(clashing(documents(spark)), WORDS).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert (row["n_tokens"], row["n_bytes"], row["over_limit"]) == (len(ids), len((row["text"] or "").encode()), len(ids) > 2048)
    assert word_bpe.count_tokens(documents(spark).limit(0), WORDS).collect() == []


def test_token_files(spark, library, folder):
    root = f"{folder}/files"
    token_files.write(clashing(documents(spark)), root, WORDS, 2)
    rows = token_files.read(spark, root).collect()
    assert len(rows) == len(AWKWARD)
    rows.sort(key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    start = 0
    for row in rows:
        assert row["start"] == start
        assert row["n_tokens"] == len(row["token_ids"]) // 4
        start += row["n_tokens"]
    found = sorted((r["doc_id"] or -1, zlib.crc32(r["token_ids"])) for r in rows)
    assert found == sorted((d or -1, zlib.crc32(packed([*library.encode(t or "", add_special_tokens=False).ids, 2]))) for d, t, _ in AWKWARD)
    some = token_files.read(spark, root, [6, 7, 99]).collect()
    assert sorted((r["doc_id"], r["start"]) for r in some) == sorted((r["doc_id"], r["start"]) for r in rows if r["doc_id"] in (6, 7))
    assert token_files.read(spark, root, []).collect() == []


def test_token_files_of_nothing(spark, folder):
    token_files.write(documents(spark).limit(0), f"{folder}/none", WORDS, 2)
    assert token_files.read(spark, f"{folder}/none").collect() == []


def test_token_files_know_their_dictionary(spark, folder):
    root = f"{folder}/swapped"
    token_files.write(documents(spark), root, WORDS, 2)
    stored = spark.read.parquet(f"{root}/dictionary").first()
    other = spark.createDataFrame([(stored["dictionary_hash"], bytearray(b"other"))], "dictionary_hash bigint, content binary")
    other.write.mode("overwrite").parquet(f"{root}/dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        token_files.read(spark, root)
