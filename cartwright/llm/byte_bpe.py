"""Byte-level BPE encoding and decoding with a sentencepiece model made from rank tables.

The model is written straight from the vocabulary: every token is one piece, its bytes mapped to
printable characters, scored by the negative of its rank, with identity normalisation.
sentencepiece then merges the pair of highest score first, which is the pair of lowest rank.
Decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartwright.llm.common import bound_batches, col, free_name, keeps_cache, ship, slices, use_cache, vocabulary_bytes

# Matches of this pattern never hold white space after other text, so a text may be cut there.
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEGMENT_CHARS = 1 << 20
# Words that are kept; of the chunks made of them half as many, as words spare the most work.
CACHED_CHUNKS = 120_000
# Bytes of text that are encoded at a time; ids and decoded bytes of a slice leave before the next one.
SLICE_BYTES = 1 << 20

_UNEVEN_BLANKS = regex.compile(r"\s (?:\s|\Z)")
_SAFE_CUT = re.compile(r"(?<=\S)[ \n]")


# --- the model --------------------------------------------------------------------------------


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where it is one, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(table: bytes) -> list[bytes]:
    """Tokens by rank.  Ranks are 0, 1, 2, ... without gaps."""
    tokens: dict[int, bytes] = {}
    for line in table.splitlines():
        if line.strip():
            token, rank = line.split()
            tokens[int(rank)] = base64.b64decode(token)
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks have gaps")
    return [tokens[rank] for rank in range(len(tokens))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol-buffer message: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """Serialise the model; piece ids are the ranks, and the unknown piece follows the last rank."""
    # Fixed values of the public model format: field numbers, BPE = 2, unknown piece = 2.
    pieces, piece_text, piece_score, piece_type, unknown = 1, 1, 2, 3, 2
    trainer, model_type, bpe, vocab_size, unk_id, bos_id, eos_id, pad_id = 2, 3, 2, 4, 40, 41, 42, 43
    normalizer, name, dummy_prefix, drop_blanks, escape_blanks = 3, 1, 3, 4, 5
    characters = byte_characters()
    minus_one = (1 << 64) - 1
    out = [
        _field(pieces, _field(piece_text, "".join(characters[b] for b in token).encode()) + _field(piece_score, -float(rank)))
        for rank, token in enumerate(tokens)
    ]
    out.append(_field(pieces, _field(piece_text, b"<unk>") + _field(piece_score, 0.0) + _field(piece_type, unknown)))
    ids = ((unk_id, len(tokens)), (bos_id, minus_one), (eos_id, minus_one), (pad_id, minus_one))
    settings = _field(model_type, bpe) + _field(vocab_size, len(tokens) + 1)
    out.append(_field(trainer, settings + b"".join(_field(n, v) for n, v in ids)))
    flags = b"".join(_field(n, 0) for n in (dummy_prefix, drop_blanks, escape_blanks))
    out.append(_field(normalizer, _field(name, b"identity") + flags))
    return b"".join(out)


# --- one process ------------------------------------------------------------------------------


class Codec:
    """Encodes texts to ids, kept as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, table: bytes, pattern: str) -> None:
        tokens = read_ranks(table)
        characters = byte_characters()
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self._to_characters = dict(enumerate(characters))
        to_byte = {c: b for b, c in enumerate(characters)}
        self._bytes = [bytes(to_byte[c] for c in self._pieces.id_to_piece(i)) for i in range(len(tokens))]
        self._whole = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self._find = regex.compile(pattern).findall
        self._cuttable = pattern == CUT_PATTERN
        # Both only spare work: what is not found is encoded again.
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    def _learn_words(self, words: set[str]) -> None:
        if len(self._words) > CACHED_CHUNKS:
            self._words.clear()
        merged = []
        for word in words.difference(self._words):
            raw = word.encode()
            whole = self._whole.get(raw)
            if whole is None:
                merged.append((word, raw.decode("latin-1").translate(self._to_characters)))
            else:
                self._words[word] = whole
        if merged:
            for (word, _), ids in zip(merged, self._pieces.encode([m for _, m in merged], num_threads=1)):
                self._words[word] = struct.pack(f"<{len(ids)}I", *ids)

    def _encode_words(self, words: list[str]) -> bytes:
        self._learn_words(set(words))
        return b"".join(map(self._words.__getitem__, words))

    def _segments(self, text: str) -> Iterator[str]:
        """Cut a long text where white space follows other text: no match spans such a place."""
        start = 0
        while len(text) - start > SEGMENT_CHARS and (cut := _SAFE_CUT.search(text, start + SEGMENT_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [b"".join(parts) for parts in map(self._encode_parts, texts)]

    def _encode_parts(self, text: str) -> list[bytes]:
        if not self._cuttable:
            return [self._encode_words(self._find(text))]
        return [self._encode_segment(segment) for segment in self._segments(text)]

    def _encode_segment(self, text: str) -> bytes:
        """Look up blank-led chunks, unless runs of white space make a cut at a blank unsafe."""
        if _UNEVEN_BLANKS.search(text):
            return self._encode_words(self._find(text))
        first, *rest = text.split(" ")
        missing = set(rest).difference(self._chunks)
        if missing:
            if len(self._chunks) > CACHED_CHUNKS // 2:
                self._chunks.clear()
                missing = set(rest)
            found = [(chunk, self._find(f" {chunk}")) for chunk in missing]
            self._learn_words({word for _, words in found for word in words})
            for chunk, words in found:
                self._chunks[chunk] = b"".join(map(self._words.__getitem__, words))
        head = self._encode_words(self._find(first))
        return head + b"".join(map(self._chunks.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def _codec(table: bytes, pattern: str) -> Codec:
    return Codec(table, pattern)


keeps_cache("byte_bpe", _codec.cache_clear)


# --- DataFrames -------------------------------------------------------------------------------


def _strings(column: pa.Array) -> list[str]:
    return ["" if value is None else value for value in column.to_pylist()]


def encode(docs: DataFrame, ranks_path: str, pattern: str = CUT_PATTERN, text: str = "text", decoded: bool = False) -> DataFrame:
    """Add ``token_ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``; with ``decoded`` also
    ``decoded_bytes``, mapped back from those ids.

    A null or empty text has no ids.  Rows, order of columns, repeated rows and rows with a null key stay
    as they are, an empty table gives an empty one, and columns that already have one of the new names
    are replaced.  There is no shuffle, batches are bounded in bytes and a long text is cut at white space,
    so memory follows the longest text.
    """
    spark = ship(docs.sparkSession)
    bound_batches(spark)
    table = spark.sparkContext.broadcast(vocabulary_bytes(ranks_path))
    added = {"token_ids": pa.binary(), "n_tokens": pa.int64()} | ({"decoded_bytes": pa.binary()} if decoded else {})
    kept = [name for name in docs.columns if name.lower() not in added]
    # A string column that is kept anyhow is sent once.
    sent = next((f.name for f in docs.schema if f.name in kept and f.name.lower() == text.lower() and f.dataType == T.StringType()), None)
    work = sent or free_name("text_to_encode", docs.columns)
    source = docs.select(*[col(name) for name in kept], *([] if sent else [col(text).cast("string").alias(work)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("byte_bpe")
        codec = _codec(table.value, pattern)
        for batch in batches:
            for part in slices(batch, work, SLICE_BYTES):
                ids = codec.encode_all(_strings(part.column(work)))
                values = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
                if decoded:
                    values.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), *values], [*kept, *added])

    fields = [docs.schema[name] for name in kept]
    fields += [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("decoded_bytes", T.BinaryType())] * decoded
    return source.mapInArrow(run, T.StructType(fields))


def decode(tokens: DataFrame, ranks_path: str, ids: str = "token_ids", pattern: str = CUT_PATTERN) -> DataFrame:
    """Add ``decoded_bytes`` to rows with encoded ids; null ids give null."""
    spark = ship(tokens.sparkSession)
    bound_batches(spark)
    table = spark.sparkContext.broadcast(vocabulary_bytes(ranks_path))
    kept = [name for name in tokens.columns if name.lower() != "decoded_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("byte_bpe")
        codec = _codec(table.value, pattern)
        for batch in batches:
            for part in slices(batch, ids, SLICE_BYTES):
                values = [None if i is None else codec.decode(i) for i in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.binary())], [*kept, "decoded_bytes"])

    fields = [*(tokens.schema[name] for name in kept), T.StructField("decoded_bytes", T.BinaryType())]
    return tokens.select(*[col(name) for name in kept]).mapInArrow(run, T.StructType(fields))
