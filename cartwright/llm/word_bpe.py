"""Tokens of a BPE vocabulary with word ends, read from a tokenizers JSON file.

Counting merges symbol pairs from a heap over a linked list and emits no identifiers.  Encoding
uses the library itself, once per distinct chunk between white space.  Both keep bounded tables of
what they have seen, which only spare work.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cartwright.llm.byte_bpe import byte_characters
from cartwright.llm.common import col, free_name, keeps_cache, ship, slices, use_cache, vocabulary_bytes

CACHED_CHUNKS, CACHED_WORDS = 500_000, 500_000
# The encoder keeps two tables of this many chunks.
ENCODED_CHUNKS = 400_000
SEGMENT_CHARS = 1 << 20
# Cutting at these is safe: they end every pre-token and are starters in normalisation.
_BLANKS = re.compile(r"[ \t\n\r]+")
_CUT = re.compile(r"[ \t\n\r]")


def segments(text: str) -> Iterator[str]:
    """Cut a long text at white space, so that memory does not follow its length."""
    start = 0
    while len(text) - start > SEGMENT_CHARS and (cut := _CUT.search(text, start + SEGMENT_CHARS)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


# --- counting ---------------------------------------------------------------------------------


def merged_symbols(symbols: list[str], ranks: dict[tuple[str, str], tuple[int, str]]) -> int:
    """Symbols left after repeatedly merging the adjacent pair of lowest rank, leftmost first."""
    count = len(symbols)
    if count < 2:
        return count
    symbols = list(symbols)
    before, after = list(range(-1, count - 1)), list(range(1, count + 1))
    heap = [(*found, at) for at in range(count - 1) if (found := ranks.get((symbols[at], symbols[at + 1])))]
    # Entries are (rank, merged symbol, position); position decides among equal ranks.
    heap = [(rank, at, merged) for rank, merged, at in heap]
    heapify(heap)
    left = count
    while heap:
        rank, at, merged = heappop(heap)
        following = after[at]
        # An entry is stale once either side has been merged into something else.
        if symbols[at] is None or following >= count or ranks.get((symbols[at], symbols[following]), (-1,))[0] != rank:
            continue
        symbols[at], symbols[following] = merged, None
        after[at] = following = after[following]
        left -= 1
        if following < count:
            before[following] = at
            if found := ranks.get((merged, symbols[following])):
                heappush(heap, (found[0], at, found[1]))
        previous = before[at]
        if previous >= 0 and (found := ranks.get((symbols[previous], merged))):
            heappush(heap, (found[0], previous, found[1]))
    return left


class TokenCounter:
    """Token counts as the library gives them, without its ids."""

    def __init__(self, file: bytes) -> None:
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE vocabulary")
        self._suffix = model.get("end_of_word_suffix") or ""
        self._known = set(model["vocab"])
        pairs = (merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"])
        self._ranks = {(a, b): (rank, a + b) for rank, (a, b) in enumerate(pairs)}
        [split, byte_level] = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or byte_level["add_prefix_space"]:
            raise ValueError("an unknown way to normalise or split")
        self._find = regex.compile(split["pattern"]["Regex"]).findall
        self._special = [token["content"] for token in spec["added_tokens"]]
        self._at_special = re.compile("|".join(map(re.escape, self._special))) if self._special else None
        self._openings = tuple({content[:2] for content in self._special})
        self._characters = dict(enumerate(byte_characters()))
        self._words: dict[str, int] = {}
        self._chunks: dict[str, int] = {}

    def _count_word(self, word: str) -> int:
        """Symbols are the bytes of the word, the last one with the word end."""
        symbols = list(word.encode().decode("latin-1").translate(self._characters))
        symbols[-1] += self._suffix
        if not self._known.issuperset(symbols):
            symbols = [s for s in symbols if s in self._known]  # as the library does without an unknown token
        return merged_symbols(symbols, self._ranks)

    def _count_plain(self, text: str) -> int:
        """A text without special strings and white space to normalise."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Characters are lowered one by one: the final sigma stays a plain one.
            text = text.replace("Σ", "σ")
        total, known = 0, self._words
        for word in self._find(text.lower()):
            count = known.get(word)
            if count is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                count = known[word] = self._count_word(word)
            total += count
        return total

    def _count_chunks(self, text: str) -> int:
        chunks = _BLANKS.split(text) if "\t" in text or "\r" in text else text.replace("\n", " ").split(" ")
        known = self._chunks
        missing = set(chunks).difference(known)
        if missing:
            if len(known) > CACHED_CHUNKS:
                known.clear()
                missing = set(chunks)
            for chunk in missing:
                known[chunk] = self._count_plain(chunk)
        return sum(map(known.__getitem__, chunks))

    def count(self, text: str) -> int:
        if any(opening in text for opening in self._openings) and self._at_special:
            parts = self._at_special.split(text)
            return len(parts) - 1 + sum(self._count_long(part) for part in parts)
        return self._count_long(text)

    def _count_long(self, text: str) -> int:
        return sum(map(self._count_chunks, segments(text)))


@lru_cache(maxsize=2)
def _counter(file: bytes) -> TokenCounter:
    return TokenCounter(file)


keeps_cache("token_counts", _counter.cache_clear)


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """Add ``n_bytes, n_tokens, over_limit``.

    Null and empty texts have 0 bytes and tokens; long texts are counted whole, in segments.  Rows, repeated ones too, and other columns stay as they
    are; columns that already have one of the new names are replaced.  There is no shuffle.
    """
    spark = ship(docs.sparkSession)
    file = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary_path))
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = [name for name in docs.columns if name.lower() not in added]
    work = free_name("text_to_count", docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("token_counts")
        counter = _counter(file.value)
        for batch in batches:
            for part in slices(batch, work):
                texts = part.column(work).to_pylist()
                counts = [counter.count(t) if t else 0 for t in texts]
                values = [
                    pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), *values], [*kept, *added])

    fields = [*(docs.schema[name] for name in kept), T.StructField("n_bytes", T.LongType())]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return docs.select(*[col(name) for name in kept], col(text).cast("string").alias(work)).mapInArrow(run, T.StructType(fields))


# --- encoding ---------------------------------------------------------------------------------


# Marks that form a pre-token with marks only.
_CLOSING = ".,;:!?$&#%*)"
# Letters that are their own lower case and normal form.
_LOWERED = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[{_LOWERED}]+").fullmatch
# A mark right after such a letter begins a pre-token.  The mark is looked for first, which is a faster search.
_part_marks = re.compile(rf"[{re.escape(_CLOSING)}](?<=[{_LOWERED}].)").sub


def _letters(chunk: str) -> bool:
    """Whether a chunk is of letters only in the form that the library reads.

    Some letters come apart into a letter and a mark, and the library joins a mark with the punctuation after it.
    """
    return (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).lower()).isalpha()


def _groups(items: list[str], size: int = 1024) -> Iterator[list[str]]:
    return (items[start : start + size] for start in range(0, len(items), size))


class LibraryEncoder:
    """Ids from the tokenizers library, looked up by chunks between white space."""

    def __init__(self, file: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_buffer(file)
        spec = json.loads(file)
        self.vocabulary_size = max(self._library.get_vocab(with_added_tokens=True).values()) + 1
        self._special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        # The last special token marks the ends of chunks; its string in a text is met before.
        self._mark, self._mark_id = list(self._special.items())[-1]
        self._openings = tuple({content[:2] for content in self._special})
        suffix = spec["model"].get("end_of_word_suffix")
        self._ends_word, self._is_mark = np.zeros((2, self.vocabulary_size), bool)
        if suffix:
            self._ends_word[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self._is_mark[self._mark_id] = True
        self._tokens_of = self._library.model.tokenize
        self._characters = dict(enumerate(byte_characters()))
        # When the table is full it becomes the older one, from which what is met again is taken back.
        self._chunks: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}

    def _ask(self, text: str) -> np.ndarray:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, chunks: set[str]) -> None:
        """Fill the table for chunks without special strings.

        A chunk of letters is one pre-token, and so are the marks after letters; other chunks are
        asked for with the special token between them.
        """
        words, odd = set(), []
        closed, stems, endings = [], [], []
        for chunk in chunks:
            if chunk.isalpha():
                words.add(chunk)
                continue
            stem = chunk.rstrip(_CLOSING)
            if len(stem) < len(chunk) and _letters(stem):
                closed.append(chunk)
                stems.append(stem)
                endings.append(chunk[len(stem) :])
            elif chunk:
                odd.append(chunk)
        words.update(stems, endings)
        self._learn_words(self._recalled(words.difference(self._chunks)))
        known = self._chunks
        known.update(zip(closed, map(add, map(known.__getitem__, stems), map(known.__getitem__, endings))))
        for group in _groups(odd):
            self._keep(group, self._ask(f" {self._mark} ".join(group) + f" {self._mark}"), self._is_mark, 1)

    def _recalled(self, chunks: set[str]) -> set[str]:
        """Take what the older table has into the new one; the chunks that it lacks."""
        older = self._older
        again = chunks.intersection(older) if older else ()
        if not again:
            return chunks
        self._chunks.update(zip(again, map(older.__getitem__, again)))
        return chunks.difference(again)

    def _learn_words(self, words: set[str]) -> None:
        """Words in plain letters go to the library's model, as nothing is left to normalise.

        Others are asked for in one text of many pre-tokens; the last id of each ends a word.
        """
        known, tokens_of, characters, other = self._chunks, self._tokens_of, self._characters, []
        for word in words:
            if _PLAIN(word):
                shown = word if word.isascii() else word.encode().decode("latin-1").translate(characters)
                known[word] = array("I", [token.id for token in tokens_of(shown)]).tobytes()
            else:
                other.append(word)
        for group in _groups(other):
            self._keep(group, self._ask(" ".join(group)), self._ends_word, 0)

    def _keep(self, group: list[str], ids: np.ndarray, closes: np.ndarray, left_out: int) -> None:
        ends = np.flatnonzero(closes[ids]) + 1
        if len(ends) != len(group) or (len(ids) and ends[-1] != len(ids)):
            # A pre-token that needs another reading than the rule above: ask for each alone.
            for chunk in group:
                self._chunks[chunk] = self._ask(chunk).tobytes()
            return
        raw, begin = ids.tobytes(), 0
        for chunk, end in zip(group, ends.tolist()):
            self._chunks[chunk] = raw[4 * begin : 4 * (end - left_out)]
            begin = end

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  What the table lacks is learned once for all of them."""
        split: list[list[str] | None] = []
        for text in texts:
            plain = len(text) <= SEGMENT_CHARS and not any(opening in text for opening in self._openings)
            split.append(self._split(text) if plain else None)
        wanted = set().union(*filter(None, split))
        missing = wanted.difference(self._chunks)
        if missing and len(self._chunks) + len(missing) > ENCODED_CHUNKS:
            self._older, self._chunks = self._chunks, {"": b""}
            missing = wanted.difference(self._chunks)
        self._learn(self._recalled(missing))
        look_up = self._chunks.__getitem__
        return [
            self._encode_alone(text) if chunks is None else b"".join(map(look_up, chunks)) for text, chunks in zip(texts, split)
        ]

    def _encode_alone(self, text: str) -> bytes:
        if any(opening in text for opening in self._openings):
            return self._ask(text).tobytes()
        return b"".join(self._ask(segment).tobytes() for segment in segments(text))

    @staticmethod
    def _split(text: str) -> list[str]:
        try:
            # Here every character is its own normal form, and lower case is the same everywhere.  Words come apart
            # from the marks after them, so that the table has each word once.
            text.encode("latin-1")
            text = _part_marks(r" \g<0>", text.lower())
        except UnicodeEncodeError:
            pass
        return _BLANKS.split(text) if "\t" in text or "\r" in text else text.replace("\n", " ").split(" ")


@lru_cache(maxsize=2)
def library_encoder(file: bytes) -> LibraryEncoder:
    return LibraryEncoder(file)


keeps_cache("library_encoder", library_encoder.cache_clear)
