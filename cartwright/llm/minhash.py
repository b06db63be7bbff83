"""Near-duplicate detection by MinHash bands and bottom-k sketches, with exact checks.

A text's set is its distinct word shingles.

1. Texts with equal sets form a class; only one row per class goes on.
2. A band is a few values, each the least of the set under a hash function of its own.  Two sets at
   the threshold agree in a whole band with a chance that so many bands miss them less often than
   ``MISS``; sets that share single shingles only, however common these are, hardly ever do.  Classes
   that agree in a band form a list; keys of one class alone drop out while they are counted.
3. A list does not emit all its pairs.  Round by round its members are compared with one pivot, and
   lists whose members are all connected are done.  When pivots close no more lists, all unconnected
   pairs left meet, each in one of the lists they share; so no link between different components is lost.
   A pair comes out of a list only if sizes fit, and parity signatures: bit i holds the parity of the
   set's hashes that fall on i, so two signatures differ in no more bits than the sets in hashes.
4. Pairs whose estimate from the union of both sketches, the k least hashes of each, is too low drop
   out; exact Jaccard similarity over the full sets decides on the others.

A set of fewer than k shingles is its own sketch, and ``needed`` is then exact.  For larger sets the
chance that a pair at the threshold shares fewer than ``needed`` values is below ``MISS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import bound_batches, col, free_name, keeps_cache, ship, slices, store_for, use_cache
from cartwright.llm.components import connected_components
from cartwright.sources.store import ParquetStore

KEPT = 32
MISS = 1e-9
# Least values in a band: more make false meetings rarer and bands more.
BAND_VALUES = 4
CACHED_WORDS = 125_000
# Words of 64 bits in a parity signature.
PARITY_WORDS = 8
PARITY = tuple(f"p{i}" for i in range(PARITY_WORDS))
PIVOT_ROUNDS = 2
# More unconnected pairs than this for each list entry call for another pivot round.  So many comparisons of sizes and
# signatures take less than a round does, and remain in proportion to the entries.
PAIRS_PER_ENTRY = 128
# Size of the table of key hashes: 1 MB.
BITS = 1 << 23


# --- sets -------------------------------------------------------------------------------------


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()
keeps_cache("minhash", _WORDS.clear)
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes (63 bits) of a text's shingles.

    A to Z are lower-cased, words lie between ASCII white space.  A text with fewer words than a shingle
    is one shingle; null, empty and blank texts have the empty set.
    """
    parts = text.encode().lower().split() if text else ()
    if not parts:
        return np.empty(0, np.int64)
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    hashes = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    value = hashes[:count].copy()
    for offset in range(1, width):
        value *= _MULTIPLIER
        value ^= value >> np.uint64(32)
        value += hashes[offset : offset + count]
    value *= _MIX
    value ^= value >> np.uint64(29)
    value *= _MULTIPLIER
    return np.unique(value >> np.uint64(1)).view(np.int64)


def parity_words(sets: list[np.ndarray]) -> np.ndarray:
    """A column of 64-bit words per PARITY name: parities of the hashes' numbers modulo all bits."""
    bits = 64 * PARITY_WORDS
    rows = [np.bincount(s % bits, minlength=bits) & 1 for s in sets]
    packed = np.packbits(np.array(rows, np.uint8).reshape(-1, bits), axis=1, bitorder="little")
    return packed.view("<i8").T if len(rows) else np.empty((PARITY_WORDS, 0), np.int64)


@lru_cache(maxsize=8)
def band_multipliers(numerator: int, denominator: int) -> np.ndarray:
    """A row of odd multipliers per band, one hash function each; a pair at the threshold misses all bands with chance below MISS."""
    agree = (numerator / denominator) ** BAND_VALUES
    bands = ceil(log(MISS) / log(1 - agree)) if agree < 1 else 1
    values = [xxhash.xxh32_intdigest(b"%d" % i) | 1 for i in range(bands * BAND_VALUES)]
    return np.array(values, np.uint32).reshape(bands, BAND_VALUES)


def band_keys(sets: list[np.ndarray], numerator: int, denominator: int) -> pa.ListArray:
    """The band keys of each set; none where no other set can reach the threshold."""
    multipliers = band_multipliers(numerator, denominator)
    bands = len(multipliers)
    # The nearest other set has one shingle more, or one less.
    able = [len(s) * denominator >= (len(s) + 1) * numerator for s in sets]
    members = [s for s, reached in zip(sets, able) if reached]
    offsets = np.zeros(len(sets) + 1, np.int32)
    np.cumsum(np.array(able, np.int32) * bands, out=offsets[1:])
    keys = np.empty((len(members), bands), np.uint64)
    if members:
        starts = np.cumsum([0, *map(len, members[:-1])])
        # Other shingles with the same 32 bits only add meetings.
        values = (np.concatenate(members) >> 31).astype(np.uint32)
        product = np.empty_like(values)
        for band, row in enumerate(multipliers):
            key = np.full(len(members), band + 1, np.uint64)
            for multiplier in row:
                np.multiply(values, multiplier, out=product)
                key ^= np.minimum.reduceat(product, starts)
                key *= _MULTIPLIER
                key ^= key >> np.uint64(32)
            keys[:, band] = key
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))


@lru_cache(maxsize=8)
def needed_of_sketch(kept: int, numerator: int, denominator: int) -> int:
    """The largest c for which a pair at the threshold shares fewer than c of k values with chance below MISS."""
    p, below, c = numerator / denominator, 0.0, 0
    while c <= kept:
        below += comb(kept, c) * p**c * (1 - p) ** (kept - c)
        if below > MISS:
            return max(c, 1)
        c += 1
    return kept


def needed(size: int, kept: int, numerator: int, denominator: int) -> int:
    """Kept values that a set of this size shares, at least, with any set at the threshold or above."""
    if size >= kept:
        return needed_of_sketch(kept, numerator, denominator)
    # The other set is complete too, or it is cut, has at most size * d / n values, and lost the rest of them.
    complete = -(-size * numerator // denominator)
    cut = kept - (size * denominator // numerator - size)
    return max(1, min(complete, cut))


def sketches(docs: DataFrame, key: str, text: str, words: int, kept: int, numerator: int, denominator: int, carry: str) -> DataFrame:
    """``carry, row_key, size, needed, set_digest, sketch``, parity words and ``bands``; the digest of an empty set is null."""
    bound_batches(ship(docs.sparkSession))
    source = docs.select(F.col(carry), col(key).alias("row_key"), col(text).cast("string").alias("row_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("minhash")
        for batch in batches:
            for part in slices(batch, "row_text"):
                sets = [shingle_set(t, words) for t in part.column("row_text").to_pylist()]
                sizes = [len(s) for s in sets]
                lows = [s[:kept] for s in sets]
                offsets = np.zeros(len(sets) + 1, np.int32)
                np.cumsum([len(low) for low in lows], out=offsets[1:])
                flat = np.concatenate(lows) if lows else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(sizes, pa.int64()),
                        pa.array([needed(n, kept, numerator, denominator) for n in sizes], pa.int32()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        *(pa.array(word) for word in parity_words(sets)),
                        band_keys(sets, numerator, denominator),
                    ],
                    ["carry", "row_key", "size", "needed", "set_digest", "sketch", *PARITY, "bands"],
                )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"carry bigint, row_key {kind}, size bigint, needed int, set_digest binary, sketch array<bigint>"
    return source.mapInArrow(run, schema + "".join(f", {name} bigint" for name in PARITY) + ", bands array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``c, shingles`` of the wanted classes (c, set_digest, row_key), each once.

    No text is shuffled.  A table of key hashes, of BITS bits whatever the corpus, tells whose sets are
    made; keys may be null, repeated or share a bit, so the digest of a set decides whether it is kept.
    """
    bound_batches(ship(docs.sparkSession))
    place = F.pmod(F.xxhash64("hashed_key"), F.lit(BITS))
    word, bit = F.floor(place / 64), F.pmod(place, F.lit(64)).cast("int")
    marked = wanted.select(F.col("row_key").alias("hashed_key")).withColumn("word", word).withColumn("bit", bit)
    marked = marked.select("word", F.expr("shiftleft(1L, bit)").alias("mask"))
    table = marked.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    source = docs.select(col(key).alias("hashed_key"), col(text).cast("string").alias("row_text"))
    source = source.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(table), "word").filter(F.getbit("mask", F.col("bit")) == 1)
    source = source.select("row_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("minhash")
        for batch in batches:
            for part in slices(batch, "row_text", 1 << 20):
                sets = [s for s in (shingle_set(t, words) for t in part.column("row_text").to_pylist()) if len(s)]
                if sets:
                    offsets = np.zeros(len(sets) + 1, np.int32)
                    np.cumsum([len(s) for s in sets], out=offsets[1:])
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                    digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                    yield pa.RecordBatch.from_arrays([digests, lists], ["set_digest", "shingles"])

    found = source.mapInArrow(run, "set_digest binary, shingles array<bigint>")
    return found.join(wanted.select("c", "set_digest"), "set_digest").dropDuplicates(["set_digest"]).select("c", "shingles")


# --- candidates -------------------------------------------------------------------------------


def band_lists(classes: DataFrame, store: ParquetStore) -> DataFrame:
    """``value, c, size`` and parity words: each class under its band keys that other classes have too."""
    entries = classes.select("c", F.explode("bands").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = entries.join(shared.select("value"), "value", "left_semi")
    return store.keep("lists", rows.join(classes.select("c", "size", *PARITY), "c").select("value", "c", "size", *PARITY))


def with_lists(active: DataFrame) -> DataFrame:
    """Add ``lists``, all keys under which a class is in ``active``: no more than there are bands."""
    return active.join(active.groupBy("c").agg(F.collect_set("value").alias("lists")), "c")


def _met(entries: DataFrame, others: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a list and may be similar.

    Where both sides have ``lists``, a pair comes out of one of its lists only, that of the least key.
    """
    renamed = {"c": "d", "size": "other_size", "component": "other", **{p: f"other_{p}" for p in PARITY}, "lists": "other_lists"}
    other = others.select("value", *[F.col(name).alias(new) for name, new in renamed.items() if name in others.columns])
    fit = F.least("size", "other_size") * denominator >= F.greatest("size", "other_size") * numerator
    differing = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"other_{p}"))) for p in PARITY), F.lit(0))
    # Sets at the threshold differ in (1 - t) / (1 + t) of their joint sizes.
    close = differing * (denominator + numerator) <= (F.col("size") + F.col("other_size")) * (denominator - numerator)
    wanted = (F.col("component") != F.col("other")) & fit & close
    if "lists" in entries.columns and "lists" in others.columns:
        wanted &= F.col("value") == F.array_min(F.array_intersect("lists", "other_lists"))
    return entries.join(other, "value").filter(wanted).select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))


def _candidates(entries: DataFrame, others: DataFrame, numerator: int, denominator: int) -> DataFrame:
    return _met(entries, others, numerator, denominator).distinct()


def likely_links(pairs: DataFrame, classes: DataFrame, kept: int) -> DataFrame:
    """Those pairs whose similarity, estimated from the union of both sketches, is not too low."""
    kinds = ("set_digest", "row_key", "sketch", "size", "needed")

    def side(end: str) -> DataFrame:
        return classes.select(F.col("c").alias(end), *[F.col(name).alias(f"{name}_{end}") for name in kinds])

    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, kept)
    # Of the k least values of the union, those in both sketches: k times the similarity is expected.
    hits = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    least = F.when((F.col("size_a") >= kept) & (F.col("size_b") >= kept), F.least("needed_a", "needed_b")).otherwise(1)
    return rows.filter(hits >= least).select("a", "b", *[f"{name}_{end}" for end in "ab" for name in ("size", "set_digest", "row_key")])


def verified_links(likely: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Those pairs whose similarity over full sets reaches the threshold."""

    def side(end: str) -> DataFrame:
        return sets.select(F.col("c").alias(end), F.col("shingles").alias(f"shingles_{end}"))

    inter = F.size(F.array_intersect("shingles_a", "shingles_b"))
    pairs = likely.select("a", "b", "size_a", "size_b")
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", inter.alias("common"))
    return full.filter(F.col("common") * denominator >= (F.col("size_a") + F.col("size_b") - F.col("common")) * numerator).select("a", "b")


def class_components(
    docs: DataFrame, lists: DataFrame, classes: DataFrame, store: ParquetStore, key: str, text: str, words: int, numerator: int, denominator: int, kept: int
) -> DataFrame:
    """``node, component`` of all classes that are linked with another one."""
    links = lists.select(F.col("c").alias("a"), F.col("c").alias("b")).limit(0)
    found = None
    for step in range(PIVOT_ROUNDS + 1):
        last = step == PIVOT_ROUNDS
        if found is None:
            placed = lists.withColumn("component", F.col("c"))
        else:
            placed = lists.join(found.select(F.col("node").alias("c"), "component"), "c", "left").withColumn("component", F.coalesce("component", "c"))
        if step == 0 and not last:
            active = placed
        else:
            parts = placed.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
            totals = parts.groupBy("value").agg(
                F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"),
                F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component"))["component"].alias("largest"),
            )
            totals = totals.filter("parts > 1")
            active = store.keep(f"active-{step}", placed.join(totals.select("value", "largest"), "value"))
            left = totals.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("within")) / 2)).first()
            entries, pairs_left = left[0] or 0, left[1] or 0
            if not entries:
                break
            last = last or pairs_left <= PAIRS_PER_ENTRY * entries
        if last:
            # A pair between components has an end outside the list's largest one; only such ends are joined.  Near
            # classes share many lists, and all that two of different components share are active.
            active = store.keep("meeting", with_lists(active))
            entering, others = active.filter("component <> largest"), active
        else:
            # The same pivots in all lists first, which close compact groups; then other ones in every list, which
            # chain the members of loose groups.
            rank = F.xxhash64("c", "value", F.lit(step)) if step else F.xxhash64("c")
            pivots = active.groupBy("value").agg(F.min(F.struct(rank.alias("rank"), "c", "size", "component", *PARITY)).alias("pivot"))
            entering, others = active, pivots.select("value", "pivot.c", "pivot.size", "pivot.component", *[f"pivot.{p}" for p in PARITY])
        pairs = _candidates(entering, others, numerator, denominator)
        likely = store.keep(f"likely-{step}", likely_links(pairs, classes, kept))
        ends = [likely.select(F.col(end).alias("c"), *[F.col(f"{name}_{end}").alias(name) for name in ("set_digest", "row_key")]) for end in "ab"]
        wanted = store.keep(f"wanted-{step}", ends[0].union(ends[1]).dropDuplicates(["c"]))
        sets = store.keep(f"sets-{step}", full_sets(docs, wanted, key, text, words))
        fresh = store.keep(f"links-{step}", verified_links(likely, sets, numerator, denominator))
        store.remove([f"{name}-{step}" for name in ("active", "likely", "wanted", "sets")])
        if found is None or not fresh.isEmpty():
            links = links.unionByName(fresh)
            # In full: what a round leaves apart would meet again pair by pair.
            found = connected_components(links, store, f"components-{step + 1}")
        if last:
            break
    return found if found is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))


# --- the operator -----------------------------------------------------------------------------


def judge_rows(
    docs: DataFrame, carry: str, key: str, text: str, words: int, numerator: int, denominator: int, kept: int, store: ParquetStore
) -> DataFrame:
    """``carry, row_key, n_shingles, component_id, kept`` for every row."""
    rows = store.keep("sketches", sketches(docs, key, text, words, kept, numerator, denominator, carry))
    # One row of each class stands for it and names it; classes of copies are folded before the shuffle.
    kinds = ("row_key", "size", "needed", "sketch", *PARITY, "bands")
    first = rows.filter("set_digest IS NOT NULL").groupBy("set_digest").agg(F.min(F.struct("carry", *kinds)).alias("first"))
    classes = store.keep("classes", first.select("set_digest", F.col("first.carry").alias("c"), *[f"first.{name}" for name in kinds]))
    lists = band_lists(classes, store)
    found = class_components(docs, lists, classes, store, key, text, words, numerator, denominator, kept)
    named = classes.select("set_digest", "c").join(found.withColumnRenamed("node", "c"), "c", "left")
    named = named.select("set_digest", F.coalesce("component", "c").alias("component"))
    placed = rows.select("carry", "row_key", "size", "set_digest").join(named, "set_digest", "left")
    placed = placed.select("carry", "row_key", "size", "component")
    placed = store.keep("placed", placed)
    # Null keys come last; of repeated keys the first row stays.
    order = F.struct(F.col("row_key").isNull().alias("absent"), "row_key", "carry")
    least = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("least"))
    joined = placed.filter("component IS NOT NULL").join(least, "component").select(
        "carry", "row_key", F.col("size").alias("n_shingles"), F.col("least.row_key").alias("component_id"),
        (F.col("least.carry") == F.col("carry")).alias("kept"),
    )
    alone = placed.filter("component IS NULL").select(
        "carry", "row_key", F.col("size").alias("n_shingles"), F.col("row_key").alias("component_id"), F.lit(True).alias("kept")
    )
    return joined.unionByName(alone)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, numerator: int = 80, denominator: int = 100, kept: int = KEPT
) -> DataFrame:
    """One row per input row: ``<key>, n_shingles, component_id, kept``.

    Rows are linked when ``denominator * |intersection| >= numerator * |union|`` of their shingle sets;
    ``component_id`` is the least key reachable over links.  Null, empty and blank texts have no
    shingles and are linked with nothing.  One row of each component is kept, that of the least key; of
    repeated keys the first row, and null keys only where a component has no other.  An empty table
    gives an empty result.  Shingles are compared by 63-bit hashes, those of a long text all of them, in one
    Python worker's memory.
    """
    store = store_for(docs)
    row = "near_row"
    source = docs.select(col(key), col(text)).withColumn(row, F.monotonically_increasing_id())
    judged = judge_rows(source, row, key, text, words, numerator, denominator, kept, store)
    store.discard(keep=("placed",))
    return judged.select(F.col("row_key").alias(key), "n_shingles", "component_id", "kept")


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, numerator: int = 80, denominator: int = 100, kept: int = KEPT,
    store: ParquetStore | None = None,
) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns and nothing else; they are read from ``store``."""
    store = store or store_for(docs)
    row = free_name("stable_row", docs.columns)
    rows = store.keep("rows", docs.withColumn(row, F.monotonically_increasing_id()))
    work = store_for(docs)
    judged = judge_rows(rows.select(col(key), col(text), row), row, key, text, words, numerator, denominator, kept, work)
    dropped = store.keep("dropped", judged.filter(~F.col("kept")).select(F.col("carry").alias(row)))
    work.discard()
    return rows.join(dropped, row, "left_anti").select(*[col(name) for name in docs.columns])
