"""Prefix trie of conversations, as double arrays per prefix shard.

Equal conversations are folded first, so that a trie holds each sequence of turns once, with a weight.  Sequences
are dealt to shards by their first turn; those of a prefix with too many rows by their first two, four, eight turns
and so on.  All nodes at or below that depth lie in one shard, which packs its sequences into BASE and CHECK over
dense turn ids and walks them; the few nodes above are shared by shards and are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwright.llm.common import col, ship, store_for
from cartwright.sources.store import ParquetStore

#: Rows of a prefix up to which it is not divided further.
SHARD_ROWS = 1 << 16
#: Shared nodes up to which they are broadcast; beyond, they are joined by key.
SHARED = 100_000
_WORDS = r"[^\x20\x09-\x0D]+"
_NOBODY = hashlib.sha256(b"").hexdigest()
_ROOT = b"\0" * 16


# --- turns ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Columns:
    """Names of the caller's columns."""

    conversation: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"


def ordered_turns(store: ParquetStore, rows: DataFrame, names: Columns = Columns()) -> DataFrame:
    """``conv_id, pos, turn_id, words``: every turn's place in its conversation, a 128-bit digest of role and text, words of the text.

    A null turn comes first; equal turns are in the order of role, the text's first 64 characters and its digest, so that whole
    texts need not be shuffled.  Null role and text are empty.  Rows without a conversation belong to none.  Places are counted
    in pieces of a global order, so that a conversation with a large part of all rows is spread like any other.
    """
    role, text = (F.coalesce(col(name).cast("string"), F.lit("")) for name in (names.role, names.text))
    # The length of the role keeps it apart from the text.
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 32))
    cut = rows.filter(col(names.conversation).isNotNull()).select(
        col(names.conversation).cast("bigint").alias("conv_id"),
        col(names.turn).alias("turn"),
        role.alias("role"),
        digest.alias("turn_id"),
        F.regexp_count(text, F.lit(_WORDS)).cast("bigint").alias("words"),
        F.substring(text, 1, 64).alias("opening"),
        # Divides repeated rows, whose order is of no account.
        (F.monotonically_increasing_id() % 1024).alias("any"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "opening", "turn_id", "any"))]
    dealt = cut.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = dealt.select("conv_id", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("row"), "turn_id", "words")
    pieces = store.keep("pieces", numbered)
    firsts = pieces.groupBy("conv_id", "piece").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    # One row per conversation and piece: a conversation has no more of them than there are partitions.
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select("conv_id", "piece", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return pieces.join(offsets, ["conv_id", "piece"]).select("conv_id", (F.col("row") + F.col("shift")).alias("pos"), "turn_id", "words")


def rebuilt(turns: DataFrame, every: int = 20, openings: int = 4) -> tuple[DataFrame, DataFrame]:
    """Give conversations common openings: (turns, all conversation ids).

    The first h turns of conversation c are replaced by the first h (all, if fewer) of conversation c - c % every;
    h is the crc32 of the decimal c modulo ``openings``.
    """
    heads = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    cut = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(openings))
    base = F.col("conv_id") - F.col("conv_id") % every
    ids = heads.select("conv_id", cut.alias("h"), base.alias("base"))
    bases = heads.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    plan = ids.join(bases, "base", "left").select("conv_id", "h", "base", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("taken"))
    taken = plan.filter("taken > 0").select(F.col("conv_id").alias("to"), "base", "taken")
    opening = turns.filter((F.col("pos") < openings - 1) & (F.col("conv_id") % every == 0)).join(taken, F.col("conv_id") == F.col("base")).filter("pos < taken")
    own = turns.join(plan, "conv_id").filter("pos >= h")
    rows = opening.select(F.col("to").alias("conv_id"), "pos", "turn_id", "words").unionAll(
        own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id", "words")
    )
    return rows, heads.select("conv_id")


# --- folding equal conversations ------------------------------------------------------------------


def _hashed(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of each group's ascending ids, joined by commas: a stream, of which no task holds more than a batch.

    One digest of one list is sequential by nature; ids reach it sorted, eight bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            groups, ids = batch.column("group").to_numpy(), batch.column("conv_id").to_pylist()
            starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])).tolist() if len(groups) else []
            for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
                text = ",".join(map(str, ids[start:end])).encode()
                if groups[start] == now:
                    state.update(b"," + text)
                else:
                    if state is not None:
                        done.append((int(now), state.hexdigest()))
                    now, state = groups[start], hashlib.sha256(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in done], pa.int64()), pa.array([d for _, d in done])], ["group", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([int(now)], pa.int64()), pa.array([state.hexdigest()])], ["group", "ends_sha256"])

    dealt = members.select("group", "conv_id").repartition("group").sortWithinPartitions("group", "conv_id")
    return dealt.mapInArrow(run, "group bigint, ends_sha256 string")


def _folded(store: ParquetStore, turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``group, copies, ends_sha256``, one row per distinct sequence; group is its smallest conversation."""
    sums = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), *[F.bit_xor(_hashed(seed, F.col("pos"), F.col("turn_id"))).alias(f"s{seed}") for seed in (1, 2)]
    )
    empty = F.lit(0).cast("bigint")
    digests = store.keep("digests", ids.join(sums, "conv_id", "left").select("conv_id", *[F.coalesce(name, empty).alias(name) for name in ("turns", "s1", "s2")]))
    groups = store.keep("groups", digests.groupBy("turns", "s1", "s2").agg(F.min("conv_id").alias("group"), F.count(F.lit(1)).alias("copies")))
    alone = groups.filter("copies = 1").select("group", "turns", "copies", F.sha2(F.col("group").cast("string").cast("binary"), 256).alias("ends_sha256"))
    several = groups.filter("copies > 1")
    ends = _ends(digests.join(several, ["turns", "s1", "s2"]))
    return store.keep("folded", alone.unionAll(several.join(ends, "group").select("group", "turns", "copies", "ends_sha256")))


# --- shards -----------------------------------------------------------------------------------


def _sharded(store: ParquetStore, sequences: DataFrame, shard_rows: int) -> DataFrame:
    """``group, depth, shard``: the number of opening turns by which a sequence is dealt, and where it goes."""
    longest = sequences.agg(F.max("pos")).first()[0]
    depths = [1 << i for i in range(max(int(longest or 0).bit_length() + 1, 1))]
    mark = _hashed(3, F.col("pos"), F.col("turn_id"))
    marks = sequences.groupBy("group").agg(F.count(F.lit(1)).alias("rows"), *[F.bit_xor(F.when(F.col("pos") < d, mark)).alias(f"m{d}") for d in depths])
    todo, settled = store.keep("marks", marks), []
    for step, depth in enumerate(depths):
        key = _hashed(depth, F.col(f"m{depth}"))
        if depth == depths[-1]:
            settled.append(todo.select("group", F.lit(depth).alias("depth"), key.alias("prefix")))
            break
        sizes = todo.groupBy(key.alias("prefix")).agg(F.sum("rows").alias("all"), F.count(F.lit(1)).alias("n"))
        large = store.keep(f"large-{step}", sizes.filter((F.col("all") > shard_rows) & (F.col("n") > 1)).select("prefix"))
        keyed = todo.withColumn("prefix", key)
        settled.append(keyed.join(large, "prefix", "left_anti").select("group", F.lit(depth).alias("depth"), "prefix"))
        if large.isEmpty():
            break
        todo = store.keep(f"todo-{step}", keyed.join(large, "prefix", "left_semi").drop("prefix"))
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionAll(more)
    return rows


class DoubleArray:
    """A trie over turn ids 1..n: the child of node s by id a is BASE[s] + a, and CHECK there is s.

    A node is the cell it stands in; the root is cell 0.  BASE may be negative, cells may not.
    """

    def __init__(self, paths: list[np.ndarray]) -> None:
        self.base, self.check = [0], [-2]
        self._next_free = 1
        self._pack(paths)
        self.base, self.check = np.array(self.base, np.int64), np.array(self.check, np.int64)

    def _reach(self, cell: int) -> None:
        if cell >= len(self.check):
            more = max(cell + 1, 2 * len(self.check)) - len(self.check)
            self.check += [-1] * more
            self.base += [0] * more

    def _place(self, letters: list[int]) -> int:
        """A base under which the cells of all these ids are free."""
        free, check = self._next_free, self.check
        while free < len(check) and check[free] != -1:
            free += 1
        self._next_free = free
        # With one id the first free cell will do; with more the search starts there and ends at the open end.
        while True:
            base = free - letters[0]
            if all(base + x >= len(check) or check[base + x] == -1 for x in letters):
                return base
            free += 1
            while free < len(check) and check[free] != -1:
                free += 1

    def _pack(self, paths: list[np.ndarray]) -> None:
        paths = sorted(path.tolist() for path in paths)
        todo = [(0, 0, len(paths), 0)]
        while todo:
            s, start, end, depth = todo.pop()
            while start < end and len(paths[start]) == depth:
                start += 1
            letters, bounds = [], []
            for i in range(start, end):
                x = paths[i][depth]
                if not letters or letters[-1] != x:
                    letters.append(x)
                    bounds.append(i)
            if not letters:
                continue
            base = self._place(letters)
            self._reach(base + letters[-1])
            self.base[s] = base
            for x, first, last in zip(letters, bounds, [*bounds[1:], end], strict=True):
                self.check[base + x] = s
                todo.append((base + x, first, last, depth + 1))

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Children of nodes; -1 where there is none."""
        cells = self.base[nodes] + letters
        inside = (cells > 0) & (cells < len(self.check))
        there = np.where(inside, self.check[np.where(inside, cells, 0)], -1)
        return np.where(there == nodes, cells, -1)


_NODES = (
    "shared binary, parent binary, up array<binary>, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string"
)
_NODE_SCHEMA = pa.schema(
    [("shared", pa.binary()), ("parent", pa.binary()), ("up", pa.list_(pa.binary())), ("depth", pa.int64()), ("conv_id", pa.int64())]
    + [(name, pa.int64()) for name in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")]
    + [("ends_sha256", pa.string())]
)


def shard_nodes(rows: pa.Table) -> pa.Table:
    """Nodes of one shard.  Those above the dealing depth are partial: their counts are of what lies below in this shard."""
    rows = rows.sort_by([("group", "ascending"), ("pos", "ascending")])
    group, pos = rows.column("group").to_numpy(), rows.column("pos").to_numpy()
    words, turn_ids = rows.column("words").to_numpy(), rows.column("turn_id").combine_chunks()
    dense = turn_ids.dictionary_encode()
    letters = dense.indices.to_numpy().astype(np.int64) + 1
    starts = np.flatnonzero(pos == 0)
    lengths = np.diff(np.append(starts, len(pos)))
    copies = rows.column("copies").to_numpy()[starts]
    dealt = rows.column("depth").to_numpy()[starts]
    ends = [rows.column("ends_sha256")[int(i)].as_py() for i in starts]
    names = group[starts]
    trie = DoubleArray([letters[s : s + n] for s, n in zip(starts, lengths, strict=True)])
    size = len(trie.check)
    # Walk all sequences one turn at a time.
    n_convs, smallest = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, cost, shared_until = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    at_end = np.full(size, -1)
    at, going, levels = np.zeros(len(starts), np.int64), np.arange(len(starts)), []
    step_of = np.empty(len(pos), np.int64)
    d = 0
    np.add.at(n_convs, at, copies)
    np.minimum.at(smallest, at, names)
    shared_until[0] = 1
    while True:
        done = going[lengths[going] == d]
        at_end[at[done]] = done
        going = going[lengths[going] > d]
        if not len(going):
            break
        where = starts[going] + d
        at[going] = trie.step(at[going], letters[where])
        step_of[where] = at[going]
        d += 1
        here = at[going]
        np.add.at(n_convs, here, copies[going])
        np.minimum.at(smallest, here, names[going])
        depth[here], cost[here], shared_until[here] = d, words[where], dealt[going]
        levels.append(np.unique(here))
    shared = (shared_until > depth) & (n_convs > 0)
    # From the leaves up; what shared nodes add themselves is known only after the merge.
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for level in reversed(levels):
        closed = level[~shared[level]]
        leaves[closed] += children[closed] == 0
        saved[closed] += (n_convs[closed] - 1) * cost[closed]
        np.add.at(children, trie.check[closed], 1)
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    # Names of the shared nodes: digests of their paths.
    some_row = np.empty(size, np.int64)
    some_row[step_of] = np.arange(len(pos))
    keys: dict[int, bytes] = {0: _ROOT}
    paths: dict[int, list[bytes]] = {0: []}
    for level in levels:
        open_here = level[shared[level]]
        if not len(open_here):
            break
        for cell in open_here.tolist():
            above = int(trie.check[cell])
            keys[cell] = hashlib.blake2b(keys[above] + turn_ids[int(some_row[cell])].as_py(), digest_size=16).digest()
            paths[cell] = [*paths[above], keys[above]]
    used = np.concatenate([np.zeros(1, np.int64), *levels])
    parents = trie.check[used]
    open_ = shared[used]
    known = (parents >= 0) & ~open_ & ~shared[np.maximum(parents, 0)]
    to_key = [keys.get(int(p)) if p >= 0 and (o or not k) else None for p, o, k in zip(parents, open_, known, strict=True)]
    return pa.table(
        [
            pa.array([keys[int(c)] if o else None for c, o in zip(used, open_, strict=True)], pa.binary()),
            pa.array(to_key, pa.binary()),
            pa.array([paths[int(c)] if o else None for c, o in zip(used, open_, strict=True)], pa.list_(pa.binary())),
            pa.array(depth[used]),
            pa.array(smallest[used]),
            pa.array(np.where(known, smallest[np.maximum(parents, 0)], 0), mask=~known),
            pa.array(n_convs[used]),
            pa.array(children[used]),
            pa.array(leaves[used]),
            pa.array(saved[used]),
            pa.array(cost[used]),
            pa.array([ends[i] if i >= 0 else None for i in at_end[used]], pa.string()),
        ],
        schema=_NODE_SCHEMA,
    )


# --- all together -------------------------------------------------------------------------------


def _merged(store: ParquetStore, partial: DataFrame) -> DataFrame:
    """Shared nodes of all shards, whole."""
    once = store.keep(
        "merged",
        partial.groupBy("shared").agg(
            *[F.max(name).alias(name) for name in ("parent", "depth", "words", "ends_sha256")],
            F.max("up").alias("up"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
    )
    more = once.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("shared")).agg(F.count(F.lit(1)).alias("open_children"))
    whole = store.keep("shared", once.join(more, "shared", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).drop("open_children"))
    # What a shared node adds goes to itself and to all above it; these paths are as long as the dealing depth at most.
    gains = whole.select(
        F.explode(F.concat("up", F.array("shared"))).alias("shared"),
        (F.col("n_children") == 0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("gain"),
    )
    sums = gains.groupBy("shared").agg(F.sum("leaf").alias("leaf"), F.sum("gain").alias("gain"))
    total = whole.join(sums, "shared").withColumn("n_leaves", F.col("n_leaves") + F.col("leaf")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("gain"))
    return store.keep("total", total.drop("leaf", "gain", "up", "words"))


_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(
    turns: DataFrame, ids: DataFrame, store: ParquetStore | None = None, shard_rows: int = SHARD_ROWS, shared_rows: int = SHARED
) -> DataFrame:
    """One row per node of the trie over the conversations ``ids`` with their ``turns`` (``conv_id, pos, turn_id, words``).

    Conversations without turns end at the root.  No conversation at all gives no node.  Copies of a conversation are one
    sequence with a weight, however many there are.  A single sequence is walked by one task, whose memory grows with
    its turns; a prefix with more than ``shard_rows`` rows is divided by a longer prefix.
    """
    spark = ship(turns.sparkSession)
    store = store or store_for(turns)
    turns = store.keep("turns", turns)
    folded = _folded(store, turns, ids)
    sequences = store.keep("sequences", turns.withColumnRenamed("conv_id", "group").join(folded.select("group"), "group", "left_semi"))
    deal = store.keep("deal", _sharded(store, sequences, shard_rows))
    total = sequences.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_rows))
    info = deal.join(folded, "group").select("group", "copies", "ends_sha256", "depth", F.pmod(F.col("prefix"), F.lit(shards)).alias("shard"))
    nodes = store.keep("nodes", sequences.join(info, "group").groupBy("shard").applyInArrow(shard_nodes, _NODES))
    store.discard(keep=("nodes", "folded", "ordered", "ids"))
    none = F.lit(0).cast("bigint")
    turnless = folded.filter("turns = 0").select(
        F.lit(_ROOT).alias("shared"), F.lit(None).cast("binary").alias("parent"), F.array().cast("array<binary>").alias("up"), none.alias("depth"),
        F.col("group").alias("conv_id"), F.lit(None).cast("bigint").alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        *[none.alias(name) for name in ("n_children", "n_leaves", "saved_tokens", "words")], "ends_sha256",
    )
    shared = _merged(store, nodes.filter("shared IS NOT NULL").unionAll(turnless))
    above = shared.select(F.col("shared").alias("parent"), F.col("conv_id").alias("above"))
    # Most children of shared nodes have the same few parents: these are broadcast when they are few.
    if shared.count() <= shared_rows:
        above = F.broadcast(above)
    store.discard(keep=("nodes", "total"))
    rest = nodes.filter("shared IS NULL")
    mine = shared.withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    # Only nodes whose parent is shared, or not there, still lack its name.
    lacking = rest.filter("parent IS NOT NULL").select("parent", *_RESULT).unionAll(mine.select("parent", *_RESULT))
    named = lacking.join(above, "parent", "left").withColumn("parent_conv_id", F.col("above")).select(*_RESULT)
    rows = rest.filter("parent IS NULL").select(*_RESULT).unionAll(named)
    return rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOBODY)))


def conversation_nodes(rows: DataFrame, names: Columns = Columns(), every: int = 20, openings: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes over conversations that were given common openings; see ``rebuilt`` and ``prefix_trie``."""
    store = store_for(rows)
    turns = store.keep("ordered", ordered_turns(store, rows, names))
    store.remove(["pieces"])
    changed, ids = rebuilt(turns, every, openings)
    nodes = prefix_trie(changed, store.keep("ids", ids), store, shard_rows)
    return nodes
