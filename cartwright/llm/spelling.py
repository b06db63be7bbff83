"""Words that are one edit apart, and the frequent word that each rare one stands for.

A word is a point of letter counts.  Words one edit apart have points at L1 distance one (a letter more) or two (a letter
replaced).  Per word length, a k-d tree fitted to a sample cuts the points into cells; each
word is a member of the cell it falls into, and asks the later cells of its length and the cells of the next
length whose box lies within reach.  Inside a cell a second k-d tree over all its points answers
these questions by pruning boxes, and what it finds is verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import col, ship, slices, store_for

#: First and last letters beyond a-z that a run may hold.
ACCENTED = ("À", "ÿ")
ALPHABET = np.zeros(256, np.int16)
ALPHABET[ord("a") : ord("z") + 1] = range(26)
ALPHABET[0xC0:] = range(26, 26 + 64)
LETTERS = 26 + 64

CELL = 1 << 15
SAMPLE = 1 << 17
LEAF = 48
#: Word pairs compared at once; classes whose product is larger are matched through a table of strings.
PAIRS = 1 << 20
DENSE = 1 << 12

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- words ------------------------------------------------------------------------------------


def mended(key: str, runs: Counter, shortest: int, every: int | None) -> Iterator[tuple[str, int]]:
    """Words of a document; with ``every``, a letter is taken from the words that a checksum picks."""
    start = zlib.crc32(f"{key}:".encode())
    for word, times in runs.items():
        if every:
            h = zlib.crc32(word.encode(), start)
            if h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < shortest:
                    continue
        yield word, times


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, every: int | None = None) -> DataFrame:
    """``word, n`` of all words of at least ``shortest`` letters that occur at least ``least`` times overall.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF; only A-Z is lower-cased.  ``every`` simulates
    spelling errors: where it divides the crc32 of "<key>:<word>", one letter goes.  Null texts have no words; a null key reads
    as an empty string.  Repeated rows count again.  A task adds up the words of its batches before they are shuffled.
    """
    ship(docs.sparkSession)
    run_of = re.compile(f"[A-Za-z{ACCENTED[0]}-{ACCENTED[1]}]{{{shortest},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for part in slices(batch, "text"):
                for k, t in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if t:
                        runs = Counter(run_of.findall(t.translate(_LOWER) if not t.islower() else t))
                        for word, times in mended(k, runs, shortest, every):
                            counts[word] += times
                if len(counts) > 1 << 18:
                    yield batch_of()
        if counts:
            yield batch_of()

    rows = docs.select(F.coalesce(col(key).cast("string"), F.lit("")).alias("key"), col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def points(words: list[str]) -> np.ndarray:
    """Letter counts, one row per word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = ALPHABET[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].astype(np.int64)
    at = np.repeat(np.arange(len(words)), sizes) * LETTERS + letters
    flat = np.bincount(at, minlength=len(words) * LETTERS)
    # int16 holds the counts of all words but giants.
    kind = np.int16 if not len(words) or sizes.max() < 1 << 15 else np.int64
    return flat.reshape(len(words), LETTERS).astype(kind)


# --- cells ------------------------------------------------------------------------------------


@dataclass
class Split:
    letter: int
    most_left: int
    left: Split | int
    right: Split | int


def _cut(rows: np.ndarray) -> tuple[int, int] | None:
    """The letter and bound that halve the rows best, letters of large spread first."""
    spread = rows.std(axis=0)
    for letter in np.argsort(-spread, kind="stable")[:8]:
        if spread[letter] == 0:
            return None
        values = rows[:, letter]
        middle = int(np.median(values))
        for bound in (middle, middle - 1):
            left = int((values <= bound).sum())
            if len(rows) * 0.1 <= left <= len(rows) * 0.9:
                return int(letter), bound
    letter = int(np.argmax(spread))
    return letter, int(rows[:, letter].min())


def fit_cells(rows: np.ndarray, cells: int, names: Iterator[int]) -> Split | int:
    cut = _cut(rows) if cells > 1 and len(rows) > 1 else None
    if cut is None:
        return next(names)
    letter, bound = cut
    left = rows[:, letter] <= bound
    n_left = min(max(round(cells * float(left.mean())), 1), cells - 1)
    return Split(letter, bound, fit_cells(rows[left], n_left, names), fit_cells(rows[~left], cells - n_left, names))


def own_cell(tree: Split | int, rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    todo = [(tree, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            left = rows[at, node.letter] <= node.most_left
            todo += [(node.left, at[left]), (node.right, at[~left])]
    return out


def cells_in_reach(tree: Split | int, rows: np.ndarray, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
    """Cells whose box is at most one letter more and ``fewer`` letters less away, with the rows they concern."""
    wide = np.iinfo(np.int64).max
    todo = [(tree, np.arange(len(rows)), {}, np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64))]
    while todo:
        node, at, box, up, down = todo.pop()
        if isinstance(node, int):
            yield node, at
            continue
        value = rows[at, node.letter].astype(np.int64)
        low, high = box.get(node.letter, (0, wide))
        for child, edges in ((node.left, (low, min(high, node.most_left))), (node.right, (max(low, node.most_left + 1), high))):
            up_now = up - np.maximum(low - value, 0) + np.maximum(edges[0] - value, 0)
            down_now = down - np.maximum(value - high, 0) + np.maximum(value - edges[1], 0)
            near = (up_now <= 1) & (down_now <= fewer)
            if near.any():
                todo.append((child, at[near], box | {node.letter: edges}, up_now[near], down_now[near]))


# --- search in a cell ---------------------------------------------------------------------------


class PointTree:
    """A k-d tree over distinct points; leaves hold at most LEAF of them unless they are all alike."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.norms = (rows.astype(np.float64) ** 2).sum(axis=1)
        #: (low corner, high corner, rows of a leaf or None, children)
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray | None, tuple[int, ...]]] = []
        todo: list[tuple[np.ndarray, int]] = [(np.arange(len(rows)), -1)]
        children: list[list[int]] = []
        while todo:
            at, above = todo.pop()
            here, part = len(self.nodes), rows[at]
            children.append([])
            if above >= 0:
                children[above].append(here)
            cut = _cut(part) if len(at) > LEAF else None
            self.nodes.append((part.min(axis=0), part.max(axis=0), at if cut is None else None, ()))
            if cut is not None:
                left = part[:, cut[0]] <= cut[1]
                todo += [(at[left], here), (at[~left], here)]
        self.nodes = [(*node[:3], tuple(c)) for node, c in zip(self.nodes, children, strict=True)]

    def search(self, asked: np.ndarray, fewer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (asked row, own row) where the own row has one letter more and ``fewer`` letters less."""
        norms, distance = (asked.astype(np.float64) ** 2).sum(axis=1), 1 + fewer
        todo = [(0, np.arange(len(asked)))]
        while todo:
            here, at = todo.pop()
            low, high, own, children = self.nodes[here]
            part = asked[at]
            near = (np.maximum(low - part, 0).sum(axis=1) <= 1) & (np.maximum(part - high, 0).sum(axis=1) <= fewer)
            at = at[near]
            if not len(at):
                continue
            if own is None:
                todo += [(child, at) for child in children]
                continue
            # Counts are whole numbers: a squared distance of one or two means that many steps of one letter.
            for start in range(0, len(own), 4096):
                block = own[start : start + 4096]
                for first in range(0, len(at), 4096):
                    some = at[first : first + 4096]
                    squared = norms[some][:, None] + self.norms[block][None, :] - 2 * (asked[some].astype(np.float64) @ self.rows[block].T.astype(np.float64))
                    a, b = np.nonzero(squared == distance)
                    if len(a):
                        yield some[a], block[b]


class Words:
    """Words of one length, grouped by their points."""

    def __init__(self, words: list[str], counts: np.ndarray) -> None:
        rows = points(words)
        self.points, self.point_of = np.unique(rows, axis=0, return_inverse=True)
        self.point_of = self.point_of.reshape(-1)
        order = np.argsort(self.point_of, kind="stable")
        self.words = [words[i] for i in order]
        self.counts = counts[order]
        self.ends = np.cumsum(np.bincount(self.point_of, minlength=len(self.points)))
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.sizes = self.ends - self.starts
        self.letters = np.frombuffer("".join(self.words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one replaced or, if b is longer, one inserted letter apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    opening = np.cumprod(a == b[:, :-1], axis=1, dtype=np.int64).sum(axis=1)
    closing = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int64).sum(axis=1)
    return opening + closing >= a.shape[1]


def _by_table(short: Words, i: int, long: Words, j: int) -> Iterator[tuple[int, int]]:
    """One-edit pairs of two large groups of words: drop the letter that one has more and look the rest up."""
    change = long.points[j].astype(np.int64) - short.points[i]
    more = int(np.flatnonzero(change > 0)[0])
    letter = chr(int(np.flatnonzero(ALPHABET == more)[-1])) if more else "a"
    lost = np.flatnonzero(change < 0)
    gone = (chr(int(np.flatnonzero(ALPHABET == int(lost[0]))[-1])) if lost[0] else "a") if len(lost) else ""
    table = {short.words[p]: p for p in range(short.starts[i], short.ends[i])}
    for q in range(long.starts[j], long.ends[j]):
        word, found = long.words[q], set()
        for at, x in enumerate(word):
            if x == letter:
                p = table.get(word[:at] + gone + word[at + 1 :])
                if p is not None and p not in found:
                    found.add(p)
                    yield p, q


def near_pairs(asked: Words, own: Words, same: bool, tree: PointTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asked word, own word) one edit apart; with ``same`` both are one set and each pair comes once."""
    fewer = int(asked.letters.shape[1] == own.letters.shape[1])
    step = max(PAIRS // max(asked.letters.shape[1] // 16, 1), 1)
    for i, j in tree.search(asked.points, fewer):
        if same:
            i, j = i[i < j], j[i < j]
        products = asked.sizes[i] * own.sizes[j]
        for place in np.flatnonzero(products > DENSE):
            found = list(_by_table(asked, int(i[place]), own, int(j[place])))
            if found:
                yield np.array([p for p, _ in found]), np.array([q for _, q in found])
        small = products <= DENSE
        i, j, products = i[small], j[small], products[small]
        sums = np.cumsum(products)
        start = 0
        while start < len(i):
            done = sums[start - 1] if start else 0
            end = max(int(np.searchsorted(sums, done + step, side="right")), start + 1)
            n = products[start:end]
            pair = np.repeat(np.arange(start, end), n)
            within = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            a = asked.starts[i[pair]] + within // own.sizes[j[pair]]
            b = own.starts[j[pair]] + within % own.sizes[j[pair]]
            good = _one_edit(asked.letters[a], own.letters[b])
            if good.any():
                yield a[good], b[good]
            start = end


class _Best:
    """Per word the number of near words, and the one of largest n (ties: smallest word)."""

    def __init__(self, own: Words) -> None:
        self.own = own
        self.near = np.zeros(len(own.words), np.int64)
        self.best: list[tuple[int, str] | None] = [None] * len(own.words)

    def add(self, at: np.ndarray, other: Words, partners: np.ndarray) -> None:
        self.near += np.bincount(at, minlength=len(self.near))
        # Only the largest partner of a word within these pairs is looked at one by one.
        order = np.lexsort((other.counts[partners], at))
        at, partners = at[order], partners[order]
        top = other.counts[partners]
        last = np.flatnonzero(np.append(at[1:] != at[:-1], True))
        peak = np.repeat(top[last], np.diff(np.concatenate([[-1], last])))
        for word, partner in zip(at[top == peak].tolist(), partners[top == peak].tolist(), strict=True):
            made, old = (-int(other.counts[partner]), other.words[partner]), self.best[word]
            if old is None or made < old:
                self.best[word] = made

    def table(self, n: list[int | None]) -> pa.Table:
        best = self.best
        return pa.table(
            {
                "word": pa.array(self.own.words, pa.string()),
                "n": pa.array(n, pa.int64()),
                "n_near": pa.array(self.near, pa.int64()),
                "minus_n": pa.array([b[0] if b else None for b in best], pa.int64()),
                "other": pa.array([b[1] if b else None for b in best], pa.string()),
            }
        )


_FOUND = "word string, n bigint, n_near bigint, minus_n bigint, other string"


def _search_cell(rows: pa.Table) -> pa.Table:
    """Members of a cell against each other and against the words that ask it."""
    kinds = np.array(rows.column("asks").to_pylist())
    words, counts = np.array(rows.column("word").to_pylist(), object), np.array(rows.column("n").to_pylist(), np.int64)
    if not (kinds == 0).any():
        return pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("minus_n", pa.int64()), ("other", pa.string())]).empty_table()
    own = Words(list(words[kinds == 0]), counts[kinds == 0])
    tree, best, tables = PointTree(own.points), _Best(own), []
    for a, b in near_pairs(own, own, True, tree):
        best.add(a, own, b)
        best.add(b, own, a)
    for kind in (1, 2):
        if (kinds == kind).any():
            asked = Words(list(words[kinds == kind]), counts[kinds == kind])
            theirs = _Best(asked)
            for a, b in near_pairs(asked, own, False, tree):
                best.add(b, asked, a)
                theirs.add(a, own, b)
            made = theirs.table([None] * len(asked.words))
            tables.append(made.filter(pa.array(theirs.near > 0)))
    return pa.concat_tables([best.table(own.counts.tolist()), *tables])


# --- all together -------------------------------------------------------------------------------


def _forest(words: DataFrame, cell: int, sample: int) -> dict[int, Split | int]:
    """A tree of cells per word length, fitted on the driver to a sample of the words drawn by hash.

    The sample has some ``sample`` words, or sixteen for each cell if those are more.
    """
    sizes = {r["size"]: r["words"] for r in words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("words")).toLocalIterator()}
    total = sum(sizes.values())
    wanted = max(sample, 16 * (total // cell + 1))
    large = [size for size, n in sizes.items() if n > cell]
    drawn: dict[int, list[str]] = {size: [] for size in large}
    if large:
        share = F.pmod(F.xxhash64(F.lit(1), F.col("word")), F.lit(1 << 30)) < int((1 << 30) * min(wanted / total, 1.0))
        for row in words.filter(F.length("word").isin(large) & share).select("word").toLocalIterator():
            drawn[len(row["word"])].append(row["word"])
    names = iter(range(1 << 62))
    forest: dict[int, Split | int] = {}
    for size in sorted(sizes):
        rows = sorted(drawn.get(size, []))
        forest[size] = fit_cells(points(rows), -(-sizes[size] // cell), names) if rows else next(names)
    return forest


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, n, n_near, best_n, best`` for a table of distinct ``word, n``; best is the near word of largest n."""
    spark = ship(words.sparkSession)
    forest = spark.sparkContext.broadcast(_forest(words, cell, sample))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            names, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            for at, word in enumerate(names):
                by_size.setdefault(len(word), []).append(at)
            cells, asks, rows = [], [], []
            for size, at in by_size.items():
                at = np.array(at)
                here = points([names[i] for i in at])
                own = own_cell(trees[size], here)
                found = [(own, 0, at)]
                found += [(np.full(len(some), c)[own[some] < c], 1, at[some[own[some] < c]]) for c, some in cells_in_reach(trees[size], here, 1)]
                if size + 1 in trees:
                    found += [(np.full(len(some), c), 2, at[some]) for c, some in cells_in_reach(trees[size + 1], here, 0)]
                for c, kind, some in found:
                    cells.append(c)
                    asks.append(np.full(len(some), kind))
                    rows.append(some)
            if rows:
                order = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(cells), pa.int64()),
                        pa.array(np.concatenate(asks).astype(np.int32), pa.int32()),
                        pa.array([names[i] for i in order], pa.string()),
                        pa.array([counts[i] for i in order], pa.int64()),
                    ],
                    ["cell", "asks", "word", "n"],
                )

    dealt = words.select("word", "n").mapInArrow(deal, "cell bigint, asks int, word string, n bigint")
    found = dealt.groupBy("cell").applyInArrow(_search_cell, _FOUND)
    best = F.min(F.when(F.col("minus_n").isNotNull(), F.struct("minus_n", "other")))
    merged = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n", "n_near", (-F.col("best.minus_n")).alias("best_n"), F.col("best.other").alias("best"))


def group_variants(words: DataFrame, times: int = 10, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table of distinct ``word, n``.

    A word's form is its near word (one letter inserted, deleted or replaced) of largest n, ties to the smallest in code-point
    order, if that n is at least ``times`` (two or more) its own; the root is the last form on the way.  Frequencies grow by that factor on
    every step, so there is no circle and the doubling of steps ends after a few rounds.  All pairs are found:
    cells and boxes only prune.  An empty table gives an empty table.
    """
    if times < 2:
        raise ValueError("times must be two or more, or forms may go in circles")
    store = store_for(words)
    near = store.keep("near", near_words(words, cell, sample))
    formed = F.col("best_n") >= times * F.col("n")
    steps = store.keep("steps-0", near.filter(formed).select("word", F.col("best").alias("root")))
    for turn in range(1, 64):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = steps.join(ahead, "root", "left")
        after = store.keep(f"steps-{turn}", joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not after.filter("moved").isEmpty()
        store.remove([f"steps-{turn - 1}"])
        steps = after.select("word", "root")
        if not moved:
            break
    rows = near.join(steps.withColumnRenamed("root", "last"), "word", "left")
    result = rows.select(
        "word",
        F.when(formed, F.col("best")).alias("form"),
        F.coalesce("last", "word").alias("root"),
        "n",
        "n_near",
        F.when(formed, F.col("best_n")).alias("form_n"),
    )
    return result
