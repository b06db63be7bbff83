"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and shared; every row is put into the leaf it descends to.  A
query walks the tree best bin first: a priority queue holds branches by the inner product with their
centres.  The number of leaves to visit is widened until the recall, measured on calibration
queries against all rows, reaches the target.  Queries meet rows in blocks of a leaf whose size is
bounded on both sides, and candidates are scored exactly.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.common import col, ship, store_for
from cartwright.sources.store import ParquetStore

SAMPLE_ROWS = 1 << 15
BRANCHES, LEAF_ROWS, STEPS = 16, 64, 12
CALIBRATION_QUERIES, TARGET_RECALL = 256, 0.96
# Rows of a leaf, and queries to it, that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 1024
# Vectors of a length with so many rows at most are compared with all of that length.
SMALL_LENGTH = 4096
_LOG = logging.getLogger(__name__)


# --- the tree ---------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number; ``children`` of a leaf is empty, ``leaf`` of an inner node is -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def descend(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every level."""
        out = np.empty(len(rows), np.int32)
        pending = [(0, np.arange(len(rows)))]
        while pending:
            at, members = pending.pop()
            if not len(members):
                continue
            kids = self.children[at]
            if not kids:
                out[members] = self.leaf[at]
                continue
            nearest = _nearest(rows[members], self.centres[kids])
            pending += [(kid, members[nearest == i]) for i, kid in enumerate(kids)]
        return out

    def visits(self, query: np.ndarray, limit: int) -> list[int]:
        """The first ``limit`` leaves, best bin first."""
        nearness = self.centres @ query
        queue, found = [(0.0, 0)], []
        while queue and len(found) < limit:
            _, at = heappop(queue)
            if self.children[at]:
                for kid in self.children[at]:
                    heappush(queue, (-nearness[kid], kid))
            else:
                found.append(self.leaf[at])
        return found


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * rows @ centres.T, axis=1)


def _k_means(rows: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    centres = rows[random.choice(len(rows), k, replace=False)].copy()
    for _ in range(STEPS):
        nearest = _nearest(rows, centres)
        for i in np.unique(nearest):
            centres[i] = rows[nearest == i].mean(axis=0)
    return centres


def fit_tree(sample: np.ndarray, seed: int = 7) -> Tree:
    """Split the sample by k-means until a part has LEAF_ROWS rows or cannot be split."""
    random = np.random.default_rng(seed)
    centres, children, leaf = [sample.mean(axis=0)], [[]], [-1]
    pending, leaves = [(0, sample)], 0
    while pending:
        at, rows = pending.pop()
        distinct = np.unique(rows, axis=0) if len(rows) > LEAF_ROWS else rows
        k = min(BRANCHES, -(-len(rows) // LEAF_ROWS), len(distinct))
        parts = []
        if len(rows) > LEAF_ROWS and k > 1:
            found = _k_means(distinct, k, random)
            nearest = _nearest(rows, found)
            parts = [(found[i], rows[nearest == i]) for i in range(k) if (nearest == i).any()]
        if len(parts) < 2:
            leaf[at] = leaves
            leaves += 1
            continue
        for centre, part in parts:
            children[at].append(len(centres))
            pending.append((len(centres), part))
            centres.append(centre)
            children.append([])
            leaf.append(-1)
    return Tree(np.array(centres), children, leaf)


# --- scoring ----------------------------------------------------------------------------------


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the same order, so equal rows score equal."""
    return np.ascontiguousarray(rows * query).sum(axis=1)


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of the block for each query: all that may be among its k best."""
    vectors, ids, numbers = _matrix(rows["vector"]), rows["vec_id"].to_numpy(), rows["row"].to_numpy()
    asked, own, query_ids = _matrix(queries["vector"]), queries["row"].to_numpy(), queries["vec_id"].to_numpy()
    rough = asked @ vectors.T
    picked, exact_of = [], []
    for at in range(len(asked)):
        others = numbers != own[at]
        scores = np.where(others, rough[at], -np.inf)
        if len(scores) > k + 1:
            # Rounding of the fast product is far below this slack; ties are settled by exact scores.
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = np.flatnonzero(scores >= cut - 1e-9 * max(1.0, abs(cut)))
        else:
            near = np.flatnonzero(others)
        exact = exact_scores(asked[at], vectors[near])
        first = np.lexsort((numbers[near], ids[near], -exact))[:k]
        picked.append(near[first])
        exact_of.append(exact[first])
    repeats = [len(chosen) for chosen in picked]
    chosen = np.concatenate(picked) if picked else np.empty(0, np.int64)
    return pd.DataFrame(
        {
            "query_row": np.repeat(own, repeats), "query_id": np.repeat(query_ids, repeats), "row": numbers[chosen], "vec_id": ids[chosen],
            "score": np.concatenate(exact_of) if exact_of else np.empty(0),
        }
    )


_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# --- DataFrames -------------------------------------------------------------------------------


def usable_rows(table: DataFrame, key: str, vector: str, store: ParquetStore) -> DataFrame:
    """``row, vec_id, vector`` of the vectors that take part: finite and not zero."""
    rows = table.select(
        F.monotonically_increasing_id().alias("row"), col(key).cast("bigint").alias("vec_id"), col(vector).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return store.keep("vectors", rows.filter(finite & F.exists("vector", lambda x: x != 0)))


def assign_leaves(rows: DataFrame, tree) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = tree.value.descend(_matrix(batch.column("vector").to_pandas()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], ["row", "vec_id", "vector", "leaf"])

    return rows.mapInArrow(run, "row bigint, vec_id bigint, vector array<double>, leaf int")


def calibrated_visits(index: DataFrame, queries: DataFrame, tree, k: int, target: float) -> tuple[int, float]:
    """Leaves to visit, doubled until recall over the calibration queries reaches the target, and that recall.

    Calibration queries, a bounded number drawn by hash, are compared with all rows.
    """
    drawn = queries.orderBy(F.xxhash64("row"), "row").limit(CALIBRATION_QUERIES).toPandas()
    if drawn.empty:
        return 1, 1.0
    shared = queries.sparkSession.sparkContext.broadcast(drawn)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[start : start + BLOCK_ROWS]
                yield best_in_block(shared.value, part, k).merge(part[["row", "leaf"]], on="row")

    truth = _ranked(index.select("row", "vec_id", "vector", "leaf").mapInPandas(run, _FOUND + ", leaf int"), k)
    # At most CALIBRATION_QUERIES times k rows.
    truth = truth.select("query_row", "leaf").toPandas()
    order = {row: {leaf: i for i, leaf in enumerate(tree.value.visits(q, tree.value.leaves))} for row, q in zip(drawn["row"], _matrix(drawn["vector"]))}
    at = np.array([order[row][leaf] for row, leaf in zip(truth["query_row"], truth["leaf"])])
    visits = 1
    while visits < tree.value.leaves and (at < visits).mean() < target:
        visits = min(2 * visits, tree.value.leaves)
    return visits, float((at < visits).mean()) if len(at) else 1.0


def search(
    table: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", target: float = TARGET_RECALL
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each row whose key is divisible by ``every``.

    Nearness is the inner product in double precision; ties go to the smaller key, and a query's own row
    is no candidate.  With fewer candidates all are returned, so that leaves are widened until k rows can
    be found.  Null and zero vectors and those with null or non-finite components take no part.  Vectors have an inner
    product with those of their own length only: each length with more than ``SMALL_LENGTH`` rows is searched in a tree of
    its own, all others are compared whole.  Repeated keys are rows of their own.  An empty table gives an empty result.
    """
    spark = ship(table.sparkSession)
    store = store_for(table)
    vectors = usable_rows(table, key, vector, store)
    length = F.size("vector")
    large = vectors.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > SMALL_LENGTH)
    # Each of these has thousands of rows, so the list is short against the table.
    lengths = sorted(row["length"] for row in large.collect())
    found = [_search_tree(vectors.filter(length == n), store, f"{n}-", k, every, target) for n in lengths]
    few = vectors.filter(~length.isin(lengths)) if lengths else vectors
    index = store.keep("few-index", few.withColumn("leaf", length))
    asked = store.keep("few-asked", index.filter(F.col("vec_id") % every == 0))
    found.append(_meet(index, asked, store, "few-", k))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    return _ranked(rows, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_tree(rows: DataFrame, store: ParquetStore, name: str, k: int, every: int, target: float) -> DataFrame:
    """Candidates for the queries among vectors of one length: leaves are visited best bin first."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("vector").toPandas()
    fitted = fit_tree(_matrix(sample["vector"])) if len(sample) else Tree(np.zeros((1, 1)), [[]], [0])
    tree = spark.sparkContext.broadcast(fitted)
    index = store.keep(f"{name}index", assign_leaves(rows, tree))
    queries = index.filter(F.col("vec_id") % every == 0).select("row", "vec_id", "vector")
    visits, recall = calibrated_visits(index, queries, tree, k, target)
    _LOG.info("%d of %d leaves for a recall of %.4f over the calibration queries", visits, tree.value.leaves, recall)
    sizes = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"))
    # As many rows as the tree has leaves, which its sample bounds.
    by_leaf = {row["leaf"]: row["rows"] for row in sizes.collect()}
    held = spark.sparkContext.broadcast(by_leaf)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, leaves = [], []
            for at, query in enumerate(_matrix(batch.column("vector").to_pandas()) if batch.num_rows else ()):
                order = tree.value.visits(query, visits)
                if sum(held.value.get(leaf, 0) for leaf in order) <= k:
                    order = tree.value.visits(query, tree.value.leaves)
                used = [leaf for leaf in order if leaf in held.value]
                picked += [at] * len(used)
                leaves += used
            chosen = batch.take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(leaves, pa.int32())], ["row", "vec_id", "vector", "leaf"])

    asked = store.keep(f"{name}asked", queries.mapInArrow(walk, "row bigint, vec_id bigint, vector array<double>, leaf int"))
    return _meet(index, asked, store, name, k)


def _meet(index: DataFrame, asked: DataFrame, store: ParquetStore, name: str, k: int) -> DataFrame:
    """Queries and rows of equal leaves, compared in blocks."""
    sizes = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"))
    asked_sizes = asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("queries"))
    parts = store.keep(
        f"{name}parts",
        sizes.join(asked_sizes, "leaf").select(
            "leaf", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("row_parts"), F.ceil(F.col("queries") / BLOCK_QUERIES).cast("int").alias("query_parts")
        ).coalesce(1),
    )
    # A leaf with many rows or queries is cut on both sides; every part meets every part of the other side.
    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        placed = side.join(F.broadcast(parts), "leaf").withColumn(own, F.pmod(F.xxhash64("row"), F.col(f"{own}s")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop(f"{own}s", f"{other}s")

    left = cut(asked, "query_part", "row_part").groupBy("leaf", "row_part", "query_part")
    right = cut(index, "row_part", "query_part").groupBy("leaf", "row_part", "query_part")

    def meet(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or there.empty:
            return pd.DataFrame({"query_row": [], "query_id": [], "row": [], "vec_id": [], "score": []})
        return best_in_block(asking, there, k)

    return left.cogroup(right).applyInPandas(meet, _FOUND)
