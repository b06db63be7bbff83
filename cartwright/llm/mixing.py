"""Mixing sources to target weights, in DataFrame functions only.

A source with token share p gets the weight p^t, normalised.  t is found by section search over
aggregates of the source table, for a target entropy or for a limit on how often a source may be
repeated.  Each source then runs through a new permutation of its documents per pass until its
budget is met, and its running total places every copy in a block; a block holds all sources in the
proportions of their weights and is permuted itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.common import col, free_name, store_for
from cartwright.sources.store import ParquetStore

BLOCK_TOKENS = 1 << 15
SEED = 17
# Rows of one step of a running total, and steps under one parent: no window grows with a source.
ROWS_PER_STEP_BITS, STEPS_PER_PARENT_BITS = 6, 12
# Inner points of a search interval that one aggregate tries: four bisections at once.
POINTS, ROUNDS, STEEPEST = 15, 9, 16.0
# Where widening ends: shares that differ by a millionth then differ by a factor of e in weight.
WIDEST = float(1 << 20)


@dataclass(frozen=True)
class Target:
    """Exactly one of the two: entropy in nats, or the most passes over any source.

    ``budget`` is the number of tokens to emit; without one every source is passed at least once.
    """

    entropy: float | None = None
    repetitions: float | None = None
    budget: float | None = None

    def __post_init__(self) -> None:
        if (self.entropy is None) == (self.repetitions is None):
            raise ValueError("give a target entropy or a repetition limit")


def word_count(text: Column) -> Column:
    """Blanks and line ends plus one; 0 for null and empty texts."""
    text = text.cast("string")
    bare = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(F.octet_length(text) > 0, F.octet_length(text) - F.octet_length(bare) + 1).otherwise(0).cast("bigint")


def _log_weight(exponent: float, top: float) -> Column:
    """Taken against the largest share, so that the sum of weights never vanishes."""
    return (F.log("share") - F.lit(log(top))) * F.lit(exponent)


def _measured(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """Entropy, and the largest and least ratio of weight to share, for each exponent: one aggregate."""
    columns, top = [], _top(shares)
    for i, t in enumerate(exponents):
        log_weight = _log_weight(t, top)
        columns += [
            F.sum(F.exp(log_weight)).alias(f"total_{i}"),
            F.sum(F.exp(log_weight) * log_weight).alias(f"moment_{i}"),
            F.max(log_weight - F.log("share")).alias(f"most_{i}"),
            F.min(log_weight - F.log("share")).alias(f"least_{i}"),
        ]
    row = shares.agg(*columns).first()
    out = []
    for i in range(len(exponents)):
        total = row[f"total_{i}"]
        log_total = log(total)
        out.append((log_total - row[f"moment_{i}"] / total, row[f"most_{i}"] - log_total, row[f"least_{i}"] - log_total))
    return out


def _top(shares: DataFrame) -> float:
    return shares.agg(F.max("share")).first()[0]


def find_exponent(shares: DataFrame, target: Target, total_tokens: float) -> float:
    """Bisect for the least exponent that is steep enough; both measures fall as it grows.

    For a repetition limit the range is 0 to 1.  For an entropy it begins with 0 to 16 and is doubled until it holds the
    target, or until only the sources of the largest share are left, whose entropy no exponent lowers.
    """

    def steep_enough(measure: tuple[float, float, float]) -> bool:
        entropy, most, least = measure
        if target.entropy is not None:
            return entropy <= target.entropy
        log_budget = -least if target.budget is None else log(max(target.budget, 1e-9) / total_tokens)
        return most + log_budget <= log(target.repetitions) + 1e-12

    low, high = 0.0, STEEPEST if target.entropy is not None else 1.0
    if steep_enough(_measured(shares, [low])[0]):
        return low
    if target.entropy is not None:
        before = _measured(shares, [high])[0]
        while not steep_enough(before) and high < WIDEST:
            high *= 2
            now = _measured(shares, [high])[0]
            if abs(now[0] - before[0]) < 1e-12:
                break
            before = now
    for _ in range(ROUNDS):
        points = [low + (high - low) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
        enough = [steep_enough(m) for m in _measured(shares, points)]
        first = enough.index(True) if True in enough else POINTS
        low, high = ([low, *points][first], [*points, high][first])
    return high


def source_weights(rows: DataFrame, target: Target, store: ParquetStore) -> tuple[DataFrame, float]:
    """``source_key, documents, tokens, bare, share, weight, source_budget, passes`` and the exponent.

    Sources without tokens have share and weight 0 and are passed once.  ``bare`` documents have no tokens.
    """
    counts = [F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") == 0).alias("bare")]
    totals = store.keep("sources", rows.groupBy("source_key").agg(*counts))
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(max(everything, 1)))
    used = shares.filter("tokens > 0")
    if not everything:
        return shares.selectExpr("*", "0D AS weight", "0D AS source_budget", "1 AS passes"), 1.0
    exponent = find_exponent(used, target, everything)
    _, _, least = _measured(used, [exponent])[0]
    power = F.exp(_log_weight(exponent, _top(used)))
    total = used.agg(F.sum(power)).first()[0]
    budget = target.budget if target.budget is not None else everything * exp(-least)
    weighed = shares.withColumn("weight", F.when(F.col("tokens") > 0, power / F.lit(total)).otherwise(0.0))
    weighed = weighed.withColumn("source_budget", F.col("weight") * F.lit(float(budget)))
    # A budget that misses whole passes by rounding alone is no further pass.
    passes = F.when(F.col("tokens") > 0, F.ceil(F.col("source_budget") / F.col("tokens") - 1e-9)).otherwise(1)
    return store.keep("weights", weighed.withColumn("passes", passes.cast("int"))), exponent


def _running_starts(rows: DataFrame, store: ParquetStore, layer: str = "steps") -> DataFrame:
    """Add ``start``, the tokens before a copy in its pass, in three levels of bounded windows."""
    by_step = W.partitionBy("source_key", "pass", "step")
    totals = rows.groupBy("source_key", "pass", "step").agg(F.sum("tokens").alias("tokens"))
    totals = store.keep(layer, totals.withColumn("parent", F.shiftright("step", STEPS_PER_PARENT_BITS)))
    before = (W.unboundedPreceding, -1)
    parents = totals.groupBy("source_key", "pass", "parent").agg(F.sum("tokens").alias("tokens"))
    over_parents = W.partitionBy("source_key", "pass").orderBy("parent").rowsBetween(*before)
    parents = parents.withColumn("base", F.coalesce(F.sum("tokens").over(over_parents), F.lit(0))).drop("tokens")
    over_steps = W.partitionBy("source_key", "pass", "parent").orderBy("step").rowsBetween(*before)
    steps = totals.withColumn("within", F.coalesce(F.sum("tokens").over(over_steps), F.lit(0)))
    steps = steps.join(parents, ["source_key", "pass", "parent"]).selectExpr("source_key", "pass", "step", "base + within AS base")
    inner = F.coalesce(F.sum("tokens").over(by_step.orderBy("rank", "row_number").rowsBetween(*before)), F.lit(0))
    placed = rows.withColumn("inner", inner).join(steps, ["source_key", "pass", "step"])
    return placed.withColumn("start", F.col("base") + F.col("inner"))


def _told_apart(rows: DataFrame, store: ParquetStore) -> DataFrame:
    """Give the second and later of equal rows an identity of their own, so that they spread like others.

    They are numbered in order of rows, as running totals of ones.  As equal rows stand for each other,
    the result does not depend on which of them gets which number.
    """
    group = F.struct("source_key", "identity").alias("source_key")
    step = F.shiftright("row_number", ROWS_PER_STEP_BITS).alias("step")
    ones = rows.select(group, F.lit(0).alias("pass"), step, F.lit(0).alias("rank"), "row_number", F.lit(1).alias("tokens"), F.col("tokens").alias("own_tokens"))
    numbered = _running_starts(ones, store, "repeats")
    identity = F.when(F.col("start") == 0, F.col("source_key.identity")).otherwise(F.xxhash64("source_key.identity", "start"))
    told = numbered.select("row_number", F.col("source_key.source_key").alias("source_key"), F.col("own_tokens").alias("tokens"), identity.alias("identity"))
    return store.keep("told_apart", told)


def plan_copies(
    rows: DataFrame, target: Target, store: ParquetStore, block_tokens: int = BLOCK_TOKENS, seed: int = SEED
) -> DataFrame:
    """``row_number, pass, block, position`` for every copy to emit.

    ``rows`` hold ``row_number, source_key, tokens, identity``.
    """
    rows = _told_apart(rows, store)
    weights, _ = source_weights(rows, target, store)
    budget, bare = weights.agg(F.sum("source_budget"), F.sum(F.col("bare") * F.col("passes"))).first()
    blocks = max(1, ceil((budget or 0) / block_tokens), ceil((bare or 0) / block_tokens))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("documents").cast("double"))).cast("int") - ROWS_PER_STEP_BITS)
    weights = weights.select("source_key", "tokens", "weight", "source_budget", "passes", bits.alias("bits"))
    weights = weights.withColumnRenamed("tokens", "source_tokens")
    copies = rows.join(weights.filter("passes > 0"), "source_key").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    rank = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "pass", "identity"), 1)
    copies = copies.withColumn("rank", rank).withColumn("step", F.expr("CASE WHEN bits = 0 THEN 0L ELSE shiftright(rank, 63 - bits) END"))
    placed = _running_starts(copies, store).withColumn("start", F.col("start") + F.col("pass") * F.col("source_tokens"))
    # A copy that begins within the budget is emitted; one without tokens weighs nothing and comes in any block.
    emitted = placed.filter((F.col("start") < F.col("source_budget") - 1e-6) | (F.col("source_tokens") == 0) | (F.col("tokens") == 0) & (F.col("pass") == 0))
    share = F.col("weight") * F.lit(block_tokens)
    anywhere = F.pmod(F.xxhash64(F.lit(seed), "source_key", "rank"), F.lit(blocks))
    block = F.when(F.col("tokens") > 0, F.floor(F.col("start") / share)).otherwise(anywhere).cast("bigint")
    emitted = emitted.select("row_number", "pass", "rank", block.alias("block"))
    inside = W.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "block", "rank"), "pass", "row_number")
    return emitted.select("row_number", "pass", "block", (F.row_number().over(inside) - 1).alias("position"))


def _identified(docs: DataFrame, key: str, text: str, source: str, tokens: str | None, row: str) -> DataFrame:
    return docs.select(
        F.col(row).alias("row_number"),
        col(key).alias("row_key"),
        col(source).alias("row_source"),
        F.when(col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), col(source).cast("string"))).alias("source_key"),
        (F.greatest(F.coalesce(col(tokens), F.lit(0)), F.lit(0)).cast("bigint") if tokens else word_count(col(text))).alias("tokens"),
        F.xxhash64(col(key), col(text)).alias("identity"),
    )


def schedule(
    docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source", tokens: str | None = None,
    block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
) -> DataFrame:
    """Every copy to emit: ``<key>, <source>, n_tokens, pass, block, position``.

    Tokens are counted by ``word_count`` unless a column is named.  A null source is a source of its own.
    Null and empty texts have no tokens and come once, with the pass, in any block; a text longer than a block starts in
    one and counts whole.  Repeated rows are
    rows of their own.  An empty table gives an empty result.  Equal input gives equal output.
    """
    store = store_for(docs)
    rows = store.keep("rows", _identified(docs.withColumn("mix_row", F.monotonically_increasing_id()), key, text, source, tokens, "mix_row"))
    copies = plan_copies(rows, target, store, block_tokens, seed)
    named = rows.select("row_number", F.col("row_key").alias(key), F.col("row_source").alias(source), F.col("tokens").alias("n_tokens"))
    return copies.join(named, "row_number").select(col(key), col(source), "n_tokens", "pass", "block", "position")


def mix(
    docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source", tokens: str | None = None,
    block_tokens: int = BLOCK_TOKENS, seed: int = SEED, store: ParquetStore | None = None,
) -> DataFrame:
    """The documents themselves, a row per copy, with their own columns only, in the order of the schedule.

    Partitions, and so the files written of them, follow each other by block and position, and rows inside too.  A text of
    any length is one row of one block, and is read from ``store``.
    """
    store = store or store_for(docs)
    row = free_name("stable_row", docs.columns)
    rows = store.keep("rows", docs.withColumn(row, F.monotonically_increasing_id()))
    narrow = store.keep("narrow", _identified(rows, key, text, source, tokens, row).drop("row_key", "row_source"))
    block, position = free_name("copy_block", docs.columns), free_name("copy_position", docs.columns)
    planned = plan_copies(narrow, target, store, block_tokens, seed)
    copies = store.keep("copies", planned.select(F.col("row_number").alias(row), F.col("block").alias(block), F.col("position").alias(position)))
    # Blocks are numbered from 0 without gaps, so their bounds need no sample of the rows.
    blocks = (copies.agg(F.max(block)).first()[0] or 0) + 1
    parts = min(blocks, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1))
    placed = rows.join(copies, row).repartitionById(parts, F.floor(F.col(block) * parts / F.lit(blocks)).cast("int"))
    return placed.sortWithinPartitions(block, position).select(*[col(name) for name in docs.columns])
