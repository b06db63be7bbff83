"""Rule-based row validation, parent checks and the valid / quarantine split.

A row's rejection reasons are an array of codes in rule order; an empty array means
the row is valid.  A rule whose predicate is NULL does not fire.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cartwright.functions.parsing import literal, named

LOCAL_REASONS = "local_reasons"
REASONS = "reasons"
ACCEPTED = "accepted"


@dataclass(frozen=True)
class Rule:
    """A rejection code and the SQL predicate that raises it."""

    code: str
    broken: str


@dataclass(frozen=True)
class TableRules:
    """How one table is parsed and judged.

    ``parse`` runs first and may produce working columns; ``rules`` see the raw text
    and the parsed columns; ``keep`` is the final typed projection.
    """

    name: str
    key: str
    parse: dict[str, str]
    rules: list[Rule]
    keep: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ParentLink:
    """A foreign key into a staged parent, optionally with "child not before parent"."""

    parent: DataFrame
    key: str
    code: str
    parent_time: str | None = None
    child_time: str | None = None
    time_code: str | None = None


def reason_array(rules: Iterable[Rule]) -> str:
    # Not array_compact: it is a lambda underneath and takes its whole subtree out of generated code.
    arms = ", ".join(f"CASE WHEN {rule.broken} THEN {literal(rule.code)} ELSE '' END" for rule in rules)
    return f"array_remove(array({arms}), '')"


def reason_text(column: str = REASONS) -> str:
    return f"array_join({column}, ';')"


def judge(raw: DataFrame, table: TableRules, carry: tuple[str, ...] = ()) -> DataFrame:
    """Parse every field once, then evaluate all rules over the parsed row."""
    parsed_rows = raw.selectExpr("*", *named(table.parse))
    return parsed_rows.selectExpr(*named(table.keep), *carry, f"{reason_array(table.rules)} AS {LOCAL_REASONS}")


def without_parents(judged: DataFrame) -> DataFrame:
    return judged.selectExpr("*", f"{LOCAL_REASONS} AS {REASONS}", f"size({LOCAL_REASONS}) = 0 AS {ACCEPTED}")


def with_parents(child: DataFrame, links: list[ParentLink]) -> DataFrame:
    """Add parent reasons: a parent that is absent or itself rejected breaks the key.

    Only key, verdict and time of the parent take part in the join.  There is no
    broadcast hint: Spark broadcasts a parent below its size threshold, and beyond it
    the left join shuffles and adaptive execution splits a skewed key.  A repeated
    parent repeats its children, which the row reconciliation check then reports.
    """
    joined = child
    broken, early = [], []
    for position, link in enumerate(links):
        key, verdict, time = (f"__p{position}_{part}" for part in ("key", "ok", "time"))
        columns = [f"{link.key} AS {key}", f"{ACCEPTED} AS {verdict}"]
        if link.parent_time:
            columns.append(f"{link.parent_time} AS {time}")
        parent = link.parent.selectExpr(*columns)
        joined = joined.join(parent, joined[link.key] == parent[key], "left")
        broken.append(Rule(link.code, f"NOT coalesce({verdict}, false)"))
        if link.parent_time:
            early.append(Rule(link.time_code, f"{link.child_time} < {time}"))
    reasons = f"concat({LOCAL_REASONS}, {reason_array(broken + early)})"
    checked = joined.selectExpr(*child.columns, f"{reasons} AS {REASONS}")
    return checked.selectExpr("*", f"size({REASONS}) = 0 AS {ACCEPTED}")


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(ACCEPTED).drop(LOCAL_REASONS, REASONS, ACCEPTED)


def locally_clean_rows(staged: DataFrame) -> DataFrame:
    """Rows without a reason of their own, whatever their parents look like."""
    return staged.filter(f"size({LOCAL_REASONS}) = 0").drop(LOCAL_REASONS, REASONS, ACCEPTED)


def quarantine(staged: dict[str, tuple[DataFrame, str]], carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per rejected row of any table: its table, key and all reasons."""
    return union_all(
        [
            rows.filter(f"NOT {ACCEPTED}").selectExpr(
                f"{literal(name)} AS source_table", f"{key} AS record_key", REASONS,
                f"{reason_text()} AS rejection_reasons", *carry,
            )
            for name, (rows, key) in staged.items()
        ]
    )


def reason_frequency(quarantined: DataFrame) -> DataFrame:
    return (
        quarantined.selectExpr("source_table", f"explode({REASONS}) AS reason")
        .groupBy("source_table", "reason")
        .count()
        .withColumnRenamed("count", "rejected_rows")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged
