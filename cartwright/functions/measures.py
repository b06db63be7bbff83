"""Mergeable measures for grouped reports that count distinct entities.

A report such as "orders, customers and paid customers per day" needs several
distinct counts.  Written as COUNT(DISTINCT ...) each of them multiplies the rows
before the shuffle.  Here every measure says how to fold rows into one partial per
(group, entity) and how to fold those partials into the group, so any number of
distinct counts costs one shuffle on (group, entity) and one small shuffle on the
group.  Both aggregations combine on the map side, so a group or an entity that
holds a large part of the rows arrives already reduced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions.parsing import exprs

_ENTITY = "__entity"


@dataclass(frozen=True)
class Measure:
    """Partials per (group, entity), and their merge per group with ``{partial}`` slots.

    ``folds`` names the partials of one entity that are not added up when several are made one.
    """

    partials: dict[str, str]
    merge: str
    folds: dict[str, str] = field(default_factory=dict)


def row_count() -> Measure:
    return Measure({"n": "count(1)"}, "coalesce(sum({n}), 0)")


def rows_where(condition: str) -> Measure:
    """Number of matching rows; NULL (not zero) over an empty input."""
    return Measure({"n": f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"}, "sum({n})")


def total(amount: str, scale: int | None = 2) -> Measure:
    merge = "sum({s})" if scale is None else f"round(sum({{s}}), {scale})"
    return Measure({"s": f"sum({amount})"}, merge)


def total_where(condition: str, amount: str, scale: int = 2) -> Measure:
    return total(f"CASE WHEN {condition} THEN {amount} ELSE 0 END", scale)


def mean(amount: str, condition: str = "true", scale: int = 2) -> Measure:
    value = f"CASE WHEN {condition} THEN {amount} END"
    return Measure(
        {"s": f"sum({value})", "n": f"count({value})"}, f"round(sum({{s}}) / nullif(sum({{n}}), 0), {scale})"
    )


def entities() -> Measure:
    return Measure({}, f"count({_ENTITY})")


def entities_where(condition: str, at_least: int = 1) -> Measure:
    """Distinct entities with at least this many matching rows."""
    return Measure(
        {"n": f"count(CASE WHEN {condition} THEN 1 END)"}, f"count(CASE WHEN {{n}} >= {at_least} THEN {_ENTITY} END)"
    )


def earliest(column: str) -> Measure:
    return Measure({"m": f"min({column})"}, "min({m})", {"m": "min"})


def latest(column: str) -> Measure:
    return Measure({"m": f"max({column})"}, "max({m})", {"m": "max"})


def _slots(name: str, measure: Measure) -> dict[str, str]:
    return {suffix: f"{name}__{suffix}" for suffix in measure.partials}


def partials(rows: DataFrame, keys: list[str], entity: str, measures: dict[str, Measure]) -> DataFrame:
    """One row per key group and entity; such rows of several parts of the data can be kept and merged later."""
    # The entity gets a name of its own, as it may be one of the keys as well.
    keyed = rows.withColumn(_ENTITY, F.col(entity))
    columns = [
        f"{text} AS {_slots(name, measure)[suffix]}" for name, measure in measures.items() for suffix, text in measure.partials.items()
    ]
    if not columns:
        return keyed.select(*keys, _ENTITY).distinct()
    return keyed.groupBy(*keys, _ENTITY).agg(*exprs(*columns))


def folded(parts: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """Partials of several parts of the data as one row per key group and entity."""
    columns = []
    for name, measure in measures.items():
        columns += [f"{measure.folds.get(suffix, 'sum')}({slot}) AS {slot}" for suffix, slot in _slots(name, measure).items()]
    return parts.groupBy(*keys, _ENTITY).agg(*exprs(*columns)) if columns else parts.select(*keys, _ENTITY).distinct()


def merged(per_entity: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The report over one row per key group and entity."""
    columns = [f"{measure.merge.format(**_slots(name, measure))} AS {name}" for name, measure in measures.items()]
    return per_entity.groupBy(*keys).agg(*exprs(*columns))


def report(rows: DataFrame, keys: list[str], entity: str, measures: dict[str, Measure]) -> DataFrame:
    """One row per key group (one row in all when there are no keys)."""
    return merged(partials(rows, keys, entity, measures), keys, measures)
