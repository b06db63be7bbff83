"""Sequential funnel over an event stream.

An entity reaches stage k when it has an event of stage k at or after the earliest
instant at which it reached stage k-1.  That is a small automaton run over the
entity's events in time order.  Running it per entity would put a very active entity
into one task, so it is run per (entity, time slice) instead: for each slice it is
found which stage the entity leaves in, for every stage it may have entered in.
These tiny transition rows are chained into rows of the next wider slice, and at last
per entity, so that no task gathers more than the slices within the next wider one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cartwright.functions.parsing import exprs, literal, rows_of, safe_ratio


def stage_depth(
    events: DataFrame, entity: str, time: str, stages: Sequence[str], time_slices: Sequence[str] = ("minute", "day")
) -> DataFrame:
    """Deepest stage reached per entity that reached at least the first stage.

    ``time_slices`` go from narrow to wide; the narrowest bounds what is sorted at once.
    """
    time_slice, *wider = time_slices
    depth = len(stages)
    flags = [f"coalesce({stage}, false) AS s{k}" for k, stage in enumerate(stages, 1)]
    # Events of one entity at one instant fold into one row before anything is sorted.
    walked = (
        events.selectExpr(f"{entity} AS entity", f"{time} AS at", *flags)
        .groupBy("entity", "at")
        .agg(*exprs(*[f"max(s{k}) AS s{k}" for k in range(1, depth + 1)]))
        .selectExpr("*", f"date_trunc('{time_slice}', at) AS slice")
    )
    so_far = "OVER (PARTITION BY entity, slice ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    for step in range(1, depth + 1):
        reached = []
        for entry in range(depth - step + 1):
            stage = entry + step
            hit = f"s{stage}" if step == 1 else f"s{stage} AND r{entry}_{stage - 1}"
            reached.append(f"max({hit}) {so_far} AS r{entry}_{stage}")
        walked = walked.selectExpr("*", *reached)
    exits = []
    for entry in range(depth):
        gained = [f"CAST(max(r{entry}_{stage}) AS INT)" for stage in range(entry + 1, depth + 1)]
        exits.append(f"{entry} + {' + '.join(gained)} AS from_{entry}")
    slices = walked.groupBy("entity", "slice").agg(*exprs(*exits))
    leaves = ", ".join(f"from_{entry}" for entry in range(depth))
    options = ", ".join(f"step.from_{entry}" for entry in range(depth))

    def after(entry: int) -> str:
        """The stage in which the sorted steps are left when they are entered in ``entry``."""
        return f"aggregate(steps, {entry}, (state, step) -> element_at(array({options}, {depth}), state + 1))"

    steps = exprs(f"array_sort(collect_list(struct(slice, {leaves}))) AS steps")
    for unit in wider:
        chained = slices.selectExpr("*", f"date_trunc('{unit}', slice) AS wide").groupBy("entity", "wide").agg(*steps)
        slices = chained.selectExpr("entity", "wide AS slice", *[f"{after(entry)} AS from_{entry}" for entry in range(depth)])
    chained = slices.groupBy("entity").agg(*steps)
    return chained.selectExpr(f"entity AS {entity}", f"{after(0)} AS depth").filter("depth >= 1")


def stage_report(depths: DataFrame, names: Sequence[str]) -> DataFrame:
    """Entities per stage with conversion from the previous and from the first stage."""
    totals = depths.agg(
        *exprs(*[f"count(CASE WHEN depth >= {k} THEN 1 END) AS n{k}" for k in range(1, len(names) + 1)])
    )
    rows = totals.selectExpr(
        rows_of(
            {"stage_order": str(k), "stage_name": literal(name), "user_count": f"n{k}"}
            for k, name in enumerate(names, 1)
        )
    )
    previous = safe_ratio("user_count", "lag(user_count) OVER (ORDER BY stage_order)")
    first = safe_ratio("user_count", "max(CASE WHEN stage_order = 1 THEN user_count END) OVER ()")
    return rows.selectExpr(
        "*",
        f"CASE WHEN stage_order = 1 THEN 1.0D ELSE {previous} END AS previous_stage_conversion",
        f"{first} AS overall_conversion",
    )
