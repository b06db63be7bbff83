"""The sliced funnel against a brute-force walk over each user's events."""

import random
from datetime import datetime, timedelta

import pytest

from cartwright.operators.funnel import stage_depth, stage_report

STAGES = ["step = 'a'", "step = 'b'", "step IN ('c', 'd')", "step = 'e'"]


def brute(events):
    depth = {}
    for user in {u for u, _, _ in events}:
        mine = [(at, step) for u, at, step in events if u == user]
        since, reached = datetime.min, 0
        for wanted in ("a", "b", "cd", "e"):
            hits = [at for at, step in mine if step in wanted and at >= since]
            if not hits:
                break
            since, reached = min(hits), reached + 1
        if reached:
            depth[user] = reached
    return depth


def events(seed, users, n, minutes, hot=False):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (0 if hot and rng.random() < 0.5 else rng.randrange(users), start + timedelta(minutes=rng.randrange(minutes)),
         rng.choice("abcdexy"))
        for _ in range(n)
    ]


@pytest.mark.parametrize("time_slices", [("hour",), ("minute", "day"), ("second", "minute", "hour")], ids=len)
@pytest.mark.parametrize(
    "data",
    [events(1, 40, 200, 600), events(2, 30, 120, 5), events(3, 60, 240, 10000), events(4, 50, 400, 3000, hot=True)],
    ids=["mixed", "many-ties", "long", "hot-user"],
)
def test_depth_equals_brute_force(spark, data, time_slices):
    rows = spark.createDataFrame(data, "user INT, at TIMESTAMP, step STRING")
    found = {r["user"]: r["depth"] for r in stage_depth(rows, "user", "at", STAGES, time_slices).collect()}
    assert found == brute(data)


def test_report_of_nobody(spark):
    rows = spark.createDataFrame([], "user INT, at TIMESTAMP, step STRING")
    report = stage_report(stage_depth(rows, "user", "at", STAGES), ["one", "two", "three", "four"]).collect()
    assert [r["user_count"] for r in report] == [0, 0, 0, 0]
    assert [r["previous_stage_conversion"] for r in report] == [1.0, None, None, None]
    assert [r["overall_conversion"] for r in report] == [None] * 4
