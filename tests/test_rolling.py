"""Rolling merges against full re-merges."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from coclick.operators import rolling
from coclick.sinks.files import complete_snapshots

FIRST = dt.date(2024, 1, 1)


def days_of(spark, n=34):
    """Daily counts with fractions, some days without any."""
    rng = random.Random(6)
    out = {}
    for i in range(n):
        rows = [(rng.randrange(8), rng.randrange(8), rng.choice([1.0, 0.1, 0.7, 2.0])) for _ in range(rng.randrange(25))]
        out[str(FIRST + dt.timedelta(days=i))] = None if i % 9 == 4 else rows
    return out


def by_hand(days, day, n_days):
    out = {}
    for i in range(n_days + 1):
        for a, b, w in days.get(str(day - dt.timedelta(days=i))) or []:
            total, n = out.get((a, b), (0.0, 0))
            out[a, b] = total + w, n + 1
    return out


def test_thirty_rolling_days_equal_the_full_merge(spark, scratch):
    days = days_of(spark)
    base = os.path.join(scratch, "rolling-30")
    daily = lambda d: spark.createDataFrame(days[d], "a long, b long, w double") if days.get(d) else None
    seen = []
    for i in range(4, 34):
        day = FIRST + dt.timedelta(days=i)
        path = rolling.roll(spark, base, str(day), 3, daily, ["a", "b"], "w", keep=3)
        got = {(r["a"], r["b"]): (r["w"], r["n_rows"]) for r in spark.read.parquet(path).collect()}
        want = by_hand(days, day, 3)
        assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want), day
        seen.append(len(want))
    assert len(complete_snapshots(spark, base)) == 3 and min(seen) < max(seen)


def test_a_repeated_or_unfinished_day_changes_nothing(spark, scratch):
    days = {str(FIRST + dt.timedelta(days=i)): [(1, 2, 1.0), (i, 9, 1.0)] for i in range(6)}
    base = os.path.join(scratch, "rolling-again")
    daily = lambda d: spark.createDataFrame(days[d], "a long, b long, w double") if d in days else None
    rows = lambda p: sorted(map(tuple, spark.read.parquet(p).collect()))
    for i in (2, 3):
        path = rolling.roll(spark, base, str(FIRST + dt.timedelta(days=i)), 2, daily, ["a", "b"], "w")
    first = rows(path)
    # a second run of a finished day, and one after its marker was lost
    assert rows(rolling.roll(spark, base, str(FIRST + dt.timedelta(days=3)), 2, daily, ["a", "b"], "w")) == first
    os.remove(os.path.join(path, "_SUCCESS"))
    assert rows(rolling.roll(spark, base, str(FIRST + dt.timedelta(days=3)), 2, daily, ["a", "b"], "w")) == first
    assert first == sorted([(1, 2, 3.0, 3), (1, 9, 1.0, 1), (2, 9, 1.0, 1), (3, 9, 1.0, 1)])
    white = spark.createDataFrame([(1,), (2,)], "item long")
    assert [tuple(r) for r in rolling.merged(spark, path, "a", "b", "w", 2, white).collect()] == [(1, 2, 3.0)]
