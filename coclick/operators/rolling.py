"""Retractable N-day merges: a versioned state moved on by signed deltas (CF2, GR2).

Re-merging days D-n..D reads n + 1 daily tables for every day.  Here the state
after day D is the one after day D - 1 plus the new day, minus the day that
leaves the horizon: two daily tables and the state.  A row of the state carries,
besides its sum, the number of daily rows in it, so a pair that no day of the
horizon holds is dropped exactly, whatever rounding left of its sum.

States are versions, one folder a day with a success marker, each a pure function
of the version before and of finished days.  Running a day again writes the same
rows, an unfinished version is never read, and a day without a usable version
before it is merged whole.  Thresholds and whitelists are applied when a version
is read, so they may change without a new merge.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coclick.sinks.files import if_missing, is_complete, keep_latest

ROWS = "n_rows"


def signed(daily: DataFrame, keys: list[str], value: str, sign: int = 1) -> DataFrame:
    """Daily rows as a delta (keys, value, n_rows) that is added or, with ``sign`` -1, taken away."""
    return daily.select(*keys, (F.col(value) * sign).alias(value), F.lit(sign).cast("long").alias(ROWS))


def advance(state: DataFrame | None, deltas: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """The state after ``deltas``: sums, and only keys that some daily row still holds."""
    parts = ([state] if state is not None else []) + deltas
    rows = parts[0].select(*keys, value, ROWS)
    for p in parts[1:]:
        rows = rows.unionByName(p.select(*keys, value, ROWS))
    return rows.groupBy(*keys).agg(F.sum(value).alias(value), F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) > 0)


def roll(spark: SparkSession, base: str, day: str, n_days: int, daily: Callable[[str], DataFrame | None], keys: list[str],
         value: str, keep: int | None = None) -> str:
    """Version ``base/<day>`` of the merge of days D-n..D; returns its path.

    ``daily(day)`` gives a finished day's rows, None if the day has none.  Only
    ``keep`` versions stay, if given.
    """
    at = lambda d: f"{base.rstrip('/')}/{d}"
    today = dt.date.fromisoformat(day)
    before, leaves = today - dt.timedelta(days=1), today - dt.timedelta(days=n_days + 1)

    def build() -> DataFrame:
        if is_complete(spark, at(before)):
            days = [(daily(str(today)), 1), (daily(str(leaves)), -1)]
            state = spark.read.parquet(at(before))
        else:
            days = [(daily(str(today - dt.timedelta(days=i))), 1) for i in range(n_days, -1, -1)]
            state = None
        deltas = [signed(d, keys, value, sign) for d, sign in days if d is not None]
        if not deltas and state is None:
            raise FileNotFoundError(f"no day of {day} and the {n_days} before it, nor a merge of the day before")
        return advance(state, deltas, keys, value)

    if_missing(spark, at(day), build)
    if keep:
        keep_latest(spark, base, keep)
    return at(day)


def merged(spark: SparkSession, path: str, a: str, b: str, value: str, min_weight: float,
           whitelist: DataFrame | None = None) -> DataFrame:
    """A version's rows with both ends in the whitelist and at least ``min_weight``."""
    rows = spark.read.parquet(path).where(F.col(value) >= min_weight)
    for end in (a, b) if whitelist is not None else ():
        rows = rows.join(whitelist.select(F.col("item").alias(end)), end, "left_semi")
    return rows.select(a, b, value)
