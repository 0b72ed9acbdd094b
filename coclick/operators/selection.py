"""Exact quantiles of a column of any size by histogram refinement (AG7).

Spark's ``percentile`` keeps every distinct value in one aggregate.  Here the
order statistics that the quantiles need are closed in on: one pass counts the rows
of ``BUCKETS`` equal buckets of the value range (with each bucket's least and
greatest value), and only the buckets that hold a wanted rank go on, with the range
of the values they really have.  A bucket whose least value is its greatest is
settled, so a value that a third of the rows repeat costs nothing extra; a bucket
of few distinct values is counted value by value.  Every pass is a map-side
combined aggregate of at most ``BUCKETS`` rows an interval, and the driver sees those.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
#: Rows of a bucket that are counted value by value.
FEW = 4096


def order_statistics(df: DataFrame, column: str, ranks: list[int], buckets: int = BUCKETS, few: int = FEW) -> dict[int, float]:
    """{rank: value} of the 0-based ranks of a numeric column in ascending order (nulls and NaN are no values)."""
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    first = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    out: dict[int, float] = {}
    # intervals (lo, hi, rows before, rows inside) with the ranks that are in them
    todo = [(first["lo"], first["hi"], 0, first["n"], sorted({r for r in ranks if 0 <= r < first["n"]}))]
    while todo := [t for t in todo if t[4]]:
        for lo, hi, _, _, wanted in todo:
            if lo == hi:
                out.update((r, lo) for r in wanted)
        todo = [t for t in todo if t[0] != t[1]]
        if not todo:
            break
        where, place = F.lit(False), F.lit(None).cast("string")
        for i, (lo, hi, _, inside, _) in enumerate(todo):
            here = F.col("v").between(lo, hi)
            # halves first, so that the range of the whole doubles does not overflow
            share = (F.col("v") / 2 - lo / 2) / (hi / 2 - lo / 2) if math.isfinite(hi / 2 - lo / 2) and hi / 2 > lo / 2 else \
                (F.col("v") > lo).cast("double")
            bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("string")
            own = F.col("v").cast("string") if inside <= few else bucket
            place = F.when(here, F.concat(F.lit(f"{i}:"), own)).otherwise(place)
            where = where | here
        found = values.where(where).groupBy(place.alias("place")).agg(
            F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        following = []
        for i, (_, _, before, _, wanted) in enumerate(todo):
            at = before
            for b in sorted((b for b in found if b["place"].startswith(f"{i}:")), key=lambda b: b["lo"]):
                following.append((b["lo"], b["hi"], at, b["n"], [r for r in wanted if at <= r < at + b["n"]]))
                at += b["n"]
        todo = following
    return out


def quantiles(df: DataFrame, column: str, probabilities: list[float], buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """(probability, value): exact quantiles, interpolated between neighbours; no rows for a column without values."""
    spark = df.sparkSession
    n = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    places = {p: p * (n - 1) for p in probabilities} if n else {}
    known = order_statistics(df, column, [f(x) for x in places.values() for f in (math.floor, math.ceil)], buckets, few) if n else {}
    rows = [(float(p), float(known[math.floor(x)] + (known[math.ceil(x)] - known[math.floor(x)]) * (x - math.floor(x))))
            for p, x in places.items()]
    return spark.createDataFrame(rows, "probability double, value double")
